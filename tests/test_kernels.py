import numpy as np
import pytest

from packloom.operators import kernels


def test_resizing_keeps_flat_images_and_hides_hidden_colours():
    flat = np.full((7, 9, 4), (10, 200, 30, 255), np.uint8)
    assert (kernels.resized_rgba(flat, 4, 13) == (10, 200, 30, 255)).all()
    half = np.zeros((8, 8, 4), np.uint8)
    half[:, :4] = (0, 0, 255, 255)
    half[:, 4:] = (255, 0, 0, 0)
    small = kernels.resized_rgba(half, 4, 4)
    assert not small[..., 0].any() and set(np.unique(small[small[..., 3] > 0][:, 2])) == {255}
    same = np.random.default_rng(0).integers(0, 256, (6, 5, 4)).astype(np.uint8)
    same[..., 3] = 255
    assert np.abs(kernels.resized_rgba(same, 5, 6).astype(int) - same).max() <= 1


def test_box_sums_are_cut_at_the_edge():
    a = np.random.default_rng(1).random((7, 5))
    want = [[a[max(0, y - 2) : y + 3, max(0, x - 2) : x + 3].sum() for x in range(5)] for y in range(7)]
    assert kernels.box_sums(a, 2) == pytest.approx(np.array(want))


def test_a_circle_on_the_key(spark):
    y, x = np.mgrid[:64, :64]
    share = np.clip(20 - np.hypot(x - 32, y - 32), 0, 1)[..., None]
    rgb = share * (200, 150, 20) + (1 - share) * (0, 255, 0)
    rgba = np.concatenate([np.rint(rgb), np.full((64, 64, 1), 255)], 2).astype(np.uint8)
    rows = spark.createDataFrame([(1, 64, 64, bytearray(rgba.tobytes())), (2, 64, 64, None)], "i int, width int, height int, rgba binary")
    got = {r.i: r.rgba for r in kernels.keyed_out(rows, "i", (0, 255, 0)).collect()}
    out = np.frombuffer(got[1], np.uint8).reshape(64, 64, 4)
    assert got[2] is None and not out[0, 0].any() and tuple(out[32, 32]) == (200, 150, 20, 255)
    edge = (out[..., 3] > 0) & (out[..., 3] < 255)
    assert edge.any() and (out[edge][:, 1] <= 160).all()
    sized = rows.where("i = 1").selectExpr("*", "16 as new_width", "8 as new_height")
    assert len(kernels.resized(sized, "i").first().rgba) == 16 * 8 * 4
