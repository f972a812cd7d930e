"""Review images against plain drawing, and their borders, checks and missing inputs."""

import numpy as np

from packloom.operators import boxes, previews


def picture(seed, w=8, h=8):
    rng = np.random.default_rng(seed)
    out = rng.integers(0, 256, (h, w, 4)).astype(np.uint8)
    out[0, :, 3], out[1, :, 3] = 0, 255
    return out


def back(r):
    return np.frombuffer(r.rgba, np.uint8).reshape(r.height, r.width, 4)


def test_over_is_exact_on_opaque_and_clear_ground():
    top, ground = picture(1), picture(2)
    ground[..., 3] = 255
    a = top[..., 3:] / 255.0
    assert (previews.over(top, ground)[..., :3] == np.rint(top[..., :3] * a + ground[..., :3] * (1 - a))).all()
    clear = np.zeros_like(top)
    out = previews.over(top, clear)
    assert (out[..., 3] == top[..., 3]).all() and (out[top[..., 3] > 0] == top[top[..., 3] > 0]).all()


def test_contact_sheets_page_by_page(spark):
    rows = [("p", k, 8, 8, bytearray(picture(k).tobytes()) if k != 3 else None) for k in range(7)] + [("q", 0, 80, 40, bytearray(picture(9, 80, 40).tobytes()))]
    assets = spark.createDataFrame(rows, "pack string, ord int, width int, height int, rgba binary")
    found = {(r.pack, r.page): r for r in previews.contact_sheets(assets, "pack", ["ord"], columns=2, rows=2, cell=48).collect()}
    assert {k: (r.assets, r.missing, r.width, r.height) for k, r in found.items()} == {("p", 0): (4, 1, 96, 96), ("p", 1): (3, 0, 96, 96), ("q", 0): (1, 0, 96, 48)}
    first = back(found["p", 0])
    assert tuple(first[0, 0]) == (*previews.OUTLINE, 255) and (first[..., 3] == 255).all()
    solid = picture(1)[1]
    assert (first[21, 68:76] == solid).all()  # the second image's opaque line, in the middle of its cell
    assert tuple(first[72, 72]) == (*previews.CROSS, 255) and tuple(first[60, 70]) in [(*c, 255) for c in previews.TILES]
    assert (back(found["p", 1])[48:, 48:, :3] == previews.PAGE).all()
    wide = back(found["q", 0])[:, :48]
    drawn = (wide[..., :3].reshape(-1, 3)[:, None] != np.array([*previews.TILES, previews.OUTLINE])).any(axis=2).all(axis=1).reshape(48, 48)
    assert not drawn[:16].any() and not drawn[32:].any() and drawn[18:30, 18:30].any()
    assert previews.contact_sheets(assets.where("false"), "pack", ["ord"]).collect() == []


def test_layout_guides_show_every_box(spark):
    specs = spark.createDataFrame([("a", 200, 100, 3, 1, 10, 7, 12), ("b", 60, 60, 1, 1, 4, 0, 9)], "layout_id string, width int, height int, columns int, rows int, margin int, gutter int, safe int")
    slots = boxes.layout_slots(specs)
    pages = {r.layout_id: back(r) for r in previews.layout_guides(specs, slots).collect()}
    for s in slots.collect():
        page = pages[s.layout_id]
        assert tuple(page[s.t + 1, s.l + 1, :3]) == previews.SLOT[0] and tuple(page[s.st, s.sl, :3]) == previews.SAFE[0]
        assert tuple(page[s.cy, s.cx, :3]) == previews.CENTRE[0]
    assert pages["a"].shape == (100, 200, 4) and tuple(pages["b"][0, 0, :3]) == previews.FRAME[0]
    alone = previews.layout_guides(specs, slots.where("layout_id = 'a'")).where("layout_id = 'b'").collect()[0]
    assert tuple(back(alone)[30, 30, :3]) == previews.GUIDE


def test_nine_slices_keep_their_borders(spark):
    image = picture(4, 12, 10)
    image[..., 3] = 255
    out = previews.nine_sliced(image, 30, 25, (3, 2, 4, 1))
    assert out.shape == (25, 30, 4)
    assert (out[:1, :3] == image[:1, :3]).all() and (out[:1, -4:] == image[:1, -4:]).all() and (out[-2:, :3] == image[-2:, :3]).all() and (out[-2:, -4:] == image[-2:, -4:]).all()
    flat = np.full((10, 12, 4), 77, np.uint8)
    assert (previews.nine_sliced(flat, 40, 40, (3, 2, 4, 1)) == 77).all()
    assert previews.nine_sliced(image, 2, 2, (3, 2, 4, 1)).shape == (4, 8, 4)
    assert (previews.nine_sliced(image, 12, 10, (3, 2, 4, 1)) == image).all()
    rows = [(1, 12, 10, bytearray(image.tobytes()), 3, 2, 4, 1), (2, 12, 10, bytearray(image.tobytes()), 6, 2, 6, 1), (3, 12, 10, None, 1, 1, 1, 1), (4, 12, 10, bytearray(image.tobytes()), None, 1, 1, 1)]
    found = {(r.id, r.factor): r for r in previews.stretched_sprites(spark.createDataFrame(rows, "id int, w int, h int, rgba binary, left int, bottom int, right int, top int"), "id").collect()}
    assert {(f, found[1, f].width, found[1, f].height) for f in (0.5, 1.5, 2.0)} == {(0.5, 8, 5), (1.5, 18, 15), (2.0, 24, 20)}
    assert all(found[k, f].rgba is None for k in (2, 3, 4) for f in (0.5, 1.5, 2.0))


def test_reflowed_crops_land_in_safe_boxes(spark):
    sheet = np.zeros((60, 80, 4), np.uint8)
    sheet[...] = (0, 255, 0, 255)
    sheet[5:25, 10:30, :3] = (200, 30, 40)
    sheet[30:58, 20:76, :3] = (30, 40, 200)
    data = bytearray(sheet.tobytes())
    sources = spark.createDataFrame([(k, 80, 60, data if k != 4 else None, "#00FF00", 100, 50) for k in range(1, 6)], "id int, w int, h int, rgba binary, key string, canvas_w int, canvas_h int")
    slots = spark.createDataFrame([(1, 5, 5, 45, 45), (2, 55, 5, 95, 45)], "idx int, sl int, st int, sr int, sb int")
    red, blue = (8, 3, 32, 27), (18, 28, 78, 60)
    crops = [(1, 7, red), (1, 9, blue), (2, 1, red), (2, 2, red), (2, 3, red), (3, 1, (70, 50, 90, 60)), (4, 1, red)]
    given = spark.createDataFrame(crops, "id int, position int, box struct<l:int,t:int,r:int,b:int>")
    found = {r.id: r for r in previews.reflowed_sheets(sources, given, slots, "id").collect()}
    assert [k for k, r in sorted(found.items()) if r.rgba is not None] == [1]
    page = back(found[1])
    assert page.shape == (50, 100, 4) and (page[..., 3] == 255).all()
    # Red is centred at its size; blue is scaled to the width of its safe box.
    assert (page[15:35, 15:35, :3] == (200, 30, 40)).all() and tuple(page[12, 12, :3]) == (0, 255, 0)
    columns = np.flatnonzero((page[25, 50:, 2] > 150))
    assert 36 <= len(columns) <= 40 and columns[0] + 50 >= 55 and columns[-1] + 50 < 95
