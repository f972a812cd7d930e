"""The runner from PNG sheets to validated packs, and its kernels against brute force."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from packloom.operators import planning, runner, scoring
from packloom.sources import files


def flooded(mask):
    """(pixels, l, t, r, b) of 8-connected components by flooding."""
    left, found = {(int(y), int(x)) for y, x in zip(*np.nonzero(mask), strict=True)}, []
    for start in sorted(left):
        if start not in left:
            continue
        left.remove(start)
        todo, own = [start], []
        while todo:
            y, x = todo.pop()
            own.append((y, x))
            for n in [(y + dy, x + dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]:
                if n in left:
                    left.remove(n)
                    todo.append(n)
        ys, xs = zip(*own, strict=True)
        found.append((len(own), min(xs), min(ys), max(xs) + 1, max(ys) + 1))
    return sorted(found, key=lambda c: -c[0])


@pytest.mark.parametrize(("seed", "density"), [(0, 0.2), (1, 0.45), (2, 0.7), (3, 0.0), (4, 1.0)])
def test_components_equal_flooding(seed, density):
    mask = np.random.default_rng(seed).random((40, 33)) < density
    assert list(map(tuple, runner.labelled(mask).tolist())) == flooded(mask)


def test_a_spiral_is_one_component():
    mask = np.zeros((60, 60), bool)
    for k in range(0, 28, 4):
        mask[k, k : 59 - k] = mask[k : 59 - k, 59 - k - 1] = mask[59 - k - 1, k + 2 : 59 - k] = mask[k + 4 : 59 - k, k + 2] = True
        mask[k + 4, k + 2 : k + 5] = True
    assert list(map(tuple, runner.labelled(mask).tolist())) == flooded(mask)


def test_mattes_give_back_colours():
    rng = np.random.default_rng(5)
    alpha = np.zeros((40, 40))
    alpha[10:30, 10:30] = rng.uniform(0.3, 1, (20, 20))
    colour, ground = np.array([200.0, 40, 60]), np.array([0.0, 255, 0])
    seen = alpha[..., None] * colour + (1 - alpha)[..., None] * ground
    source = np.concatenate([np.rint(seen), np.full((40, 40, 1), 255)], axis=2).astype(np.uint8)
    matte = np.repeat(np.rint(alpha * 255)[..., None], 4, axis=2).astype(np.uint8)
    out = runner.matte_applied(source, matte)
    assert (out[..., 3] == matte[..., 0]).all() and (out[alpha == 0] == 0).all()
    assert np.abs(out[10:30, 10:30, :3] - colour).max() <= 4


def test_crops_are_trimmed_scaled_and_placed():
    crop = np.zeros((50, 70, 4), np.uint8)
    crop[10:30, 5:65] = (10, 20, 30, 255)
    out = runner.normalised(crop, (40, 40), 4, "bottom-center")
    rows, columns = np.flatnonzero(out[..., 3].any(axis=1)), np.flatnonzero(out[..., 3].any(axis=0))
    assert out.shape == (40, 40, 4) and (rows[0], rows[-1], columns[0], columns[-1]) == (25, 35, 4, 35)
    small = runner.normalised(crop[10:14, 5:9], (40, 40), 4, "center")
    assert small[18:22, 18:22, 3].all() and small[..., 3].sum() == 16 * 255
    assert runner.normalised(crop, None, 3, "center").shape == (26, 66, 4)
    assert runner.normalised(np.zeros((5, 5, 4), np.uint8), None, 3, "center") is None
    assert runner.normalised(crop, (8, 8), 4, "center") is None


SIZE = {"canvas": [256, 256], "grid": [2, 2], "outer_margin": 16, "gutter": 8, "safe_padding": 16, "padding": 4, "target_size": [64, 64]}
#: Slots of SIZE: 108 wide from 16 and from 132.
CENTRES = [(70, 70), (186, 70), (70, 186), (186, 186)]


def sheet(background, *blobs, size=256):
    out = np.zeros((size, size, 4), np.uint8)
    out[...] = background
    y, x = np.mgrid[:size, :size]
    for cx, cy, radius, colour in blobs:
        out[np.hypot(x - cx, y - cy) < radius] = colour
    return out


GREEN, CLEAR, RED, BLUE = (0, 255, 0, 255), (0, 0, 0, 0), (200, 40, 60, 255), (30, 60, 200, 255)


@pytest.fixture
def prepared(spark, tmp_path):
    def make(categories, pictures):
        """Plan and sheets of one project; pictures: output path -> RGBA or bytes."""
        (tmp_path / "request").mkdir(exist_ok=True)
        (tmp_path / "request/r.json").write_text(json.dumps({"project_id": "bag", "generation_method": "explicit", "categories": categories}))
        plan = planning.batch_plan(files.requests(spark, str(tmp_path / "request")))
        for path, rgba in pictures.items():
            (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / path).write_bytes(rgba if isinstance(rgba, bytes) else files.png(rgba.shape[1], rgba.shape[0], rgba.tobytes()))
        decoded = files.packed_images(files.images(spark, str(tmp_path / "generated/current")))
        stem = F.regexp_extract("path", r"([^/]+)\.png$", 1)
        every = decoded.select(F.lit("bag").alias("project"), F.regexp_replace(stem, "-alpha-matte$", "").alias("job_id"), "width", "height", "rgba", stem.endswith("-alpha-matte").alias("matte"))
        return plan, every.where("NOT matte"), every.where("matte")

    return make


def names(*found):
    return [{"semantic_name": n, "state": "Default"} for n in found]


def test_a_clean_run_ends_with_valid_packs(prepared):
    categories = [
        {"category": "Icon_Item", **SIZE, "assets": names("sword", "shield", "ring", "helm")},
        {"category": "Icon_Effect", **SIZE, "transparency_mode": "model-matte-derived", "assets": names("glow")},
        {"category": "Panel", **SIZE, "grid": [1, 1], "assets": names("main")},
    ]
    soft = sheet((0, 0, 0, 255))
    y, x = np.mgrid[:256, :256]
    soft[..., :3] = np.clip((30 - np.hypot(x - 70, y - 70)) * 12, 0, 255)[..., None].astype(np.uint8)
    glow = sheet((20, 20, 20, 255), (70, 70, 31, (250, 220, 90, 255)))
    pictures = {
        "generated/current/icon-item-sheet-01.png": sheet(GREEN, *((x, y, 30 + k, RED) for k, (x, y) in enumerate(CENTRES)), (108, 70, 4, BLUE)),
        "generated/current/icon-effect-sheet-01.png": glow,
        "generated/current/icon-effect-sheet-01-alpha-matte.png": soft,
        "generated/current/panel-sheet-01.png": sheet(CLEAR, (128, 128, 80, RED)),
    }
    plan, sheets, mattes = prepared(categories, pictures)
    done = runner.run(plan, sheets, mattes)
    entries = {r.id: r for r in done.entries.collect()}
    assert sorted(entries) == ["01_Panel_Main_Default_001", "06_Icon_Item_Helm_Default_004", "06_Icon_Item_Ring_Default_003", "06_Icon_Item_Shield_Default_002", "06_Icon_Item_Sword_Default_001", "09_Icon_Effect_Glow_Default_001"]
    sword = entries["06_Icon_Item_Sword_Default_001"]
    # The dot lies nine pixels off and joins; both are cut out, with two pixels of room.
    assert (sword.component_count, sword.merged_count, sword.detached_count, sword.qa) == (2, 1, 0, "pass")
    assert tuple(sword.box) == (39, 39, 114, 102) and sword.alpha_origin == "chroma-derived"
    assert (entries["01_Panel_Main_Default_001"].alpha_origin, entries["09_Icon_Effect_Glow_Default_001"].alpha_origin) == ("existing-alpha-unverified", "gpt-image-2-matte-derived")
    images = {r.output: r for r in done.images.collect()}
    assert len(images) == 6 and {(r.width, r.height, len(r.rgba)) for r in images.values()} == {(64, 64, 4 * 64 * 64)}
    assert done.issues.collect() == []
    spark = done.entries.sparkSession
    digests = spark.createDataFrame([("bag", "icon-effect-sheet-01", "a" * 64, "b" * 64)], "project string, job_id string, source_sha256 string, alpha_matte_sha256 string")
    listed = spark.createDataFrame([("bag", "generated/current/icon-effect-sheet-01-alpha-matte.png")], "project string, file string")
    issues, reports = runner.validated(plan, done, listed, digests)
    assert issues.collect() == []
    assert [tuple(r) for r in reports.collect()] == [("bag", True, 6, 6, 6, 6, 0, 0)]


def test_what_goes_wrong_is_told(prepared):
    block = lambda *found, **other: {**SIZE, **other, "assets": names(*found)}
    categories = [
        {"category": "Icon_Item", **block("sword", "shield", "ring", "helm")},
        {"category": "Icon_Nav", **block("map")},
        {"category": "Icon_Skill", **block("fire")},
        {"category": "Icon_General", **block("close", "open")},
        {"category": "Icon_Equip", **block("boot")},
        {"category": "Icon_Effect", **block("glow", transparency_mode="model-matte-derived")},
    ]
    pictures = {
        # Sword's large twin is loose; shield and helm are one piece, which lies half a pixel nearer to helm; ring's dot joins it.
        "generated/current/icon-item-sheet-01.png": sheet(GREEN, (50, 70, 14, RED), (95, 70, 13, RED), (186, 70, 20, RED), (186, 186, 20, RED), (186, 128, 48, RED), (70, 186, 20, RED), (100, 220, 5, BLUE)),
        "generated/current/icon-nav-sheet-01.png": b"no image",
        "generated/current/icon-skill-sheet-01.png": sheet(GREEN, (70, 70, 20, RED))[:128],
        "generated/current/icon-general-sheet-01.png": sheet(CLEAR, (12, 70, 12, RED)),
        "generated/current/icon-effect-sheet-01.png": sheet(GREEN, (70, 70, 20, RED)),
    }
    plan, sheets, _ = prepared(categories, pictures)
    done = runner.run(plan, sheets)
    found = sorted(((r.job_id, r.slot, r.severity, r.code) for r in done.issues.collect()), key=repr)
    item, general = "icon-item-sheet-01", "icon-general-sheet-01"
    assert found == sorted(
        [
            (item, None, "fail", "cross-slot-connected-component"),
            (item, 1, "warning", "detached-components"),
            (item, 1, "warning", "multiple-major-components"),
            (item, 2, "fail", "empty-slot"),
            ("icon-nav-sheet-01", None, "fail", "source-decode-failed"),
            ("icon-skill-sheet-01", None, "fail", "generated-canvas-aspect-ratio-mismatch"),
            (general, 1, "fail", "canvas-edge-contact"),
            (general, 2, "fail", "empty-slot"),
            ("icon-equip-sheet-01", None, "fail", "missing-file"),
            ("icon-effect-sheet-01", None, "fail", "background-cleanup-failed"),
        ],
        key=repr,
    )
    issues, reports = runner.validated(plan, done)
    report = reports.collect()[0]
    assert (report.ok, report.expected_count, report.manifest_count) == (False, 10, 4)
    codes = {(r.stage, r.code) for r in issues.collect()}
    assert {(0, "count-mismatch"), (-1, "empty-slot"), (-1, "source-decode-failed")} <= codes
    scores = scoring.job_scores(issues.select("ord", "job_id", "asset_id", "severity", "code", "file"), plan.jobs.select("job_id"))
    by = {r.job_id: (r.score, r.status) for r in scores.collect()}
    assert by["icon-nav-sheet-01"] == (55, "blocked") and by[item][1] == "blocked"


def test_queries_of_the_runner_equal_flooding(spark):
    """Each image stands alone in its slot: its components of 16 pixels or more, boxes and counts."""
    from packloom.plans.registry import QUERIES
    from packloom.plans.runner_queries import plan_and_sheets
    from packloom.plans.standins import pixels

    from .conftest import SF

    masks = {}
    for r in pixels(spark, SF).select("vec_id", "x", "y", "a").collect():
        masks.setdefault(r.vec_id, np.zeros((8, 8), bool))[r.y, r.x] = r.a >= 16
    want = {v: [c for c in flooded(m) if c[0] >= 16] for v, m in masks.items()}
    want = {v: c for v, c in want.items() if c}
    plan, _ = plan_and_sheets(spark, SF)
    boxes = {(r.project, r.job_id, r.idx): r for r in plan.slots.collect()}
    entries = QUERIES["runner_entries"](spark, SF).collect()
    assert len(entries) == len(want)
    for e in entries:
        found = want[int(e.id.split("_")[3][4:])]
        s = boxes[e.project, e.job_id, e.slot]
        x, y = (s.l + s.r - 8) // 2, (s.t + s.b - 8) // 2
        assert (e.component_count, e.foreground_pixels) == (len(found), sum(c[0] for c in found))
        lows, highs = [min(c[k] for c in found) for k in (1, 2)], [max(c[k] for c in found) for k in (3, 4)]
        assert (e.l, e.t, e.r, e.b) == (max(0, x + lows[0] - 2), max(0, y + lows[1] - 2), min(64, x + highs[0] + 2), min(64, y + highs[1] + 2))
        assert e.component_count == 1 + e.merged_count + e.detached_count
    reports = {r.pack: r for r in QUERIES["runner_reports"](spark, SF).collect()}
    per = {}
    for e in entries:
        per[e.project] = per.get(e.project, 0) + 1
    assert {p: r.manifest_count for p, r in reports.items() if r.manifest_count} == per
    assert sum(r.expected_count for r in reports.values()) == len(masks)
