"""Golden cases of delivery, repair, inference and screen operators."""

import pytest
from pyspark.sql import functions as F

from packloom.functions import scalars as S
from packloom.operators import delivery, inference, raster, repair, screens, tables

from .conftest import SF

TASK = "run string, sequence long, kind string, is_retry boolean, priority int, job_sequence long, inputs_ready boolean"


def wave(spark, rows):
    got = delivery.next_wave(spark.createDataFrame(rows, TASK), "run").orderBy("slot").collect()
    return got[0].wave_kind, [r.sequence for r in got if r.sequence is not None]


def test_three_slots_but_only_two_jobs_of_high_risk(spark):
    """Panel, Button, Icon_Status and Icon_Item pending: the wave is Panel and Button alone."""
    sheets = [("a", k + 1, "production-sheet", False, p, k + 1, True) for k, p in enumerate((0, 1, 2, 10))]
    assert wave(spark, sheets) == ("risk-production", [1, 2])
    assert wave(spark, sheets[3:] + [("a", k, "production-sheet", False, 10, k, True) for k in (5, 6, 7)]) == ("production", [4, 5, 6])
    jobs = spark.createDataFrame([("a", p, k) for k, p in enumerate((0, 1, 2, 10))], "g string, p int, k int")
    assert [(r.k, r.slot) for r in tables.risk_wave(jobs, "g", "p", ["k"]).orderBy("slot").collect()] == [(0, 1), (1, 2)]
    assert [r.k for r in tables.risk_wave(jobs.where("p = 10"), "g", "p", ["k"]).collect()] == [3]


def test_retries_and_mattes_are_waves_of_one(spark):
    matte = [("a", 5, "alpha-matte", False, 10, 2, True), ("a", 3, "alpha-matte", False, 10, 1, False), ("a", 7, "alpha-matte", False, 10, 3, True)]
    assert wave(spark, matte) == ("dependent", [5])
    assert wave(spark, matte[1:2]) == ("dependent", [])
    assert wave(spark, [*matte, ("a", 9, "production-sheet", True, 0, 9, True), ("a", 8, "production-sheet", True, 10, 8, True), ("a", 1, "production-sheet", False, 0, 1, True)]) == ("retry", [8])


def test_a_retry_waits_until_every_target_changes(spark):
    planned = spark.createDataFrame([("j", "sheet", "s1"), ("j", "matte", "m1"), ("k", "gone", "x")], "job string, path string, awaiting string")
    gate = lambda rows: {r.job: (r.open, r.waiting) for r in delivery.retry_gate(planned, spark.createDataFrame(rows, "path string, sha256 string"), "job", "path").collect()}
    assert gate([("sheet", "s2"), ("matte", "m1")]) == {"j": (False, 1), "k": (True, 0)}
    assert gate([("sheet", "s2"), ("matte", "m2")]) == {"j": (True, 0), "k": (True, 0)}


@pytest.mark.parametrize(("status", "stage"), [("awaiting-generation", "generation"), ("ready-for-processing", "processing"), ("failed", "qa-failed"), ("source-gate-failed", "source-gate-failed"), ("unity-failed", "assets-complete")])
def test_safe_stages(spark, status, stage):
    assert spark.range(1).select(delivery.safe_stage(F.lit(status))).first()[0] == stage


def test_generation_state_counts_inputs_and_replacements(spark):
    rows = [("r", 1, True, False), ("r", 1, True, True), ("r", 2, True, False), ("r", 3, False, False)]
    got = delivery.generation_state(spark.createDataFrame(rows, "run string, job int, present boolean, unchanged boolean"), "run", "job").first()
    assert (got.job_count, got.ready_job_count, got.pending_job_count, got.required_input_count, got.ready_input_count, got.missing_input_count, got.pending_replacement_count) == (3, 1, 2, 4, 3, 1, 1)


def test_a_chain_of_forty_is_valid_and_a_cycle_is_not(spark):
    nodes = [(0, None), *((k, k - 1) for k in range(1, 40)), (100, 101), (101, 100), (200, 999)]
    got = {r.id: (r.depth, r.valid) for r in tables.tree_depths(spark.createDataFrame(nodes, "id int, parent int"), "id", "parent").collect()}
    assert got == {k: (k, True) for k in range(40)} | {100: (None, False), 101: (None, False), 200: (None, False)}


def test_components_of_a_spiral(spark):
    """One component whose path is far longer than any fixed number of rounds."""
    n, x, y, dx, dy, seen = 13, 0, 0, 1, 0, {(0, 0)}
    for length in [n - 1, *(k for k in range(n - 1, 1, -2) for _ in range(2))]:
        for _ in range(length):
            x, y = x + dx, y + dy
            seen.add((x, y))
        dx, dy = -dy, dx
    pixels = spark.createDataFrame([(1, *p) for p in seen], "i int, x int, y int")
    got = raster.components(pixels, "i", F.lit(True)).collect()
    assert [r.pixels for r in got] == [len(seen)]


JOB = "run int, job_id string, ord int, transparency_mode string, sheet_path string, matte_path string, provenance_path string, attempts int"


def test_regeneration_plan(spark):
    job = lambda k, attempts, mode="chroma-key": (1, f"j{k}", k, mode, f"s{k}.png", f"m{k}.png" if "matte" in mode else None, None, attempts)
    jobs = spark.createDataFrame([job(1, 1), job(2, 3), job(3, 1, "model-matte-derived"), job(4, 0), job(5, 1, "model-matte-derived"), job(6, 1), job(7, 1)], JOB)
    issues = spark.createDataFrame([("j1", "empty-slot", "fail"), ("j1", "detached-components", "warning"), ("j2", "empty-slot", "fail"), ("j3", "insufficient-partial-alpha-pixels", "fail"), ("j5", "source-matte-pixel-mismatch", "fail"), ("j6", "no-transparent-padding", "info"), ("j7", "empty-slot", "fail")], "job_id string, code string, severity string")
    results = spark.createDataFrame([("j1", True), ("j2", False), ("j6", True)], "job_id string, ok boolean")
    got = {r.job_id: r for r in repair.regeneration_plan(jobs, issues, results, spark.createDataFrame([(1, 3)], "run int, remaining int"), "run").collect()}
    assert {k: r.status for k, r in got.items()} == {"j1": "awaiting-regeneration", "j2": "exhausted", "j3": "awaiting-regeneration", "j5": "awaiting-regeneration", "j6": "ok", "j7": "generation-budget-exhausted"}
    assert (got["j1"].code, got["j1"].next_attempt, got["j1"].targets) == ("empty-slot", 2, ["s1.png"])
    assert got["j3"].targets == ["m3.png"] and got["j5"].targets == ["s5.png"] and got["j5"].retry_target == "alpha-matte"
    assert got["j1"].instruction.startswith("Fill every declared slot") and got["j2"].planned_extra_calls == 0
    one = {r.job_id: r.status for r in repair.regeneration_plan(jobs, issues, results, spark.createDataFrame([(1, 3)], "run int, remaining int"), "run", max_attempts=1).collect()}
    assert one["j1"] == "exhausted" and one["j6"] == "ok"
    text = spark.range(1).select(repair.retry_prompt(F.lit("Draw it.\n"), F.lit("empty-slot"), F.lit("Fill."), F.lit(2), 3)).first()[0]
    assert text.splitlines()[:7] == ["Draw it.", "", "## Focused correction attempt 2/3", "", "Fix exactly this defect: `empty-slot`.", "Fill.", "Keep the approved style, ordered resource list, canvas, grid, and every unrelated visual decision unchanged."]


def test_issue_corrections(spark):
    codes = ["empty-slot", "source-matte-size-mismatch", "some-matte-thing", "odd-alpha", "unclassified-job-failure", None]
    got = spark.createDataFrame([(c,) for c in codes], "c string").select("c", S.correction_of(F.col("c")).alias("x")).collect()
    assert [r.x and r.x.target for r in got] == ["production-sheet", "alpha-matte", "alpha-matte", "production-sheet", "production-sheet", None]


ASSET = "i int, position int, enabled boolean, source_index string, bbox array<int>, category string, category_index string"


def test_correction_preflight(spark):
    pixels = spark.createDataFrame([(1, x, y, 255 if 2 <= x < 6 and 2 <= y < 6 else 0) for x in range(20) for y in range(20)], "i int, x int, y int, a int")
    check = lambda *rows: {(r.position, r.code): (r.other, r.recommended) for r in repair.correction_issues(spark.createDataFrame([(1, *r) for r in rows], ASSET), pixels, "i", F.lit(20), F.lit(20)).collect()}
    assert check((0, True, None, [1, 1, 7, 7], "Panel", "1")) == {}
    assert check((0, True, "1", [2, 1, 7, 7], "Panel", "1")) == {(0, "bbox-cuts-foreground"): (None, [0, 1, 7, 7])}
    assert check((0, True, "1", [1, 1, 7, 25], "Panel", "1")) == {(0, "bbox-out-of-bounds"): (None, [1, 1, 7, 20])}
    assert check((0, True, "1", [10, 10, 15, 15], "Panel", "2")) == {(0, "empty-correction"): (None, None), (0, "non-continuous-category-index"): (None, None)}
    assert set(check((0, True, "1", [1, 1, 7, 7], "Panel", "1"), (1, True, "1", [6, 6, 9, 9], "Nope", "x"))) == {(1, "duplicate-source-index"), (1, "overlapping-corrections"), (1, "unsupported-category"), (1, "invalid-category-index"), (1, "empty-correction")}
    assert check((0, False, "x", None, None, None)) == {} and set(check((0, True, "x", None, None, None))) == {(0, "invalid-source-index"), (0, "invalid-bbox-shape")}


def test_nine_slice_of_a_plain_frame(spark):
    """A frame of 8 pixels around a flat middle; noise everywhere gives none."""
    frame = [(1, x, y, 200 if min(x, y, 47 - x, 47 - y) < 8 else 60, 90, 90, 255) for x in range(48) for y in range(48)]
    noise = [(2, x, y, (x * 37 + y * 91 + x * x * y) % 256, (x * 53 + y * 17 * y) % 256, (x * y * 29) % 256, 255) for x in range(48) for y in range(48)]
    small = [(3, x, y, 1, 1, 1, 255) for x in range(10) for y in range(30)]
    got = {r.i: r for r in inference.nine_slices(spark.createDataFrame(frame + noise + small, "i int, x int, y int, r int, g int, b int, a int"), "i").collect()}
    # One line that differs is bridged, so the first of the frame's lines on each side belongs to the stretch.
    assert got[1].apply and (got[1].left, got[1].bottom, got[1].right, got[1].top) == (7, 7, 7, 7) and got[1].issue is None
    assert not got[2].apply and got[2].issue == "nine-slice-low-confidence-manual-override-required"
    assert got[3].issue == "image-too-small-for-nine-slice" and got[3].confidence == 0


def test_checkerboards_are_told_from_flat_images(spark):
    board = [(1, x, y, *((208,) * 3 if (x // 6 + y // 6) % 2 else (160,) * 3)) for x in range(48) for y in range(48)]
    subject = [(i, x, y, *((20, 40, 90) if 14 <= x < 34 and 14 <= y < 34 else (r, g, b))) for i, x, y, r, g, b in board]
    flat = [(2, x, y, 160, 160, 160 + (x == 3)) for x in range(48) for y in range(48)]
    got = inference.checkerboards(spark.createDataFrame(subject + flat, "i int, x int, y int, r int, g int, b int"), "i").collect()
    assert [(r.i, {r.first, r.second}, r.tile, r.score) for r in got] == [(1, {"#D0D0D0", "#A0A0A0"}, 6, 1.0)]


def test_style_scores_join_canonical_and_cross(spark):
    pairs = spark.createDataFrame([("a", "b", 80.0), ("a", "c", 20.004), ("b", "c", 10.0)], "first string, second string, score double")
    canonical = spark.createDataFrame([("a", 100.0), ("b", 40.0), ("c", 30.0), ("d", 50.0)], "job string, canonical double")
    got = {r.job: (r.cross, r.score, r.severity) for r in raster.job_style_scores(pairs, canonical, "job").collect()}
    assert got == {"a": (50.0, 72.5, "pass"), "b": (45.0, 42.75, "warning"), "c": (15.0, 21.75, "fail"), "d": (50.0, 50.0, "warning")}


def test_screens(spark):
    e = spark.createDataFrame([("s", "v", "ScrollView", None, "p", "c", True, False), ("s", "p", "ScrollViewport", "v", None, None, None, None), ("s", "c", "Image", "p", None, None, None, None), ("s", "w", "ScrollView", None, "p", "x", False, False)], "s string, id string, kind string, parent_id string, viewport_id string, content_id string, horizontal boolean, vertical boolean")
    assert {(r.id, r.code) for r in screens.scroll_issues(e, "s").collect()} == {("w", "scroll-viewport-invalid"), ("w", "scroll-content-invalid"), ("w", "scroll-axis-missing")}
    issues = spark.createDataFrame([(2, "b")], "k int, code string"), spark.createDataFrame([(1, "a", "f")], "k int, code string, file string")
    got = screens.ordered_union(*issues, order=["k"]).collect()
    assert [(r.stage_ord, r.code, r.file) for r in got] == [(0, "b", None), (1, "a", "f")]


def test_crops_and_composites(spark):
    rows = [(1, x, y, 10 * x, 20, 30, 128 if x else 0) for x in range(4) for y in range(2)]
    px = spark.createDataFrame(rows, "i int, x int, y int, r int, g int, b int, a int")
    boxes = spark.createDataFrame([(1, 7, 1, 0, 3, 1)], "i int, k int, l int, t int, r int, b int")
    flat = px.select("i", "x", "y", F.col("r").alias("red"))
    assert sorted((r.k, r.x, r.y, r.red) for r in repair.crops(flat, boxes, "i", "k").collect()) == [(7, 0, 0, 10), (7, 1, 0, 20)]
    top = spark.createDataFrame([(1, 0, 0, 9, 9, 9, 255), (1, 1, 0, 200, 200, 200, 0)], "i int, x int, y int, r int, g int, b int, a int")
    got = {(r.x, r.y): (r.r, r.g, r.b, r.a) for r in repair.composited(px, top, "i").collect()}
    assert got[0, 0] == (9, 9, 9, 255) and got[1, 0] == (10, 20, 30, 128) and got[0, 1] == (0, 0, 0, 0)


def test_elements_without_a_prefab_are_no_hot_key(spark):
    e = spark.range(0, 400, 1, 8).select(F.lit(1).alias("s"), F.lit(2).alias("screen_ord"), "id", F.lit("PrefabInstance").alias("kind"), F.when(F.col("id") == 7, 0).when(F.col("id") == 8, 3).alias("prefab_screen"))
    e = e.unionByName(spark.createDataFrame([(1, 2, 900, "Image", 0), (1, 2, 901, "Image", None), (1, 2, 902, None, 0)], "s int, screen_ord int, id long, kind string, prefab_screen int"))
    known = spark.createDataFrame([(0, 1), (1, 2), (3, 3)], "s int, screen_ord int")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = screens.prefab_issues(e, known, "s").withColumn("part", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(r.id, r.code) for r in got} == {(k, "prefab-screen-not-earlier") for k in range(400) if k != 7} | {(900, "prefab-screen-unexpected"), (902, "prefab-screen-unexpected")}
    assert len({r.part for r in got if r.id < 400}) >= 8


@pytest.mark.parametrize("name", ["scroll_chain_issues", "toggle_group_issues"])
def test_elements_are_not_sorted_to_be_grouped(spark, name):
    from packloom.plans import inference_queries as Q

    assert "SortAggregate" not in getattr(Q, name)(spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_checkerboards_read_their_pixels_a_step_at_a_time(spark):
    from packloom.plans import inference_queries as Q

    plan = Q.checkerboard_detection(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert 1 <= plan.count("FileScan") <= 2  # the last step's pixels and those before them
