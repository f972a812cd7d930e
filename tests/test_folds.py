"""Folds without a SQL form against plain Python."""

import random
from math import hypot

from pyspark.sql import functions as F

from packloom.operators import boxes, pipelines, raster, stretch, tables


def test_panel_reuse_equals_a_plain_fold(spark):
    rng = random.Random(4)
    rows = [(p, s, a, f"k{rng.randrange(9)}", f"f{rng.randrange(7)}") for p in range(40) for s in range(4) for a in range(rng.randrange(1, 6))]
    listed = {"k1": "c1", "k5": "c5"}
    catalog = spark.createDataFrame(list(listed.items()), "key string, id string")
    requests = spark.createDataFrame(rows, "p int, screen_ord int, asset_ord long, key string, frame string")
    got = {(r.p, r.screen_ord, r.asset_ord): (r.action, r.reuse_id) for r in pipelines.panel_reuse(requests, catalog, "p").collect()}
    want, keys, frames = {}, {}, {}
    for p, s, a, key, frame in sorted(rows):
        reuse = frames.get((p, frame))
        if reuse is None and s > 0:
            reuse = keys.get((p, key)) or listed.get(key)
        want[p, s, a] = ("reuse" if reuse else "generate", reuse)
        if not reuse:
            keys[p, key] = frames[p, frame] = f"pending:{key}"
    assert got == want and {x for x, _ in want.values()} == {"reuse", "generate"}


def test_component_classes_by_hand(spark):
    # A main body, a fragment near it, one that only the fragment reaches, a large one far away and a small one far away.
    rows = [(1, 1, 400, 0, 0, 20, 20), (1, 2, 9, 25, 0, 28, 3), (1, 3, 9, 35, 0, 38, 3), (1, 4, 200, 200, 200, 214, 214), (1, 5, 4, 300, 0, 302, 2)]
    got = {r.comp_id: r["class"] for r in boxes.classified_components(spark.createDataFrame(rows, "image_id int, comp_id int, pixels int, l int, t int, r int, b int"), ["image_id"], (12.0, 0.12, 48.0)).collect()}
    assert got == {1: "anchor", 2: "merged", 3: "merged", 4: "major-detached", 5: "detached"}
    assert hypot(3, 4) == 5


def test_budget_passes_over_what_is_too_dear(spark):
    jobs = spark.createDataFrame([(1, k, c) for k, c in enumerate((5.0, 9.0, 4.0, 2.0))], "run int, k int, cost double")
    got = [(r.k, r.taken, r.spent) for r in tables.budget_fold(jobs, "run", ["k"], "cost", "k", 10.0).orderBy("k").collect()]
    assert got == [(0, True, 5.0), (1, False, 5.0), (2, True, 9.0), (3, False, 9.0)]


def test_a_plain_panel_passes_and_a_crest_fails(spark):
    def panel(crest):
        rows = []
        for y in range(60):
            for x in range(60):
                inside = 5 <= x < 55 and 5 <= y < 55 or (crest and 26 <= x < 34 and y >= 0 and y < 5)
                rows.append((int(crest), x, y, 90, 90, 90, 255 if inside else 0))
        return rows

    pixels = spark.createDataFrame(panel(False) + panel(True), "i int, x int, y int, r int, g int, b int, a int")
    got = {(r.i, r.edge): r.ok for r in stretch.stretch_bands(pixels, "i").collect()}
    assert all(ok for (i, _), ok in got.items() if i == 0) and not got[1, "top"]
    assert [r.i for r in stretch.stretch_issues(stretch.stretch_bands(pixels, "i"), "i", "Panel").collect()] == [1]


def test_empty_rasters(spark):
    none = spark.createDataFrame([], "i int, x int, y int, r int, g int, b int, a int, v double")
    assert stretch.stretch_bands(none, "i").isEmpty() and raster.components(none, "i", F.col("v") > 0).isEmpty()
    assert raster.alpha_statistics(none, "i").isEmpty() and raster.box_mean(none, "i", "v", 1).isEmpty()


def test_runs_of_nulls_and_ties(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, 4, None), (1, 5, "a")], "line int, p int, s string")
    assert sorted((r.start, r.end, r.s) for r in tables.runs(rows, ["line"], "p", "s").collect()) == [(1, 2, "a"), (3, 4, None), (5, 5, "a")]
    assert [r.p for r in tables.changes(rows, "line", ["p"], "s").orderBy("p").collect()] == [1, 3, 5]
