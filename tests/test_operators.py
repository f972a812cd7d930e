"""Golden values and small cases of single operators."""

import pytest
from pyspark.sql import functions as F

from packloom.functions import rules as R
from packloom.functions import scalars as S
from packloom.operators import boxes, raster, scoring, tables
from packloom.plans import standins, table_queries

from .conftest import SF


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("column", "want"),
    [
        (lambda: S.slugify(F.lit("  Main Bag!! ")), "main-bag"),
        (lambda: S.slugify(F.lit("绿色")), "game-ui"),
        (lambda: S.pascal_case(F.lit("close button v2")), "CloseButtonV2"),
        (lambda: S.asset_key(F.lit(" Panel "), F.lit(" Close "), F.lit("DEFAULT")), "Panel|close|default"),
        (lambda: S.panel_frame_key(F.lit("  ")), "default"),
        (lambda: S.file_name(F.lit("06"), F.lit("Icon_Item"), F.lit("red potion"), F.lit("Default"), F.lit(7)), "06_Icon_Item_RedPotion_Default_007.png"),
        (lambda: S.job_id(F.lit("Icon_Item"), F.lit(2)), "icon-item-sheet-02"),
        (lambda: S.path_is_safe(F.lit("Assets\\UI\\a.png"), "Assets/"), True),
        (lambda: S.path_is_safe(F.lit("Assets/../a.png")), False),
        (lambda: S.pixels_per_unit(F.lit(92 / 412)), 447.8261),
        (lambda: S.quality_status(F.lit(95), F.lit(1)), "blocked"),
        (lambda: S.quality_status(F.lit(66), F.lit(0)), "fair"),
        (lambda: S.choose_chroma_key(S.subject_colours(F.lit("an Emerald ring on violet silk"))), "#00FFFF"),
        (lambda: S.generation_budget(F.array(*map(F.lit, ["Panel", "Button", "Icon_Item"]))), 4),
        (lambda: S.generation_budget(F.array(*map(F.lit, ["Icon_Nav", "Icon_Status"]))), 2),
        (lambda: S.generation_budget(F.array(F.lit("Icon_Effect"))), 1),
        (lambda: S.is_sha256(F.lit("ab" * 32)), True),
        (lambda: S.managed_block(F.lit("a\nBEGIN\nold\nEND\nb"), F.lit("new $1"), "BEGIN", "END"), "a\nBEGIN\nnew $1\nEND\nb"),
        (lambda: R.reference_role(F.lit("canonical.png")), "canonical"),
    ],
)
def test_scalars(spark, column, want):
    assert value(spark, column()) == want


def test_canvas_edge_contact_costs_34_and_blocks(spark):
    issues = spark.createDataFrame([("j1", "canvas-edge-contact", "fail")], "job_id string, code string, severity string")
    jobs = spark.createDataFrame([("j1",), ("j2",)], "job_id string")
    got = {r.job_id: (r.score, r.status) for r in scoring.job_scores(issues, jobs).collect()}
    assert got == {"j1": (66, "blocked"), "j2": (100, "excellent")}
    empty = scoring.run_score(issues.limit(0), jobs.limit(0)).first()
    assert (empty.score, empty.status) == (100, "excellent")


def test_packing_starts_a_sheet_where_a_group_does_not_fit(spark):
    groups = spark.createDataFrame([("a", k, n) for k, n in enumerate((5, 9, 3, 8, 30))], "cat string, k int, n int")
    got = {r.name: r.sheet for r in tables.packed_sheets(groups, "cat", ["k"], "n", "k", 10).collect()}
    assert got == {"0": 1, "1": 2, "2": 3, "3": 4, "4": None}


def test_packing_gives_an_oversized_group_a_sheet_of_its_own_where_asked(spark):
    groups = spark.createDataFrame([("a", k, n) for k, n in enumerate((30, 5, 3, 12, 12, 2))] + [("b", 9, 4)], "cat string, k int, n int")
    got = {r.name: r.sheet for r in tables.packed_sheets(groups, "cat", ["k"], "n", "k", 10, oversized=True).collect()}
    assert got == {"0": 1, "1": 2, "2": 2, "3": 3, "4": 4, "5": 5, "9": 1}


def test_packing_keeps_no_category_whole(spark):
    groups = spark.range(0, 3000, 1, 4).select(F.lit("a").alias("cat"), F.col("id").alias("k"), (F.col("id") % 7 + 1).alias("n"))
    out = tables.packed_sheets(groups, "cat", ["k"], "n", "k", 16)
    assert "collect_list" not in out._jdf.queryExecution().executedPlan().toString()
    sheet, fill, want = 1, 0, {}
    for k in range(3000):
        n = k % 7 + 1
        sheet, fill = (sheet, fill + n) if fill + n <= 16 else (sheet + 1, n)
        want[str(k)] = sheet
    assert {r.name: r.sheet for r in out.collect()} == want


def test_concurrency_ignores_a_repeated_failure(spark):
    rows = [("a", k, e) for k, e in enumerate(["rate-limit", "timeout", "disconnect"])] + [("b", k, e) for k, e in enumerate(["timeout", "timeout"])]
    got = {r.run: r.effective for r in tables.concurrency(spark.createDataFrame(rows, "run string, k int, event string"), "run", ["k"], "event").collect()}
    assert got == {"a": 1, "b": 2}


def test_upsert_counts_and_last_writer(spark):
    rows = lambda x: spark.createDataFrame(x, "key string, at int, v string")
    old, new = rows([("a", 1, "x"), ("b", 1, "y"), ("b", 2, "z")]), rows([("b", 3, "w"), ("c", 1, "q")])
    got = {r.key: (r.v, r.action) for r in tables.upsert(old, new, "key", ["at"]).collect()}
    assert got == {"a": ("x", "kept"), "b": ("w", "updated"), "c": ("q", "added")}


def test_slots_give_the_remainder_to_the_first(spark):
    spec = spark.createDataFrame([(1, 100, 50, 3, 1, 10, 5, 2)], "layout_id int, width int, height int, columns int, rows int, margin int, gutter int, safe int")
    got = [(r.l, r.r, r.cx) for r in boxes.layout_slots(spec).orderBy("idx").collect()]
    assert got == [(10, 34, 22), (39, 62, 50), (67, 90, 78)]


def test_components_join_diagonally(spark):
    lit = {(0, 0), (1, 1), (2, 0), (5, 5), (5, 6), (7, 7)}
    pixels = spark.createDataFrame([(1, x, y, (x, y) in lit) for x in range(8) for y in range(8)], "i int, x int, y int, v boolean")
    got = sorted((r.pixels, r.l, r.t, r.r, r.b) for r in raster.components(pixels, "i", F.col("v")).collect())
    assert got == [(1, 7, 7, 8, 8), (2, 5, 5, 6, 7), (3, 0, 0, 3, 2)]


def test_empty_tables_give_empty_results(spark):
    none = spark.createDataFrame([], "image_id int, comp_id int, pixels int, l int, t int, r int, b int")
    assert boxes.overlapping_pairs(none, "image_id", "comp_id").isEmpty()
    assert boxes.row_major(none, "image_id").isEmpty()
    assert boxes.classified_components(none, ["image_id"]).isEmpty()


def test_run_totals_take_every_issue(spark):
    found = table_queries.quality_run_totals(spark, SF).first()
    rows = scoring.scored(standins.issues(spark, SF)).select("job_id", "severity", "penalty").collect()
    assert found.hard_blockers == sum(r.severity == "fail" for r in rows)
    assert found.deduction == sum(r.penalty for r in rows if int(r.job_id.split("-")[0]) % 7 == 0)
    assert found.score == max(0, found.job_mean - found.deduction)
