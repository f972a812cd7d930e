"""Diagnosis of small sheets: kinds, thresholds, reading order, issues, odd rows, and the way from a sheet to finished assets."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from packloom.__main__ import main
from packloom.operators import corrections, diagnosis, inference, raster
from packloom.sources import files

ROWS = "project string, category string, width int, height int, rgba binary"


def solid(w, h, colour, alpha=255):
    a = np.zeros((h, w, 4), np.uint8)
    a[...] = (*colour, alpha)
    return a


def row(project, a, category="Icon_Item"):
    return (project, category, None if a is None else a.shape[1], None if a is None else a.shape[0], None if a is None else a.tobytes())


def checkers(w=48, h=40, tile=4):
    y, x = np.mgrid[:h, :w]
    a = solid(w, h, (0, 0, 0))
    a[..., :3] = np.where((x // tile + y // tile) % 2, 200, 120)[..., None]
    return a


def sample_sheets():
    alpha = solid(60, 40, (0, 0, 0), 0)
    alpha[4:16, 30:42] = (200, 20, 30, 255)
    alpha[6:18, 8:20] = (20, 30, 200, 255)
    alpha[24:36, 46:60] = (9, 9, 9, 120)
    alpha[30:33, 4:7] = (1, 2, 3, 255)
    flat = solid(60, 40, (0, 255, 0))
    flat[10:26, 14:30, :3] = (200, 20, 30)
    checker = checkers()
    checker[10:24, 10:30, :3] = (250, 10, 10)
    y, x = np.mgrid[:40, :60]
    mixed = solid(60, 40, (0, 0, 0))
    mixed[..., 0], mixed[..., 1] = x * 4, y * 6
    return {"alpha": alpha, "flat": flat, "checker": checker, "mixed": mixed, "bare": solid(60, 40, (0, 255, 0))}


@pytest.fixture(scope="module")
def found(spark):
    return diagnosis.diagnosed(spark.createDataFrame([row(k, a) for k, a in sample_sheets().items()], ROWS))


def test_kinds_and_counts(found):
    reports = {r.project: r for r in found.reports.collect()}
    assert {k: r.classification for k, r in reports.items()} == {"alpha": "alpha-sheet", "flat": "flat-background-sheet", "checker": "checkerboard-presentation", "mixed": "opaque-mixed-image", "bare": "flat-background-sheet"}
    assert {k: (r.status, r.candidate_count, r.warning_count, r.fail_count) for k, r in reports.items() if k != "mixed"} == {
        "alpha": ("ready-for-review", 3, 2, 0),
        "flat": ("ready-for-review", 1, 0, 0),
        "checker": ("manual-review-required", 1, 0, 1),
        "bare": ("manual-review-required", 0, 0, 1),
    }
    flat, checker = reports["flat"].background, reports["checker"].background
    assert (flat.color, flat.transparent_threshold, flat.opaque_threshold, flat.confidence, flat.auto_apply, flat.border_coverage) == ("#00FF00", 12.0, 96.0, "high", True, 1.0)
    assert (checker.tile_size, checker.export_supported, sorted(checker.colors), checker.pattern_score) == (4, False, ["#787878", "#C8C8C8"], 1.0)


def test_candidates_in_reading_order(found):
    rows = [(r.source_index, r.bbox, r.semantic_name, r.severity) for r in found.candidates.where("project = 'alpha'").orderBy("position").collect()]
    # The part of under 64 pixels isn't one; boxes come by line, then from the left; those that reach the edge warn.
    assert rows == [(1, [4, 2, 24, 22], "Asset001", "info"), (2, [26, 0, 46, 20], "Asset002", "warning"), (3, [42, 20, 60, 40], "Asset003", "warning")]


def test_issues_in_order(found):
    codes = {}
    for r in found.issues.orderBy("project", "ord").collect():
        codes.setdefault(r.project, []).append((r.severity, r.code, r.location))
    assert codes["bare"] == [("fail", "no-candidates", "assets")]
    assert codes["checker"] == [("fail", "fake-checkerboard-background", "background.mode")]
    assert codes["mixed"][0] == ("fail", "unresolved-opaque-background", "background.mode")
    assert "flat" not in codes


def test_odd_rows_have_a_result(spark):
    rows = [row("null", None), row("hat", solid(8, 8, (0, 0, 0)), "Hat"), row("none", solid(8, 8, (0, 0, 0)), None), ("empty", "Button", 0, 5, b""), row("dot", solid(1, 1, (3, 3, 3))), row("line", solid(300, 1, (3, 3, 3), 200))]
    sheets = spark.createDataFrame(rows, ROWS).withColumn("status", F.lit("clash")).withColumn("codes", F.lit(1))
    found = diagnosis.diagnosed(sheets)
    codes = {r.project: r.code for r in found.issues.where("severity = 'fail'").collect()}
    assert codes == {"null": "source-decode-failed", "empty": "source-decode-failed", "hat": "unsupported-category", "none": "unsupported-category", "dot": "no-candidates"}
    reports = {r.project: (r.status, r.candidate_count) for r in found.reports.collect()}
    assert reports["line"] == ("ready-for-review", 1) and reports["null"] == ("manual-review-required", 0) and len(reports) == 6
    assert {r.project for r in diagnosis.documents(found).collect()} == {"dot", "line"}
    none = diagnosis.diagnosed(sheets.where("false"))
    assert [df.count() for df in (none.reports, none.candidates, none.issues, diagnosis.documents(none))] == [0, 0, 0, 0]


def exploded(spark, sheets):
    rows = [(k, int(x), int(y), *map(int, a[y, x])) for k, a in sheets.items() for y in range(a.shape[0]) for x in range(a.shape[1])]
    return spark.createDataFrame(rows, "image string, x int, y int, r int, g int, b int, a int")


def test_kernels_equal_the_pixel_operators(spark):
    rng = np.random.default_rng(5)
    sheets = {}
    for k in range(6):
        a = checkers(24, 20, 2 + k % 3)
        for _ in range(3):
            y, x = rng.integers(0, 14, 2)
            a[y : y + 5, x : x + 6, :3] = rng.integers(0, 256, 3)
        sheets[f"c{k}"] = a
        b = solid(24, 20, (0, 255, 0))
        b[..., :3] = np.clip(b[..., :3].astype(int) - rng.integers(0, 1 + 16 * k, (20, 24, 3)), 0, 255)
        b[6:14, 6:18, :3] = rng.integers(0, 256, 3)
        sheets[f"n{k}"] = b
    pixels = exploded(spark, sheets)
    boards = {r.image: (r.first, r.second, r.tile, r.coverage, r.score) for r in inference.checkerboards(pixels, "image").collect()}
    own = {k: diagnosis.checkerboard(a[..., :3]) for k, a in sheets.items()}
    assert boards == {k: (*f[0]["colors"], f[0]["tile_size"], round(f[0]["coverage"], 6), round(f[0]["pattern_score"], 6)) for k, f in own.items() if f} and boards
    far = pixels.withColumn("d", F.sqrt(F.pow("r", F.lit(2)) + F.pow(F.col("g") - 255, F.lit(2)) + F.pow("b", F.lit(2))))
    for r in raster.border_thresholds(far, "image", "d", 24, 20, 5).collect():
        # The pixel operator takes its inner part from the strip, the kernel from the fixed width; here both are whole.
        got = diagnosis.thresholds(diagnosis._far(sheets[r.image][..., :3], np.array([0, 255, 0])), 5)
        assert (got["transparent_threshold"], got["opaque_threshold"], got["confidence"]) == (r.transparent, r.opaque, r.confidence)
    parts = {(r.image, r.pixels, r.l, r.t, r.r, r.b) for r in raster.components(pixels, "image", F.col("g") > 150, 3).collect()}
    assert parts == {(k, *map(int, p)) for k, a in sheets.items() for p in diagnosis.labelled(a[..., 1] > 150) if p[0] >= 3}


def test_approved_documents_become_assets(spark, found, tmp_path):
    sheets = sample_sheets()
    whole = diagnosis.documents(found).where("project in ('alpha', 'flat', 'checker')")
    path = str(tmp_path / "documents")
    whole.withColumn("approved", F.lit(True)).write.json(path)
    read = spark.read.schema("project string, " + corrections.DOCUMENT).json(path)
    table = spark.createDataFrame([(k, a.shape[1], a.shape[0], a.tobytes()) for k, a in sheets.items()], "project string, width int, height int, rgba binary")
    done = corrections.applied(*corrections.split(read), table)
    reports = {r.project: (r.status, r.manifest_count) for r in done.reports.collect()}
    # The box that the sheet's edge cuts is for somebody to mend first.
    assert reports == {"alpha": ("failed", 0), "flat": ("complete", 1), "checker": ("failed", 0)}
    assert {(r.project, r.code) for r in done.issues.collect()} == {("alpha", "bbox-cuts-foreground"), ("checker", "fake-checkerboard-background")}
    entry = done.entries.first()
    assert (entry.id, entry.width, entry.height, entry.alignment) == ("06_Icon_Item_Asset001_Default_001", 128, 128, "center")
    waiting = corrections.applied(*corrections.split(whole.where("project = 'flat'").selectExpr("project", *(c for c in read.columns if c != "project"))), table)
    assert [r.code for r in waiting.issues.collect()] == ["corrections-not-approved"]


def test_overlays_mark_candidates(spark, found):
    sheets = sample_sheets()
    table = spark.createDataFrame([row(k, a) for k, a in sheets.items()] + [row("gone", None)], ROWS)
    drawn = {r.project: np.frombuffer(r.rgba, np.uint8).reshape(r.height, r.width, 4) for r in diagnosis.overlays(found.candidates, table).collect()}
    assert set(drawn) == set(sheets) and (drawn["bare"] == sheets["bare"]).all()
    box = found.candidates.where("project = 'flat'").first().bbox
    assert tuple(drawn["flat"][box[1], box[0]]) == (*diagnosis.COLOURS["info"], 255)
    assert (drawn["flat"][14:22, 18:26] == sheets["flat"][14:22, 18:26]).all()


def test_command_line_from_sheet_to_assets(spark, tmp_path, capsys):
    a = solid(60, 40, (0, 255, 0))
    a[10:26, 8:22, :3] = (200, 20, 30)
    a[12:28, 34:50, :3] = (20, 30, 200)
    (tmp_path / "sheet.png").write_bytes(files.png(60, 40, a.tobytes()))
    base = ["diagnose", "--input", str(tmp_path / "sheet.png"), "--project-id", "bag", "--output", str(tmp_path / "found")]
    assert main([*base, "--category", "Icon_Item"]) == 0
    report = json.loads(capsys.readouterr().out)
    assert (report["classification"], report["candidate_count"], report["fail_count"]) == ("flat-background-sheet", 2, 0)
    assert (tmp_path / "found/qa/candidates.png").exists()
    written = next((tmp_path / "found/corrections").glob("part-*"))
    document = json.loads(written.read_text())
    assert document["approved"] is False and [x["bbox"] for x in document["assets"]] == [[4, 6, 26, 30], [30, 8, 54, 32]]
    apply = ["correct", "--input", str(tmp_path / "sheet.png"), "--project-id", "bag", "--corrections", str(tmp_path / "fixed.json"), "--output", str(tmp_path / "done")]
    (tmp_path / "fixed.json").write_text(json.dumps(document))
    assert main(apply) == 2
    capsys.readouterr()
    (tmp_path / "fixed.json").write_text(json.dumps(document | {"approved": True}, indent=2))
    assert main([*apply, "--force"]) == 0
    assert json.loads(capsys.readouterr().out)["manifest_count"] == 2
    assert len(list((tmp_path / "done/final/Icon_Item").glob("*.png"))) == 2
    assert main([*base, "--category", "Hat", "--force"]) == 2
