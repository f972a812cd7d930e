"""Pack validation over PNG files, one defect after the other, against what each must report."""

import numpy as np
import pytest

from packloom.operators import validation
from packloom.sources import files

ENTRY = "pack string, ord int, id string, job_id string, category string, output string, width int, height int, category_index int, chroma_key string, transparency_mode string, alpha_origin string, source_sha256 string, alpha_provenance string, alpha_matte string, alpha_matte_sha256 string"


def disc(size=32, alpha=255, colour=(200, 40, 60), soft=False):
    y, x = np.mgrid[:size, :size]
    d = np.hypot(x - size / 2, y - size / 2)
    a = np.clip((size / 2 - 3 - d) * 40, 0, alpha) if soft else np.where(d < size / 2 - 3, alpha, 0)
    out = np.zeros((size, size, 4), np.uint8)
    out[..., 3] = a
    out[a > 0, :3] = colour
    return out


def entry(k, **other):
    row = {"pack": "p", "ord": k, "id": f"a{k}", "job_id": "j1", "category": "Icon_Item", "output": f"final/Icon_Item/06_Icon_Item_Item_Default_{k:03d}.png", "width": 32, "height": 32, "category_index": k, "chroma_key": "#00FF00", "transparency_mode": "chroma-key", "alpha_origin": None, "source_sha256": None, "alpha_provenance": None, "alpha_matte": None, "alpha_matte_sha256": None}
    return row | other


@pytest.fixture
def validate(spark, tmp_path):
    def run(entries, pictures, extra=(), expected=None, strict=False, more=None):
        for path, rgba in {**pictures, **dict.fromkeys(extra)}.items():
            (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / path).write_bytes(b"{}" if rgba is None else files.png(rgba.shape[1], rgba.shape[0], rgba.tobytes()))
        from pyspark.sql import functions as F

        name = lambda c: F.regexp_replace(c, f"^file:/*{str(tmp_path).lstrip('/')}/", "")
        root = f"{tmp_path}/final" if pictures else str(tmp_path)
        images = files.packed_images(files.images(spark, f"{root}/*/*.png")).select(F.lit("p").alias("pack"), name(F.col("path")).alias("file"), "width", "height", "channels", "rgba") if pictures else spark.createDataFrame([], "pack string, file string, width int, height int, channels int, rgba binary")
        listed = files.listing(spark, str(tmp_path), "*") if pictures else None
        there = listed.select(F.lit("p").alias("pack"), name(F.col("path")).alias("file")) if listed is not None else spark.createDataFrame([], "pack string, file string")
        packs = spark.createDataFrame([("p", len(entries) if expected is None else expected, None)], "pack string, expected int, chroma_key string")
        rows = spark.createDataFrame([tuple(e[c.split()[0]] for c in ENTRY.split(", ")) for e in entries], ENTRY)
        found = validation.pack_issues(packs, rows, images, there, strict, more)
        report = validation.pack_reports(packs, rows, found).collect()
        return sorted(((r.stage, r.ord, r.severity, r.code, r.asset_id) for r in found.collect()), key=repr), report[0], validation.pack_quality(rows, found).collect()[0]

    return run


def test_a_clean_pack_passes(validate):
    entries = [entry(1), entry(2)]
    issues, report, quality = validate(entries, {e["output"]: disc() for e in entries})
    assert issues == []
    assert (report.ok, report.valid_assets, report.pass_count, quality.score) == (True, 2, 2, 100)


def test_every_defect_has_its_code(validate):
    hidden, green, opaque = disc(), disc(colour=(4, 250, 3)), np.full((32, 32, 4), 255, np.uint8)
    hidden[0, 0] = (9, 9, 9, 0)
    opaque[..., :3] = (200, 40, 60)
    spill = disc(colour=(90, 160, 80))
    native = {"transparency_mode": "native-alpha-required", "chroma_key": None}
    matte = {"transparency_mode": "model-matte-derived", "chroma_key": None}
    whole = {"alpha_origin": "model-native", "source_sha256": "0" * 64, "alpha_provenance": "final/Icon_Item/x.provenance.json"}
    entries = [
        entry(1),
        entry(2, output="final/Icon_Item/06_Icon_Item_Item_Default_001.png"),
        entry(3, output="final/Icon_Item/07_Icon_Item_Item_Default_003.png"),
        entry(4, output="final/Icon_Item/plain.png", category="Other", category_index=0),
        entry(5),
        entry(6),
        entry(7),
        entry(8),
        entry(9, width=33),
        entry(10),
        entry(11),
        entry(12, **native),
        entry(13, **native, **whole),
        entry(14, **matte, alpha_matte="final/Icon_Item/gone-alpha-matte.png"),
        entry(15, chroma_key="green"),
    ]
    pictures = {e["output"]: disc() for e in entries if e["ord"] != 5}
    pictures |= {entries[5]["output"]: np.zeros((32, 32, 4), np.uint8), entries[6]["output"]: opaque, entries[7]["output"]: hidden, entries[9]["output"]: green, entries[10]["output"]: spill, entries[12]["output"]: disc(soft=True), entries[14]["output"]: green}
    issues, report, quality = validate(entries, pictures, extra=["final/Icon_Item/x.provenance.json", "elsewhere/a.png"])
    assert issues == sorted(
        [
            (1, 2, "fail", "duplicate-output", "a2"),
            (1, 3, "fail", "category-prefix-mismatch", "a3"),
            (1, 4, "fail", "invalid-filename", "a4"),
            (1, 5, "fail", "missing-file", "a5"),
            (1, 6, "fail", "empty-alpha", "a6"),
            (1, 7, "warning", "no-transparent-padding", "a7"),
            (1, 8, "fail", "hidden-rgb-under-zero-alpha", "a8"),
            (1, 9, "fail", "dimension-mismatch", "a9"),
            (1, 10, "fail", "visible-chroma-residue", "a10"),
            (1, 10, "fail", "visible-chroma-spill", "a10"),
            (1, 11, "fail", "visible-chroma-spill", "a11"),
            *((1, 12, "fail", f"native-alpha-{x}", "a12") for x in ("layering-lost", "origin-missing", "provenance-missing", "source-hash-missing")),
            *((1, 14, "fail", x, "a14") for x in ("model-matte-origin-missing", "source-sha256-missing", "alpha-matte-sha256-missing", "alpha-matte-file-missing", "model-matte-layering-lost")),
            (2, 0, "fail", "non-continuous-category-indices", None),
        ],
        key=repr,
    )
    assert (report.ok, report.manifest_count, report.valid_assets, report.warning_count) == (False, 15, 12, 1)
    # Files of the duplicate and of the entry before it are the same one.
    assert report.pass_count == 15 - 12 and quality.hard_blockers == report.fail_count


def test_counts_strays_and_other_checks(validate, spark):
    entries = [entry(1), entry(2)]
    more = spark.createDataFrame([("p", entries[0]["output"], "fail", "panel-stretch-band-decoration"), ("p", "final/none.png", "fail", "x")], "pack string, file string, severity string, code string")
    pictures = {e["output"]: disc() for e in entries} | {"final/Icon_Item/stray.png": disc()}
    issues, report, _ = validate(entries, pictures, expected=3, strict=True, more=more)
    assert issues == sorted([(0, 0, "fail", "count-mismatch", None), (1, 1, "fail", "panel-stretch-band-decoration", "a1"), (3, 0, "fail", "unexpected-files", None)], key=repr)
    assert (report.expected_count, report.pass_count, report.fail_count) == (3, 1, 3)


def test_packs_without_entries_or_files(validate):
    issues, report, quality = validate([], {}, expected=2)
    assert issues == [(0, 0, "fail", "count-mismatch", None)] and (report.ok, report.manifest_count) == (False, 0)
    issues, report, _ = validate([entry(1)], {})
    assert issues == [(1, 1, "fail", "missing-file", "a1")] and report.valid_assets == 0
