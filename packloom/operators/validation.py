"""Validation of whole packs: manifest entries against decoded images, file listings and what was expected.

An image is one row of packed bytes; its figures are taken in one Arrow pass, so no pixel is shuffled. All checks of
an entry are one rule array over the joined row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions import constants as C
from packloom.functions import scalars as S

from .scoring import run_totals

#: Alpha that counts as visible, distance and spill of visible residue, spilt pixels and alpha levels allowed.
VISIBLE, RESIDUE, SPILL, SPILT_MOST, LEVELS_LEAST = 16, 12, 40, 16, 8
#: Modes that keep layered alpha, and the origin that each must name.
NATIVE, MATTE, ORIGINS = "native-alpha-required", "model-matte-derived", {"native-alpha-required": "model-native", "model-matte-derived": "gpt-image-2-matte-derived"}
_FIGURES = "opaque long, transparent long, hidden long, partial long, levels long, residue long, spilt long"


def figures(rgba: np.ndarray, key: tuple[int, int, int] | None) -> tuple[int, ...]:
    """Pixels with and without alpha, coloured ones without, partly transparent ones, alpha levels, residue of the key, spill."""
    alpha, rgb = rgba[..., 3], rgba[..., :3].astype(np.int32)
    none = alpha == 0
    partial = (alpha > 0) & (alpha < 255)
    residue = spilt = 0
    if key is not None:
        visible, k = alpha >= VISIBLE, np.array(key)
        residue = int((visible & (((rgb - k) ** 2).sum(axis=-1) <= RESIDUE * RESIDUE)).sum())
        high, low = np.flatnonzero(k >= 240), np.flatnonzero(k <= 15)
        if len(high) and len(low):
            spilt = int((visible & (rgb[..., high].min(axis=-1) - rgb[..., low].max(axis=-1) >= SPILL)).sum())
    counts = (~none).sum(), none.sum(), (none & (rgb != 0).any(axis=-1)).sum(), partial.sum()
    return *map(int, counts), int(np.count_nonzero(np.bincount(alpha.ravel(), minlength=256))), residue, spilt


def image_figures(images: DataFrame, pack: str = "pack", file: str = "file") -> DataFrame:
    """images (pack, file, width, height, channels, rgba, key struct<r,g,b>) with `figures` in place of the bytes; null bytes have none."""
    kinds = dict(images.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for w, h, data, key in zip(*(batch.column(k).to_pylist() for k in (2, 3, 5, 6)), strict=True):
                known = key is not None and None not in key.values()
                rows.append(figures(np.frombuffer(data, np.uint8).reshape(h, w, 4), (key["r"], key["g"], key["b"]) if known else None) if data is not None else (None,) * 7)
            values = [pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 7
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(5)), *values], [*batch.schema.names[:5], *(x.split()[0] for x in _FIGURES.split(", "))])

    rows = images.selectExpr(f"`{pack}`", f"`{file}`", "cast(width as int)", "cast(height as int)", "cast(channels as int)", "rgba", "key")
    return rows.mapInArrow(run, f"`{pack}` {kinds[pack]}, `{file}` {kinds[file]}, width int, height int, channels int, {_FIGURES}")


def _rules() -> dict[str, tuple[str, Column, bool]]:
    """code -> (severity, predicate, whether the checks after it are left out)."""
    name = F.element_at(F.split("output", "/"), -1)
    prefix = F.lit(None).cast("string")
    for row in C.CATEGORIES:
        prefix = F.when(F.col("category") == row[0], row[1]).otherwise(prefix)
    categories = "|".join(row[0] for row in C.CATEGORIES)
    mode = F.coalesce("transparency_mode", F.lit(""))
    rules = {
        "duplicate-output": ("fail", F.col("copy") > 1, True),
        "invalid-filename": ("fail", ~name.rlike(rf"^(0[1-9])_({categories})_[A-Za-z0-9]+_[A-Za-z0-9]+_\d{{3}}\.png$"), False),
        "category-prefix-mismatch": ("fail", prefix.isNotNull() & ~F.startswith(name, F.concat(prefix, F.lit("_"), F.col("category"), F.lit("_"))), False),
        "missing-file": ("fail", F.col("channels").isNull(), True),
        "not-rgba": ("fail", F.col("channels") != 4, False),
        "empty-alpha": ("fail", F.col("opaque") == 0, True),
        "no-transparent-padding": ("warning", F.col("transparent") == 0, False),
        "hidden-rgb-under-zero-alpha": ("fail", F.col("hidden") > 0, False),
        "dimension-mismatch": ("fail", (F.coalesce("width", "w") != F.col("w")) | (F.coalesce("height", "h") != F.col("h")), False),
        "visible-chroma-residue": ("fail", F.col("residue") > 0, False),
        "visible-chroma-spill": ("fail", F.col("spilt") > SPILT_MOST, False),
    }
    layered = (F.col("partial") == 0) | (F.col("levels") < LEVELS_LEAST)
    hashed = lambda c: ~F.coalesce(S.is_sha256(F.col(c)), F.lit(False))
    for kind, codes, side in ((NATIVE, "native-alpha-{}", "alpha_provenance"), (MATTE, "model-matte-{}", "alpha_matte")):
        ending = ".provenance.json" if kind == NATIVE else "-alpha-matte.png"
        named = F.endswith(F.coalesce(side, F.lit("")), F.lit(ending))
        on = mode == kind
        rules[codes.format("origin-missing")] = ("fail", on & ~F.coalesce(F.col("alpha_origin") == ORIGINS[kind], F.lit(False)), False)
        if kind == NATIVE:
            rules["native-alpha-source-hash-missing"] = ("fail", on & hashed("source_sha256"), False)
            rules["native-alpha-provenance-missing"] = ("fail", on & ~named, False)
            rules["native-alpha-provenance-file-missing"] = ("fail", on & named & F.col("side_file").isNull(), False)
        else:
            rules["source-sha256-missing"] = ("fail", on & hashed("source_sha256"), False)
            rules["alpha-matte-sha256-missing"] = ("fail", on & hashed("alpha_matte_sha256"), False)
            rules["alpha-matte-path-missing"] = ("fail", on & ~named, False)
            rules["alpha-matte-file-missing"] = ("fail", on & named & F.col("side_file").isNull(), False)
        rules[codes.format("layering-lost")] = ("fail", on & layered, False)
    return rules


def pack_issues(packs: DataFrame, entries: DataFrame, images: DataFrame, files: DataFrame, strict: bool = False, more: DataFrame | None = None) -> DataFrame:
    """(pack, stage, ord, severity, code, file, job_id, asset_id, category, files) of all packs.

    packs: pack, expected (count), chroma_key. entries: pack, ord, id, job_id, category, output, width, height,
    category_index, chroma_key, transparency_mode, alpha_origin, source_sha256, alpha_provenance, alpha_matte,
    alpha_matte_sha256. images: pack, file, width, height, channels, rgba (one row a file). files: pack, file (a listing). more: issues
    (pack, file, severity, code) of other checks, as of stretch bands, told for entries whose image was read.

    Stages: 0 counts, 1 entries in order, 2 indices of a category that aren't 1 ... n, 3 listed PNGs below the folders
    of entries that no entry names (failures if strict). An output that is named again has that issue alone; an entry
    without a file, or without a visible pixel, is not checked further. Keys of an entry go before its pack's; what is
    no colour is no key. Repeated packs or listings count once.
    """
    packs = packs.dropDuplicates(["pack"])
    given = packs.select("pack", F.col("chroma_key").alias("_pack_key"), F.col("expected").alias("_expected"))
    again = F.row_number().over(Window.partitionBy("pack", "output").orderBy("ord"))
    listed = entries.withColumn("copy", again).withColumn("output", F.translate("output", "\\", "/"))
    keyed = listed.join(given, "pack", "left").withColumn("_key", S.hex_to_rgb(F.coalesce("chroma_key", "_pack_key"), hash_required=True))
    wanted = keyed.where("copy = 1").select("pack", F.col("output").alias("file"), F.col("_key").alias("key"))
    seen = image_figures(images.join(wanted, ["pack", "file"])).withColumnsRenamed({"file": "output", "width": "w", "height": "h"})
    side = F.when(F.col("transparency_mode") == NATIVE, F.col("alpha_provenance")).when(F.col("transparency_mode") == MATTE, F.col("alpha_matte"))
    there = files.select("pack", F.translate("file", "\\", "/").alias("file")).distinct()
    rows = keyed.join(seen, ["pack", "output"], "left").withColumn("side", side)
    rows = rows.join(there.select("pack", F.col("file").alias("side"), F.lit(True).alias("side_file")), ["pack", "side"], "left")

    rules = _rules()
    found = F.array_compact(F.array(*(F.when(when, F.struct(F.lit(k).alias("rule"), F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.lit(stop).alias("stop"))) for k, (code, (severity, when, stop)) in enumerate(rules.items()))))
    # Up to and with the first that stops: the next one's predecessors have none.
    upto = F.aggregate(found, F.lit(len(rules)), lambda acc, x: F.when(x["stop"] & (x["rule"] < acc), x["rule"]).otherwise(acc))
    told = rows.withColumn("found", found).withColumn("upto", upto).select("pack", "ord", F.col("output").alias("file"), "job_id", "id", "category", F.explode(F.filter("found", lambda x: x["rule"] <= F.col("upto"))).alias("x"))
    nothing = lambda kind: F.lit(None).cast(kind)

    def issues(df: DataFrame, stage: int, order: Column, severity: Column, code: Column, **columns: Column) -> DataFrame:
        named = {"file": "string", "job_id": "string", "asset_id": "string", "category": "string", "files": "array<string>"}
        return df.select("pack", F.lit(stage).alias("stage"), order.cast("long").alias("ord"), severity.alias("severity"), code.alias("code"), *(columns.get(c, nothing(kind)).cast(kind).alias(c) for c, kind in named.items()))

    fail, first = F.lit("fail"), F.lit(0)
    counts = packs.join(entries.groupBy("pack").count(), "pack", "left").where(F.coalesce("count", F.lit(0)) != F.col("expected"))
    out = issues(counts, 0, first, fail, F.lit("count-mismatch"))
    own = {"file": F.col("file"), "job_id": F.col("job_id"), "asset_id": F.nullif(F.col("id"), F.lit("")), "category": F.col("category")}
    out = out.unionByName(issues(told, 1, F.col("ord"), F.col("x.severity"), F.col("x.code"), **own))
    if more is not None:
        read = rows.where("copy = 1 AND opaque > 0").select("pack", "ord", F.col("output").alias("file"), "job_id", "id", "category")
        out = out.unionByName(issues(read.join(more.select("pack", "file", "severity", "code"), ["pack", "file"]), 1, F.col("ord"), F.col("severity"), F.col("code"), **own))
    indices = keyed.where("copy = 1 AND category_index > 0").groupBy("pack", "category").agg(F.min("category_index").alias("low"), F.max("category_index").alias("high"), F.count_distinct("category_index").alias("kinds"), F.count("*").alias("n"))
    out = out.unionByName(issues(indices.where("low <> 1 OR high <> n OR kinds <> n"), 2, first, fail, F.lit("non-continuous-category-indices"), category=F.col("category")))
    # The first folder of a file, '.' for files without one, which stands for the whole listing.
    folder = lambda c: F.when(F.contains(c, F.lit("/")), F.split_part(c, F.lit("/"), F.lit(1))).otherwise(".")
    roots = listed.select("pack", folder(F.col("output")).alias("root")).distinct()
    below = there.where(F.endswith("file", F.lit(".png"))).select("pack", "file", F.explode(F.array_distinct(F.array(folder(F.col("file")), F.lit(".")))).alias("root"))
    stray = below.join(roots, ["pack", "root"], "left_semi").select("pack", "file").distinct().join(listed.select("pack", F.col("output").alias("file")), ["pack", "file"], "left_anti")
    strays = stray.groupBy("pack").agg(F.array_sort(F.collect_list("file")).alias("stray"))
    return out.unionByName(issues(strays, 3, first, F.lit("fail" if strict else "warning"), F.lit("unexpected-files"), files=F.col("stray")))


#: Issues after which an entry is no valid asset.
BLOCKING = ("duplicate-output", "missing-file", "empty-alpha")


def pack_reports(packs: DataFrame, entries: DataFrame, issues: DataFrame) -> DataFrame:
    """pack, ok, expected_count, manifest_count, valid_assets, pass_count, warning_count, fail_count of each pack.

    An asset passes if no issue names its file; a pack is ok without failures if all its entries are valid.
    """
    per = issues.groupBy("pack").agg(F.count_if(F.col("severity") == "warning").alias("warning_count"), F.count_if(F.col("severity") == "fail").alias("fail_count"), F.count_distinct("file").alias("named"), F.count_if(F.col("code").isin(*BLOCKING)).alias("blocked"))
    rows = packs.dropDuplicates(["pack"]).select("pack", F.col("expected").cast("long").alias("expected_count")).join(entries.groupBy("pack").agg(F.count("*").alias("manifest_count")), "pack", "left").join(per, "pack", "left").na.fill(0)
    valid = F.col("manifest_count") - F.col("blocked")
    ok = (F.col("fail_count") == 0) & (valid == F.col("manifest_count"))
    return rows.select("pack", ok.alias("ok"), "expected_count", "manifest_count", valid.alias("valid_assets"), F.greatest(F.lit(0), F.col("manifest_count") - F.col("named")).alias("pass_count"), "warning_count", "fail_count")


def pack_quality(entries: DataFrame, issues: DataFrame) -> DataFrame:
    """Scores of one pack's jobs and issues together, as `scoring.run_totals` has them; entries without a job are qa-only."""
    named = issues.select(F.col("stage").alias("ord"), F.coalesce("job_id", F.when(F.col("file").isNotNull(), "qa-only")).alias("job_id"), "asset_id", "code", "severity", "file")
    return run_totals(named, entries.select(F.coalesce("job_id", F.lit("qa-only")).alias("job_id")).distinct())
