"""From generated sheets to finished assets: backgrounds removed, components labelled and dealt to slots, crops normalised.

A sheet is one row of packed bytes and one task's work; what is found in it (components, boxes, entries, issues) are
narrow rows that joins and groupings go on with. Jobs, assets and slots are those of `planning.batch_plan`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packloom.functions import constants as C
from packloom.functions import scalars as S

from . import boxes, validation
from .kernels import chroma_removed, resized_rgba
from .lineage import cut
from .planning import MODES, Plan

#: Alpha of a component's pixels, its least pixels, room around a crop, thresholds of a chroma key.
VISIBLE, LEAST_PIXELS, TRIM, TRANSPARENT, OPAQUE = 16, 16, 2, 12.0, 96.0
#: How far the shape of a sheet may be from its canvas; share of a sheet's shorter side that its border has, and most.
SHAPE, BORDER_SHARE, BORDER_MOST = 0.01, 4, 8
#: Background route -> origin of alpha.
ORIGINS = {"native-alpha": "model-native", "model-matte-derived": "gpt-image-2-matte-derived", "chroma-key": "chroma-derived", "existing-alpha": "existing-alpha-unverified"}
KEYS = ["project", "job_id"]


@dataclass(frozen=True)
class Run:
    """Sheets with their alpha, manifest entries, finished images and all issues of a run."""

    sheets: DataFrame
    entries: DataFrame
    images: DataFrame
    issues: DataFrame


# ---------------------------------------------------------------- kernels of one sheet


def matte_applied(rgba: np.ndarray, matte: np.ndarray, strip: int = BORDER_MOST) -> np.ndarray:
    """Colours freed of the border's median colour under the alpha that a matte's luma gives; cut off, not rounded."""
    h, w = rgba.shape[:2]
    alpha = matte[..., :3].astype(np.float64) @ np.array(C.LUMA) / 255.0
    n = max(1, min(strip, min(h, w) // BORDER_SHARE))
    rim = np.ones((h, w), bool)
    rim[n : h - n, n : w - n] = False
    ground = np.median(rgba[rim][:, :3], axis=0)
    colours = np.clip((rgba[..., :3] - (1 - alpha)[..., None] * ground) / np.maximum(alpha, 1 / 255)[..., None], 0, 255)
    level = np.clip(alpha * 255 + 1e-9, 0, 255).astype(np.uint8)
    return np.concatenate([np.where(level[..., None] > 0, colours + 1e-9, 0).clip(0, 255).astype(np.uint8), level[..., None]], axis=2)


def without_background(rgba: np.ndarray, mode: str, key: tuple[int, int, int] | None, matte: np.ndarray | None, thresholds: tuple[float, float]) -> tuple[np.ndarray | None, str]:
    """(RGBA, route) of a sheet; nothing where its mode lacks a matte or a key."""
    if mode == "model-matte-derived":
        if matte is None:
            return None, mode
        return matte_applied(rgba, matte if matte.shape == rgba.shape else resized_rgba(matte, rgba.shape[1], rgba.shape[0])), mode
    if mode == "native-alpha-required" or (rgba[..., 3] < 255).any():
        return np.where(rgba[..., 3:] > 0, rgba, 0).astype(np.uint8), "native-alpha" if mode == "native-alpha-required" else "existing-alpha"
    return (chroma_removed(rgba[..., :3], key, *thresholds) if key is not None else None), "chroma-key"


def labelled(mask: np.ndarray) -> np.ndarray:
    """One row (pixels, l, t, r, b) for each 8-connected component, the largest first, equal ones as they are met.

    Runs of a line are linked to those of the next that they touch, corners included; each takes the least run that
    its links reach, halving paths until nothing changes.
    """
    step = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    y, left = np.nonzero(step == 1)
    right = np.nonzero(step == -1)[1]
    wide = mask.shape[1] + 2
    low = np.searchsorted(y * wide + right, (y + 1) * wide + left, "left")
    high = np.searchsorted(y * wide + left, (y + 1) * wide + right, "right")
    links = np.maximum(high - low, 0)
    a = np.repeat(np.arange(len(y)), links)
    b = np.repeat(low - (np.cumsum(links) - links), links) + np.arange(links.sum())
    root = np.arange(len(y))
    while True:
        least = np.minimum(root[a], root[b])
        now = root.copy()
        for side in (a, b):
            np.minimum.at(now, root[side], least)
        now = now[now]
        if (now == root).all():
            break
        root = now
    heads, own = np.unique(root, return_inverse=True)
    out = np.zeros((len(heads), 5), np.int64)
    out[:, 1:3] = np.iinfo(np.int64).max
    np.add.at(out[:, 0], own, right - left)
    np.minimum.at(out[:, 1], own, left)
    np.minimum.at(out[:, 2], own, y)
    np.maximum.at(out[:, 3], own, right)
    np.maximum.at(out[:, 4], own, y + 1)
    return out[np.argsort(-out[:, 0], kind="stable")]


def normalised(crop: np.ndarray, target: tuple[int, int] | None, padding: int, alignment: str, upscale: bool = False) -> np.ndarray | None:
    """A crop trimmed to its alpha, scaled (up only if asked to), and placed on its target; nothing without alpha or room."""
    rows, columns = np.flatnonzero(crop[..., 3].any(axis=1)), np.flatnonzero(crop[..., 3].any(axis=0))
    if not len(rows):
        return None
    trimmed = crop[rows[0] : rows[-1] + 1, columns[0] : columns[-1] + 1]
    h, w = trimmed.shape[:2]
    cw, ch = target or (w + 2 * padding, h + 2 * padding)
    if min(cw, ch) <= 2 * padding:
        return None
    scale = min((cw - 2 * padding) / w, (ch - 2 * padding) / h)
    scale = scale if upscale else min(1.0, scale)
    size = max(1, round(w * scale)), max(1, round(h * scale))
    if size != (w, h):
        trimmed = resized_rgba(trimmed, *size)
    out = np.zeros((ch, cw, 4), np.uint8)
    x = (cw - size[0]) // 2
    y = ch - padding - size[1] if alignment == "bottom-center" else (ch - size[1]) // 2
    out[y : y + size[1], x : x + size[0]] = np.where(trimmed[..., 3:] > 0, trimmed, 0)
    return out


# ---------------------------------------------------------------- sheets


_SHEET = "project string, job_id string, width int, height int, rgba binary, route string, code string"


def _array(data: bytes | None, width: int, height: int) -> np.ndarray | None:
    return None if data is None else np.frombuffer(data, np.uint8).reshape(height, width, 4)


def cut_out(jobs: DataFrame, sheets: DataFrame, mattes: DataFrame | None = None, thresholds: DataFrame | None = None) -> DataFrame:
    """(project, job_id, width, height, rgba, route, code): each job's sheet at its canvas' size, its background removed.

    sheets, mattes: project, job_id, width, height, rgba (null where it couldn't be decoded). thresholds: project,
    job_id, transparent, opaque, as raster.border_thresholds recommends them. A sheet that is missing, can't be read,
    is of another shape, or lacks its matte has no bytes but a code.
    """
    bytes_of = lambda df, p: df.select(*KEYS, *(F.col(c).alias(f"{p}_{c}") for c in ("width", "height", "rgba")))
    rows = jobs.select(*KEYS, "canvas_w", "canvas_h", "mode", S.hex_to_rgb(F.col("chroma_key")).alias("key")).join(bytes_of(sheets, "s").withColumn("there", F.lit(True)), KEYS, "left")
    rows = rows.join(bytes_of(mattes, "m"), KEYS, "left") if mattes is not None else rows.select("*", *(F.lit(None).cast(k).alias(f"m_{c}") for c, k in (("width", "int"), ("height", "int"), ("rgba", "binary"))))
    rows = rows.join(thresholds.select(*KEYS, "transparent", "opaque"), KEYS, "left") if thresholds is not None else rows.select("*", F.lit(None).cast("double").alias("transparent"), F.lit(None).cast("double").alias("opaque"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                rgba, route, code, size = _array(r["s_rgba"], r["s_width"], r["s_height"]), None, None, (r["canvas_w"], r["canvas_h"])
                if rgba is None:
                    code = "source-decode-failed" if r["there"] else "missing-file"
                elif abs(r["s_width"] / r["s_height"] - size[0] / size[1]) > max(SHAPE * max(r["s_width"] / r["s_height"], size[0] / size[1]), SHAPE):
                    rgba, code = None, "generated-canvas-aspect-ratio-mismatch"
                else:
                    key = tuple(r["key"][c] for c in "rgb") if r["key"] else None
                    limits = (TRANSPARENT if r["transparent"] is None else r["transparent"], OPAQUE if r["opaque"] is None else r["opaque"])
                    if (r["s_width"], r["s_height"]) != size and r["mode"] != MODES[1]:
                        rgba = resized_rgba(rgba, *size)
                    rgba, route = without_background(rgba, r["mode"], key, _array(r["m_rgba"], r["m_width"], r["m_height"]), limits)
                    if rgba is not None and rgba.shape[1::-1] != size:
                        rgba = resized_rgba(rgba, *size)
                    code = "background-cleanup-failed" if rgba is None else None
                row = {"project": r["project"], "job_id": r["job_id"], "width": size[0], "height": size[1], "rgba": None if rgba is None else rgba.tobytes(), "route": route, "code": code}
                yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("project", pa.string()), ("job_id", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("rgba", pa.binary()), ("route", pa.string()), ("code", pa.string())]))

    return rows.mapInArrow(run, _SHEET)


def sheet_components(sheets: DataFrame, visible: int = VISIBLE, least: int = LEAST_PIXELS) -> DataFrame:
    """(project, job_id, comp_id, pixels, l, t, r, b) of the 8-connected components of sheets with bytes, the largest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                w, h, data = (batch.column(c)[k].as_py() for c in (2, 3, 4))
                found = labelled(_array(data, w, h)[..., 3] >= visible)
                found = found[found[:, 0] >= least]
                n = len(found)
                same = [pa.array([batch.column(c)[k].as_py()] * n, pa.string()) for c in (0, 1)]
                numbers = [pa.array(np.arange(1, n + 1, dtype=np.int32)), pa.array(found[:, 0]), *(pa.array(found[:, c].astype(np.int32)) for c in range(1, 5))]
                yield pa.RecordBatch.from_arrays([*same, *numbers], [*KEYS, "comp_id", "pixels", "l", "t", "r", "b"])

    return sheets.where("rgba IS NOT NULL").select(*KEYS, "width", "height", "rgba").mapInArrow(run, "project string, job_id string, comp_id int, pixels long, l int, t int, r int, b int")


def finished_images(sheets: DataFrame, entries: DataFrame) -> DataFrame:
    """(project, output, width, height, channels, rgba) of entries (box, target_w, target_h, padding, alignment) cut from their sheets."""
    wanted = entries.groupBy(*KEYS).agg(F.collect_list(F.struct("output", "box", "target_w", "target_h", "padding", "alignment")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                sheet = _array(r["rgba"], r["width"], r["height"])
                for e in r["wanted"]:
                    b = e["box"]
                    out = normalised(sheet[b["t"] : b["b"], b["l"] : b["r"]], (e["target_w"], e["target_h"]) if e["target_w"] is not None else None, e["padding"], e["alignment"])
                    if out is not None:
                        cells = [pa.array([r["project"]]), pa.array([e["output"]]), *(pa.array([x], pa.int32()) for x in (out.shape[1], out.shape[0], 4)), pa.array([out.tobytes()], pa.binary())]
                        yield pa.RecordBatch.from_arrays(cells, ["project", "output", "width", "height", "channels", "rgba"])

    return sheets.select(*KEYS, "width", "height", "rgba").join(wanted, KEYS).mapInArrow(run, "project string, output string, width int, height int, channels int, rgba binary")


# ---------------------------------------------------------------- what a sheet holds


def _policy(category: Column) -> Column:
    """struct<distance, share, most> of a category's fragments."""
    out = F.lit(None).cast("struct<distance:double,share:double,most:double>")
    for name, (distance, share, most) in C.FRAGMENT_POLICIES.items():
        out = F.when(category == name, F.struct(F.lit(distance).alias("distance"), F.lit(share).alias("share"), F.lit(most).alias("most"))).otherwise(out)
    return out


def _classified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of merged, detached and major components of each slot, by the growth of its largest."""
    for batch in batches:
        rows = []
        for items, policy in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            classes = boxes._grown([(-x["smaller"], x["l"], x["t"], x["r"], x["b"]) for x in items], (policy["distance"], policy["share"], policy["most"]), C.MAJOR_COMPONENT_RATIO)
            rows.append([classes.count("merged"), sum(c.endswith("detached") for c in classes), classes.count("major-detached")])
        counts = [pa.array([r[k] for r in rows], pa.int32()) for k in range(3)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *counts], [*KEYS, "slot", "merged_count", "detached_count", "major_count"])


def dealt(components: DataFrame, jobs: DataFrame, slots: DataFrame) -> DataFrame:
    """components with the slot that each belongs to: the nearest centre, then fragments nearer to another slot's anchor.

    Only the first expected_count slots of a job take fragments from others.
    """
    centres = slots.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("idx", ((F.col("l") + F.col("r")) / 2).alias("x"), ((F.col("t") + F.col("b")) / 2).alias("y")))).alias("centres"))
    x, y = (F.col("l") + F.col("r")) / 2, (F.col("t") + F.col("b")) / 2
    best = F.array_min(F.transform("centres", lambda s: F.struct((F.pow(s["x"] - x, 2.0) + F.pow(s["y"] - y, 2.0)).alias("d2"), s["idx"].alias("idx"))))
    inside = F.filter("centres", lambda s: (s["x"] >= F.col("l")) & (s["x"] < F.col("r")) & (s["y"] >= F.col("t")) & (s["y"] < F.col("b")))
    placed = components.join(centres, KEYS).select(*components.columns, best["idx"].alias("nearest"), F.transform(inside, lambda s: s["idx"]).alias("spanned"))
    sheet = F.struct(*KEYS)
    active = placed.join(jobs.select(*KEYS, "expected_count", _policy(F.col("category"))["most"].alias("most")), KEYS)
    moves = boxes.reassigned_fragments(active.where("nearest <= expected_count").select(sheet.alias("sheet"), F.col("nearest").alias("slot"), "comp_id", "pixels", "l", "t", "r", "b"), "sheet", "comp_id", float("inf"))
    moves = moves.select("sheet.*", "comp_id", "to_slot", "gap")
    slot = F.when(F.col("gap") <= F.col("most"), F.col("to_slot")).otherwise(F.col("nearest"))
    return active.join(moves, [*KEYS, "comp_id"], "left").select(*components.columns, "spanned", slot.alias("slot"), "expected_count")


def run(plan: Plan, sheets: DataFrame, mattes: DataFrame | None = None, thresholds: DataFrame | None = None) -> Run:
    """All jobs of a plan from their sheets to finished images.

    Each asset whose slot holds components becomes an entry: the box of all of them, padded within the canvas, is cut
    out, trimmed, scaled and placed on its target. Components in slots beyond a job's assets are left out. Issues
    (project, job_id, slot, severity, code) tell of sheets without alpha, components over several slots' centres,
    empty slots, crops at the canvas' edge, loose and large loose components.
    """
    cut_sheets = cut(cut_out(plan.jobs, sheets, mattes, thresholds))
    components = sheet_components(cut_sheets)
    placed = cut(dealt(components, plan.jobs, plan.slots))
    own = placed.where("slot <= expected_count")
    item = F.struct((-F.col("pixels")).alias("smaller"), "comp_id", "l", "t", "r", "b")
    grouped = own.groupBy(*KEYS, "slot").agg(F.array_sort(F.collect_list(item)).alias("items"), F.count("*").cast("int").alias("component_count"), F.sum("pixels").alias("foreground_pixels"), F.min("l").alias("l"), F.min("t").alias("t"), F.max("r").alias("r"), F.max("b").alias("b"))
    policed = grouped.join(plan.jobs.select(*KEYS, _policy(F.col("category")).alias("policy")), KEYS)
    classes = policed.select(*KEYS, "slot", "items", "policy").mapInArrow(_classified, "project string, job_id string, slot int, merged_count int, detached_count int, major_count int")
    detail = plan.jobs.select(*KEYS, "canvas_w", "canvas_h", "target_w", "target_h", "padding", "alignment", "mode", "chroma_key", "final_directory", "alpha_matte_output", "provenance_file")
    rows = plan.assets.join(grouped.drop("items"), [*KEYS, "slot"], "left").join(detail, KEYS).join(classes, [*KEYS, "slot"], "left").join(cut_sheets.select(*KEYS, "route", "code"), KEYS)
    box = S.padded(S.box(*(F.col(c) for c in "ltrb")), TRIM, F.col("canvas_w"), F.col("canvas_h"))
    prefix = F.coalesce(*(F.when(F.col("category") == row[0], row[1]) for row in C.CATEGORIES))
    name = F.concat(prefix, F.lit("_"), F.col("category"), F.lit("_"), S.pascal_case(F.col("semantic_name")), F.lit("_"), S.pascal_case(F.col("state"), "Default"), F.lit("_"), F.lpad(F.col("category_index").cast("string"), 3, "0"))
    rows = rows.withColumn("box", F.when(F.col("component_count") > 0, box)).withColumn("id", name)
    found = rows.where("box IS NOT NULL")
    origin = F.coalesce(*(F.when(F.col("route") == route, value) for route, value in ORIGINS.items()))
    entries = cut(
        found.select(
            *KEYS,
            "slot",
            "id",
            "category",
            "semantic_name",
            "state",
            "category_index",
            "box",
            F.concat("final_directory", F.lit("/"), "id", F.lit(".png")).alias("output"),
            "component_count",
            "merged_count",
            "detached_count",
            "major_count",
            "foreground_pixels",
            "target_w",
            "target_h",
            "padding",
            "alignment",
            F.when(F.col("route") == "chroma-key", F.col("chroma_key")).alias("chroma_key"),
            F.col("mode").alias("transparency_mode"),
            origin.alias("alpha_origin"),
            F.col("provenance_file").alias("alpha_provenance"),
            F.col("alpha_matte_output").alias("alpha_matte"),
            F.when(F.col("detached_count") > 0, "warning").otherwise("pass").alias("qa"),
        )
    )
    images = finished_images(cut_sheets, entries)

    def issues(df: DataFrame, severity: str, code: Column, slot: Column) -> DataFrame:
        return df.select(*KEYS, slot.cast("int").alias("slot"), F.lit(severity).alias("severity"), code.alias("code"))

    none = F.lit(None)
    out = issues(cut_sheets.where("code IS NOT NULL"), "fail", F.col("code"), none)
    out = out.unionByName(issues(placed.where(F.size("spanned") > 1), "fail", F.lit("cross-slot-connected-component"), none))
    out = out.unionByName(issues(rows.where("code IS NULL AND box IS NULL"), "fail", F.lit("empty-slot"), F.col("slot")))
    touching = S.touches_boundary(F.col("box"), F.col("canvas_w"), F.col("canvas_h"))
    for severity, code, when in (("fail", "canvas-edge-contact", touching), ("warning", "detached-components", F.col("detached_count") > 0), ("warning", "multiple-major-components", F.col("major_count") > 0)):
        out = out.unionByName(issues(found.where(when), severity, F.lit(code), F.col("slot")))
    return Run(cut_sheets, entries, images, out)


def validated(plan: Plan, done: Run, files: DataFrame | None = None, digests: DataFrame | None = None, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(issues, reports) of a run's projects: those of the run and of `validation.pack_issues` over its finished images.

    files: project, file (what else is listed beside the finished images). digests: project, job_id, source_sha256,
    alpha_matte_sha256 of the inputs.
    """
    spark = done.entries.sparkSession
    digests = digests if digests is not None else spark.createDataFrame([], "project string, job_id string, source_sha256 string, alpha_matte_sha256 string")
    packs = plan.assets.groupBy(F.col("project").alias("pack")).agg(F.count("*").cast("int").alias("expected")).withColumn("chroma_key", F.lit(None).cast("string"))
    images = cut(done.images)
    sizes = images.select("project", "output", "width", "height")
    place = F.row_number().over(validation.Window.partitionBy("project").orderBy("id", "output"))
    entries = done.entries.join(sizes, ["project", "output"], "left").join(digests, KEYS, "left").select(F.col("project").alias("pack"), place.alias("ord"), "id", "job_id", "category", "output", "width", "height", "category_index", "chroma_key", "transparency_mode", "alpha_origin", "source_sha256", "alpha_provenance", "alpha_matte", "alpha_matte_sha256")
    entries = cut(entries)
    listed = images.select(F.col("project").alias("pack"), F.col("output").alias("file"))
    listed = listed.unionByName(files.select(F.col("project").alias("pack"), "file")) if files is not None else listed
    found = validation.pack_issues(packs, entries, images.select(F.col("project").alias("pack"), F.col("output").alias("file"), "width", "height", "channels", "rgba"), listed, strict)
    ids = done.entries.select(F.col("project").alias("pack"), "job_id", "slot", F.col("id").alias("asset_id"), F.col("output").alias("file"), "category")
    run_issues = done.issues.withColumnRenamed("project", "pack").join(ids, ["pack", "job_id", "slot"], "left").select("pack", F.lit(-1).alias("stage"), F.col("slot").cast("long").alias("ord"), "severity", "code", "file", "job_id", "asset_id", "category", F.lit(None).cast("array<string>").alias("files"))
    every = cut(run_issues.unionByName(found))
    return every, validation.pack_reports(packs, entries, every)
