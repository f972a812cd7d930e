"""Unknown sheets diagnosed: kind of background, thresholds, candidate boxes in reading order, issues, documents to correct.

A project is one sheet, one row of packed bytes. One Arrow pass measures it and leaves narrow rows, from which
DataFrame functions derive all else; the documents are those that `corrections` applies once somebody approves them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.functions import constants as C
from packloom.functions import rules as R
from packloom.functions import scalars as S

from . import boxes
from .inference import CHECKER_COVERAGE, CHECKER_SCORE, COLOUR_GAP, EDGE_LINES
from .lineage import cut
from .pipelines import DIAGNOSIS_ALPHA, FLAT_BORDER, FLAT_IMAGE
from .previews import _drawn, _outline, _pixels
from .runner import BORDER_MOST, BORDER_SHARE, labelled

#: Least pixels of a candidate, room around it, distance of background from its colour, and from a checker's colours.
LEAST, ROOM, NEAR, CHECKER_NEAR = 64, 4, 24.0, 18.0
#: Steps in which colours are counted, parts of a side that are looked at for them, alpha that a reviewer's box sees.
STEP, PARTS, SEEN_ALPHA = 8, 512, 16
#: Room and growth of the documents' normalisation, range of advised room.
DOCUMENT_ROOM, ADVISED_ROOM = 8, (4, 12)
#: Colour of a candidate's box by severity, and the width of its line.
COLOURS, LINE = {"info": (34, 197, 94), "warning": (245, 158, 11), "fail": (239, 68, 68)}, 3


@dataclass(frozen=True)
class Diagnosis:
    """One report a project, candidates in reading order, and all issues in order."""

    reports: DataFrame
    candidates: DataFrame
    issues: DataFrame


# ---------------------------------------------------------------- kernels of one sheet


def _far(rgb: np.ndarray, colour: np.ndarray) -> np.ndarray:
    return np.sqrt(((rgb.astype(np.float64) - colour) ** 2).sum(axis=2))


def _strips(values: np.ndarray, n: int) -> np.ndarray:
    """What the four border strips hold, corners twice."""
    flat = lambda part: part.reshape(-1, *values.shape[2:])
    return np.concatenate([flat(values[:n]), flat(values[-n:]), flat(values[:, :n]), flat(values[:, -n:])])


def _inner_runs(lines: np.ndarray) -> np.ndarray:
    """Lengths of the runs of equal positive values of each line; of three runs or more the outer two don't count."""
    fresh = np.pad(np.diff(lines, axis=1) != 0, ((0, 0), (1, 0)), constant_values=True)
    line, at = np.nonzero(fresh)
    end = np.append(at[1:], 0)
    last = np.append(line[1:] != line[:-1], True)
    length = np.where(last, lines.shape[1], end) - at
    kept = lines[line, at] > 0
    line, length = line[kept], length[kept]
    count = np.bincount(line, minlength=len(lines))
    place = np.arange(len(line)) - (np.cumsum(count) - count)[line]
    return length[(count[line] <= 2) | ((place > 0) & (place < count[line] - 1))]


def checkerboard(rgb: np.ndarray) -> tuple[dict, np.ndarray] | None:
    """(colours, tile, coverage, score) and the background of a checkerboard of two colours; `inference.checkerboards` for packed sheets."""
    h, w = rgb.shape[:2]
    some = rgb[:: max(1, h // PARTS), :: max(1, w // PARTS)].astype(np.int64) // STEP * STEP
    values, counts = np.unique(some @ np.array([1 << 16, 1 << 8, 1]), return_counts=True)
    top = values[np.lexsort((values, counts))[::-1][:2]]
    if len(top) < 2:
        return None
    first, second = (np.array([v >> 16, v >> 8 & 255, v & 255]) for v in top)
    if np.linalg.norm(first - second) < COLOUR_GAP:
        return None
    d1, d2 = _far(rgb, first), _far(rgb, second)
    back, label = np.minimum(d1, d2) <= CHECKER_NEAR, d2 < d1
    if back.mean() < CHECKER_COVERAGE:
        return None
    marks, edge = np.where(back, label + 1, 0), min(EDGE_LINES, h, w)
    outer = lambda a: _inner_runs(np.concatenate([a[:edge], a[max(edge, len(a) - edge) :]]))
    lengths = np.concatenate([outer(marks), outer(marks.T)])
    lengths = lengths[(lengths >= 2) & (lengths <= min(h, w) // 2)]
    if not len(lengths):
        return None
    tile, shares = int(np.rint(np.median(lengths))), []
    for times in (1, 2):
        for b, s in ((back, label), (back.T, label.T)):
            both = b[: -tile * times] & b[tile * times :]
            if both.any():
                shares.append(((s[: -tile * times] == s[tile * times :]) == (times == 2))[both].mean())
    score = float(np.mean(shares)) if shares else 0.0
    if score < CHECKER_SCORE:
        return None
    return {"colors": ["#%02X%02X%02X" % tuple(c) for c in (first, second)], "tile_size": tile, "coverage": float(back.mean()), "pattern_score": score}, back


def thresholds(distance: np.ndarray, strip: int) -> dict:
    """Thresholds of a chroma key from the distances of its border, with confidence and risk; `raster.border_thresholds` for packed sheets."""
    h, w = distance.shape
    rim = _strips(distance, strip)
    middle, most = np.percentile(rim, (50, 99.5))
    clear = max(12.0, float(np.ceil(most + 4.0)))
    solid = min(255.0, max(96.0, float(np.ceil(max(clear + 48.0, clear * 2.0)))))
    solid = solid if solid > clear else clear + 1.0
    trust = next((name for name, limits in (("high", (32, 20, 80)), ("medium", (96, 56, 160))) if most <= limits[0] and most - middle <= limits[1] and rim.max() <= limits[2]), "low")
    x, y = (max(2 * BORDER_MOST, round(0.08 * size)) for size in (w, h))
    inside = distance[y : h - y, x : w - x] if 2 * x < w and 2 * y < h else distance
    front = int((inside >= solid).sum())
    soft = int(((inside > clear) & (inside < solid)).sum())
    risk = soft / inside.size >= 0.01 and soft >= 64 and soft / max(1, front) >= 1.0
    return {"transparent_threshold": clear, "opaque_threshold": solid, "confidence": trust, "near_key_risk": risk, "auto_apply": trust != "low" and clear < 160.0 and not risk}


def measured(rgba: np.ndarray, least: int, near: float) -> dict:
    """Kind, background and components (the largest first) of a sheet."""
    rgb, alpha = rgba[..., :3], rgba[..., 3]
    if alpha.min() < 255:
        kind, ground, front = "alpha-sheet", {"mode": "alpha", "export_supported": True}, alpha >= DIAGNOSIS_ALPHA
    elif found := checkerboard(rgb):
        kind, ground, front = "checkerboard-presentation", {"mode": "checkerboard", "export_supported": False, **found[0]}, ~found[1]
    else:
        strip = max(1, min(BORDER_MOST, min(alpha.shape) // BORDER_SHARE))
        key = np.rint(np.median(_strips(rgb, strip), axis=0)).astype(int)
        distance = _far(rgb, key)
        coverage, border = float((distance <= near).mean()), float((_strips(distance, 1) <= near).mean())
        ground = {"color": "#%02X%02X%02X" % tuple(key), "coverage": coverage, "border_coverage": border}
        flat = border >= FLAT_BORDER and coverage >= FLAT_IMAGE
        advice = thresholds(distance, strip) if flat else {}
        kind, front = "flat-background-sheet" if flat else "opaque-mixed-image", distance > near
        ground |= {"mode": "flat-color" if flat else "unresolved", "export_supported": flat and advice["auto_apply"], **advice}
    ground |= {c: round(ground[c], 6) for c in ("coverage", "border_coverage", "pattern_score") if c in ground}
    parts = [dict(zip(("pixels", *"ltrb"), map(int, row), strict=True)) for row in labelled(front) if row[0] >= least]
    return {"classification": kind, "background": ground, "components": parts}


_GROUND = {"mode": "string", "export_supported": "boolean", "color": "string", "transparent_threshold": "double", "opaque_threshold": "double", "confidence": "string", "near_key_risk": "boolean", "auto_apply": "boolean", "coverage": "double", "border_coverage": "double", "colors": "array<string>", "tile_size": "int", "pattern_score": "double"}
_ARROW = {"string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}
_CARRIED = {"project": "string", "category": "string", "width": "int", "height": "int", "known": "boolean", "decoded": "boolean"}
_MEASURED = pa.schema([*((c, _ARROW[k]) for c, k in _CARRIED.items()), ("classification", pa.string()), ("background", pa.struct([(c, _ARROW[k]) for c, k in _GROUND.items()])), ("components", pa.list_(pa.struct([(c, pa.int32()) for c in ("pixels", *"ltrb")])))])
_MEASURED_SQL = f"{', '.join(f'{c} {k}' for c, k in _CARRIED.items())}, classification string, background struct<{','.join(f'{c}:{k}' for c, k in _GROUND.items())}>, components array<struct<pixels:int,l:int,t:int,r:int,b:int>>"


def measurements(sheets: DataFrame, least: int = LEAST, near: float = NEAR) -> DataFrame:
    """(project, category, width, height, known, decoded, classification, background, components) of sheets (project, category, width, height, rgba).

    The last three are null where the category isn't known or there are no pixels. Sheets are read once.
    """
    known = F.coalesce(F.col("category").isin(*(row[0] for row in C.CATEGORIES)), F.lit(False))
    decoded = F.coalesce(F.col("rgba").isNotNull() & (F.col("width") > 0) & (F.col("height") > 0), F.lit(False))
    size = (F.col(c).cast("int").alias(c) for c in ("width", "height"))
    rows = sheets.select("project", "category", *size, known.alias("known"), decoded.alias("decoded"), F.when(known & decoded, F.col("rgba")).alias("rgba"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                rgba = _pixels(r.pop("rgba"), r["width"], r["height"])
                found = measured(rgba, least, near) if rgba is not None else {}
                yield pa.RecordBatch.from_pylist([r | found], schema=_MEASURED)

    return rows.mapInArrow(run, _MEASURED_SQL)


# ---------------------------------------------------------------- diagnosis


def diagnosed(sheets: DataFrame, least: int = LEAST, room: int = ROOM, near: float = NEAR) -> Diagnosis:
    """Diagnosis of sheets (project, category, width, height, rgba), one row a project; other columns don't matter.

    A sheet that couldn't be decoded (null bytes, no pixels) or whose category isn't known has an issue and no
    candidates. reports: project, status, classification, category, width, height, background, counts; candidates:
    project, position, source_index, bbox, detected_bbox, semantic_name, category, state, category_index, severity,
    codes; issues: project, ord, severity, code, location, source_index, bbox. Candidates of equal place are numbered
    by size.
    """
    rows = cut(measurements(sheets, least, near))

    # The place in the list of components comes right after the box's corner, so that it settles ties.
    parts = rows.select("project", "category", "width", "height", F.posexplode("components").alias("rank", "c"))
    ordered = boxes.row_major(parts.select("project", "c.l", "c.t", "rank", "category", "width", "height", "c.r", "c.b"), "project")
    box = S.padded(S.box(*(F.col(c) for c in "ltrb")), room, F.col("width"), F.col("height"))
    placed = ordered.select("project", "category", "width", "height", F.col("place").cast("int").alias("source_index"), box.alias("box"))
    touches = (F.col("box.l") == 0) | (F.col("box.t") == 0) | (F.col("box.r") == F.col("width")) | (F.col("box.b") == F.col("height"))
    bbox = F.array(*(F.col(f"box.{c}").cast("int") for c in "ltrb"))
    codes = F.when(touches, F.array(F.lit("candidate-touches-canvas"))).otherwise(F.array().cast("array<string>"))
    candidates = cut(placed.select("project", (F.col("source_index") - 1).alias("position"), "source_index", bbox.alias("bbox"), bbox.alias("detected_bbox"), F.format_string("Asset%03d", "source_index").alias("semantic_name"), "category", F.lit("Default").alias("state"), F.col("source_index").alias("category_index"), F.when(touches, "warning").otherwise("info").alias("severity"), codes.alias("codes")))

    mode, listed = F.col("background.mode"), F.size("components")
    rules = {
        "unsupported-category": ("fail", ~F.col("known")),
        "source-decode-failed": ("fail", F.col("known") & ~F.col("decoded")),
        "fake-checkerboard-background": ("fail", mode == "checkerboard"),
        "variable-chroma-border": ("warning", F.col("background.confidence") == "medium"),
        "unsafe-adaptive-thresholds": ("fail", ~F.col("background.auto_apply")),
        "near-key-subject-risk": ("fail", F.col("background.near_key_risk")),
        "unresolved-opaque-background": ("fail", mode == "unresolved"),
        "no-candidates": ("fail", F.col("components").isNotNull() & (listed == 0)),
    }
    where = F.when(F.col("code") == "unsupported-category", "category").when(F.col("code") == "source-decode-failed", "source_image").when(F.col("code") == "no-candidates", "assets").when(F.col("code").isin("fake-checkerboard-background", "unresolved-opaque-background"), "background.mode").otherwise("background.threshold_diagnostics")
    whole = R.issues(rows, rules, "project").select("project", F.col("ord").cast("long").alias("ord"), "severity", "code", where.alias("location"), F.lit(None).cast("int").alias("source_index"), F.lit(None).cast("array<int>").alias("bbox"))
    place = F.concat(F.lit("assets["), F.col("position").cast("string"), F.lit("].bbox"))
    single = candidates.select("project", (F.lit(len(rules)) + F.col("position")).cast("long").alias("ord"), "severity", F.explode("codes").alias("code"), place.alias("location"), "source_index", "bbox")
    issues = whole.unionByName(single)

    sums = issues.groupBy("project").agg(F.count_if(F.col("severity") == "warning").alias("warnings"), F.count_if(F.col("severity") == "fail").alias("fails"))
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    out = rows.join(sums, "project", "left")
    status = F.when(count("fails") == 0, "ready-for-review").otherwise("manual-review-required")
    number = F.when(F.col("components").isNull(), 0).otherwise(listed).cast("long")
    reports = out.select("project", status.alias("status"), "classification", "category", "width", "height", "background", number.alias("candidate_count"), count("warnings").alias("warning_count"), count("fails").alias("fail_count"))
    return Diagnosis(reports, candidates, issues)


def documents(diagnosis: Diagnosis, least: int = LEAST, room: int = ROOM, near: float = NEAR) -> DataFrame:
    """Documents of corrections, not approved, of the diagnosed sheets; `corrections.split` reads them (project beside them)."""
    # What a reviewer may set for one candidate; null leaves it to the document's normalisation.
    own = [F.lit(None).cast(kind).alias(c) for c, kind in (("target_size", "array<int>"), ("padding", "int"), ("alignment", "string"), ("allow_upscale", "boolean"))]
    item = F.struct("position", F.lit(True).alias("enabled"), F.col("source_index").cast("string").alias("source_index"), "bbox", "detected_bbox", "semantic_name", "category", "state", F.col("category_index").cast("string").alias("category_index"), *own, F.struct("severity", F.col("codes").alias("issue_codes")).alias("review"))
    # The candidates of one sheet, which its pixels bound.
    lists = diagnosis.candidates.groupBy("project").agg(F.array_sort(F.collect_list(item)).alias("assets"))
    lists = lists.select("project", F.transform("assets", lambda a: a.dropFields("position")).alias("assets"))
    sizes = [(row[0], *row[6:]) for row in C.CATEGORIES]
    target = F.coalesce(*(F.when(F.col("category") == name, F.array(F.lit(w), F.lit(h))) for name, w, h, _ in sizes if w and h))
    side = F.coalesce(*(F.when(F.col("category") == name, side) for name, _, _, side in sizes))
    normal = F.struct(target.alias("target_size"), F.lit(DOCUMENT_ROOM).alias("padding"), side.alias("alignment"), F.lit(False).alias("allow_upscale"))
    b = "background."
    advice = F.struct(
        F.struct(F.lit(least).alias("current")).alias("minimum_component_pixels"),
        F.struct(F.lit(room).alias("current"), F.array(*map(F.lit, ADVISED_ROOM)).alias("suggested_range")).alias("bbox_padding"),
        F.struct(F.lit(near).alias("current"), F.col(b + "transparent_threshold").alias("suggested_transparent_threshold"), F.col(b + "opaque_threshold").alias("suggested_opaque_threshold"), F.col(b + "auto_apply").alias("auto_apply")).alias("background_threshold"),
        F.struct(F.lit(SEEN_ALPHA).alias("current")).alias("bbox_visible_alpha"),
    )
    rows = diagnosis.reports.where("classification IS NOT NULL").join(lists, "project", "left")
    empty = F.array().cast(lists.schema["assets"].dataType)
    return rows.select("project", F.lit(False).alias("approved"), F.array("width", "height").alias("image_size"), "classification", "background", F.struct(advice.alias("threshold_suggestions")).alias("review_guidance"), normal.alias("normalization"), F.coalesce("assets", empty).alias("assets"))


def overlays(candidates: DataFrame, sheets: DataFrame) -> DataFrame:
    """(project, width, height, rgba): sheets (null bytes have none) with their candidates' boxes, coloured by severity, without labels."""
    lists = candidates.groupBy("project").agg(F.array_sort(F.collect_list(F.struct("position", "bbox", "severity"))).alias("boxes"))
    rows = sheets.where("rgba IS NOT NULL").select("project", F.col("width").cast("int").alias("w"), F.col("height").cast("int").alias("h"), F.col("rgba").alias("source")).join(lists, "project", "left")

    def draw(r: dict) -> np.ndarray:
        page = _pixels(r["source"], r["w"], r["h"]).copy()
        for x in r["boxes"] or []:
            l, t, right, bottom = x["bbox"]
            _outline(page, l, t, right, bottom, COLOURS[x["severity"]], min(LINE, (right - l) // 2, (bottom - t) // 2))
            page[t:bottom, [l, right - 1], 3] = page[[t, bottom - 1], l:right, 3] = 255
        return page

    return _drawn(rows, ["project"], draw)
