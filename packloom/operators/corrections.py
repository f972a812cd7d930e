"""Hand-made boxes applied to their sheets: background, preflight, crops on their targets, manifest, validation, review images.

A project is one sheet and its list of candidates. The bytes of a sheet go through two Arrow passes (alpha and what is
seen of each box; the finished crops); all else are narrow rows. A project with any issue of the preflight exports nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions import constants as C
from packloom.functions import rules as R
from packloom.functions import scalars as S

from . import repair, validation
from .kernels import chroma_removed
from .lineage import cut
from .previews import _drawn, _pixels
from .runner import normalised

#: Thresholds of a flat background, alpha that is seen, room around a crop, where it stands.
TRANSPARENT, OPAQUE, VISIBLE, PADDING, ALIGNMENT = 24.0, 96.0, 16, 8, "center"
ALIGNMENTS = (ALIGNMENT, "bottom-center")
#: Page, boxes as found, approved and failing ones, rows above the sheets and the width of a line in a review image.
PAGE, FOUND, APPROVED, FAILING, HEADER, LINE = (17, 24, 39), (96, 165, 250), (34, 197, 94), (239, 68, 68), 32, 3
#: Field of a candidate that an issue is about; all others are about its box.
FIELDS = {"invalid-source-index": "source_index", "duplicate-source-index": "source_index", "unsupported-category": "category", "invalid-category-index": "category_index", "non-continuous-category-index": "category_index"}
#: A document of corrections as JSON.
DOCUMENT = (
    "approved boolean, image_size array<int>, background struct<mode:string,color:string,transparent_threshold:double,opaque_threshold:double>, review_guidance struct<threshold_suggestions:struct<bbox_visible_alpha:struct<current:int>>>, "
    "normalization struct<target_size:array<int>,padding:int,alignment:string,allow_upscale:boolean>, assets array<struct<enabled:boolean,source_index:string,bbox:array<int>,detected_bbox:array<int>,category:string,category_index:string,semantic_name:string,state:string,target_size:array<int>,padding:int,alignment:string,allow_upscale:boolean>>"
)


@dataclass(frozen=True)
class Corrected:
    """Sheets with their alpha, all issues, manifest entries, finished images and one report a project."""

    sheets: DataFrame
    issues: DataFrame
    entries: DataFrame
    images: DataFrame
    reports: DataFrame


def split(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(settings, candidates) of documents (project and the columns of DOCUMENT); a candidate's position is its place in its list."""
    b, n = "background.", "normalization."
    settings = documents.select("project", "approved", F.get("image_size", F.lit(0)).alias("width"), F.get("image_size", F.lit(1)).alias("height"), F.col(b + "mode"), F.col(b + "color"), F.col(b + "transparent_threshold").alias("transparent"), F.col(b + "opaque_threshold").alias("opaque"), F.col("review_guidance.threshold_suggestions.bbox_visible_alpha.current").alias("visible"), *(F.col(n + c) for c in ("target_size", "padding", "alignment", "allow_upscale")))
    return settings, documents.select("project", F.posexplode("assets").alias("position", "a")).select("project", "position", "a.*")


def _seen(alpha: np.ndarray, boxes: list[dict], visible: int) -> list[dict]:
    """What is seen of each box that lies in the image; its ends are inclusive."""
    h, w = alpha.shape
    out = []
    for x in boxes:
        l, t, r, b = (x[c] for c in "ltrb")  # noqa: E741
        if None in (l, t, r, b) or not (0 <= l < r <= w and 0 <= t < b <= h):
            continue
        part = alpha[t:b, l:r] >= visible
        rows, columns = np.flatnonzero(part.any(axis=1)), np.flatnonzero(part.any(axis=0))
        if len(rows):
            out.append({"position": x["position"], "x0": int(l + columns[0]), "x1": int(l + columns[-1]), "y0": int(t + rows[0]), "y1": int(t + rows[-1])})
    return out


_SPANS = pa.list_(pa.struct([(c, pa.int32()) for c in ("position", "x0", "x1", "y0", "y1")]))
_PREPARED = pa.schema([("project", pa.string()), ("code", pa.string()), ("enabled", pa.int64()), ("width", pa.int32()), ("height", pa.int32()), ("rgba", pa.binary()), ("spans", _SPANS)])


def prepared(settings: DataFrame, candidates: DataFrame, sheets: DataFrame) -> DataFrame:
    """(project, code, enabled, width, height, rgba, spans): each project's sheet with alpha, or the code for which it is refused.

    settings: project, approved, width, height, mode (alpha or flat-color), color, transparent, opaque, visible, and
    defaults of candidates; sheets: project, width, height, rgba (null where it couldn't be decoded); one row a project.
    enabled counts candidates, spans tell what is seen of their boxes.
    """
    box = F.struct(F.col("position").cast("int").alias("position"), *(F.get("bbox", F.lit(k)).alias(c) for k, c in enumerate("ltrb")))
    listed = candidates.where(F.coalesce("enabled", F.lit(True))).groupBy("project").agg(F.count("*").alias("enabled"), F.collect_list(box).alias("boxes"))
    known = sheets.select("project", F.col("width").cast("int").alias("w"), F.col("height").cast("int").alias("h"), "rgba", F.lit(True).alias("there"))
    rows = settings.join(known, "project", "left").join(listed, "project", "left").withColumn("key", S.hex_to_rgb(F.col("color")))
    refused = {
        "corrections-not-approved": ~F.coalesce("approved", F.lit(False)),
        "missing-file": F.col("there").isNull(),
        "source-decode-failed": F.col("rgba").isNull(),
        "image-size-mismatch": (F.col("width") != F.col("w")) | (F.col("height") != F.col("h")),
        "fake-checkerboard-background": F.col("mode") == "checkerboard",
        "unresolved-background": ~F.coalesce(F.col("mode").isin("alpha", "flat-color"), F.lit(False)) | ((F.col("mode") == "flat-color") & F.col("key").isNull()),
        "no-enabled-assets": F.coalesce("enabled", F.lit(0)) == 0,
    }
    rows = rows.withColumn("code", R.first_broken(refused))
    rows = rows.select("project", "code", F.coalesce("enabled", F.lit(0)).alias("enabled"), "w", "h", F.when(F.col("code").isNull(), F.col("rgba")).alias("rgba"), "boxes", "mode", "key", F.coalesce("transparent", F.lit(TRANSPARENT)).alias("transparent"), F.coalesce("opaque", F.lit(OPAQUE)).alias("opaque"), F.coalesce("visible", F.lit(VISIBLE)).alias("visible"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                rgba, spans = _pixels(r["rgba"], r["w"], r["h"]), []
                if rgba is not None:
                    flat = r["mode"] == "flat-color"
                    rgba = chroma_removed(rgba[..., :3], tuple(r["key"][c] for c in "rgb"), r["transparent"], r["opaque"]) if flat else np.where(rgba[..., 3:] > 0, rgba, 0).astype(np.uint8)
                    spans = _seen(rgba[..., 3], r["boxes"], r["visible"])
                row = {"project": r["project"], "code": r["code"], "enabled": r["enabled"], "width": r["w"], "height": r["h"], "rgba": None if rgba is None else rgba.tobytes(), "spans": spans}
                yield pa.RecordBatch.from_pylist([row], schema=_PREPARED)

    return rows.mapInArrow(run, "project string, code string, enabled long, width int, height int, rgba binary, spans array<struct<position:int,x0:int,x1:int,y0:int,y1:int>>")


def preflight(candidates: DataFrame, sheets: DataFrame) -> DataFrame:
    """(project, position, code, other, recommended, location, sources): issues of the sheets of `prepared`, with the field and the indices they name."""
    good = sheets.where("code IS NULL").select("project", F.col("width").alias("sw"), F.col("height").alias("sh"))
    own = candidates.select("project", "position", "enabled", "source_index", "bbox", "category", "category_index").join(good, "project")
    spans = sheets.where("code IS NULL").select("project", F.explode("spans").alias("s")).select("project", "s.*")
    found = repair.correction_issues(own, None, "project", F.col("sw"), F.col("sh"), spans=spans)
    given = candidates.select("project", "position", F.col("source_index").alias("raw"))
    found = found.join(given, ["project", "position"]).join(given.select("project", F.col("position").alias("other"), F.col("raw").alias("other_raw")), ["project", "other"], "left")
    field = F.lit("bbox")
    for code, name in FIELDS.items():
        field = F.when(F.col("code") == code, name).otherwise(field)
    place = lambda c: F.concat(F.lit("assets["), F.col(c).cast("string"), F.lit("]."))
    location = F.when(F.col("code") == "overlapping-corrections", F.concat(place("other"), F.lit("bbox <-> "), place("position"), F.lit("bbox"))).otherwise(F.concat(place("position"), field))
    index = F.coalesce(F.col("raw").try_cast("int"), F.col("position") + 1).cast("string")
    sources = F.when(F.col("code") == "overlapping-corrections", F.array("other_raw", "raw")).when(F.col("code") == "non-continuous-category-index", F.array("raw")).when(F.col("code") == "invalid-source-index", F.array().cast("array<string>")).otherwise(F.array(index))
    return found.select("project", F.col("position").cast("int").alias("position"), "code", F.col("other").cast("int").alias("other"), "recommended", location.alias("location"), F.array_compact(sources).alias("sources"))


def _finished(sheets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(project, position, trim, width, height, rgba) of wanted crops; those without alpha or room have no row."""
    lists = wanted.groupBy("project").agg(F.collect_list(F.struct("position", *"ltrb", "target", "padding", "alignment", "allow_upscale")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                sheet = _pixels(r["rgba"], r["width"], r["height"])
                for e in r["wanted"]:
                    crop = sheet[e["t"] : e["b"], e["l"] : e["r"]]
                    out = normalised(crop, tuple(e["target"]) if e["target"] is not None else None, e["padding"], e["alignment"], e["allow_upscale"])
                    if out is None:
                        continue
                    rows, columns = np.flatnonzero(crop[..., 3].any(axis=1)), np.flatnonzero(crop[..., 3].any(axis=0))
                    trim = [int(columns[0]), int(rows[0]), int(columns[-1]) + 1, int(rows[-1]) + 1]
                    cells = [pa.array([r["project"]], pa.string()), pa.array([e["position"]], pa.int32()), pa.array([trim], pa.list_(pa.int32())), *(pa.array([x], pa.int32()) for x in (out.shape[1], out.shape[0])), pa.array([out.tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(cells, ["project", "position", "trim", "width", "height", "rgba"])

    return sheets.select("project", "width", "height", "rgba").join(lists, "project").mapInArrow(run, "project string, position int, trim array<int>, width int, height int, rgba binary")


def _planned(settings: DataFrame, candidates: DataFrame, sheets: DataFrame, bad: DataFrame) -> DataFrame:
    """Enabled candidates of accepted projects with their names and targets; code tells why a crop cannot be placed."""
    accepted = sheets.where("code IS NULL").select("project").join(bad.select("project").distinct(), "project", "left_anti")
    defaults = settings.select("project", F.when(F.col("mode") == "flat-color", F.col("color")).alias("chroma_key"), *(F.col(c).alias(f"d_{c}") for c in ("target_size", "padding", "alignment", "allow_upscale")))
    rows = candidates.where(F.coalesce("enabled", F.lit(True))).join(accepted, "project").join(defaults, "project")
    ordinal = F.row_number().over(Window.partitionBy("project").orderBy("position"))
    either = lambda c, other: F.coalesce(c, f"d_{c}", F.lit(other))
    name = F.coalesce(F.nullif(S.pascal_case(F.col("semantic_name"), ""), F.lit("")), F.format_string("Asset%03d", F.col("number")))
    prefix = F.coalesce(*(F.when(F.col("category") == row[0], row[1]) for row in C.CATEGORIES))
    rows = rows.withColumns({"index": F.coalesce(F.col("source_index").try_cast("int"), ordinal), "number": F.col("category_index").try_cast("int"), "target": F.coalesce("target_size", "d_target_size"), **{c: F.get("bbox", F.lit(k)) for k, c in enumerate("ltrb")}})
    rows = rows.withColumns({"name": name, "shown": S.pascal_case(F.col("state"), "Default"), "room": either("padding", PADDING), "side": either("alignment", ALIGNMENT), "larger": either("allow_upscale", False)})
    sized = F.coalesce((F.size("target") == 2) & (F.array_min("target") > 0), F.lit(False))
    code = R.first_broken({"invalid-target-size": F.col("target").isNotNull() & ~sized, "unsupported-alignment": ~F.col("side").isin(*ALIGNMENTS), "padding-leaves-no-room": (F.col("room") < 0) | (F.col("target").isNotNull() & (2 * F.col("room") >= F.array_min("target")))})
    file = S.file_name(prefix, F.col("category"), F.col("name"), F.col("shown"), F.col("number"))
    return rows.select("project", F.col("position").cast("int").alias("position"), *"ltrb", F.col("index").alias("source_index"), F.col("number").alias("category_index"), "category", F.col("name").alias("semantic_name"), F.col("shown").alias("state"), "target", F.col("room").alias("padding"), F.col("side").alias("alignment"), F.col("larger").alias("allow_upscale"), "chroma_key", code.alias("code"), file.alias("file"))


def applied(settings: DataFrame, candidates: DataFrame, sheets: DataFrame, listed: DataFrame | None = None) -> Corrected:
    """Corrections (as `split` gives them) applied to their sheets (project, width, height, rgba).

    candidates: project, position, enabled, source_index, bbox, category, category_index (indices as text),
    semantic_name, state, target_size, padding, alignment, allow_upscale; what is null takes the project's default.
    listed: project, file of what stands in the projects' folders already. An absent source_index is the place among
    enabled candidates. Settings and sheets have one row a project.
    """
    ready = cut(prepared(settings, candidates, sheets))
    bad = cut(preflight(candidates, ready))
    plan = cut(_planned(settings, candidates, ready, bad))
    made = cut(_finished(ready, plan.where("code IS NULL")))
    rows = plan.join(made.drop("rgba"), ["project", "position"])
    side = lambda a, b: (F.get("trim", F.lit(b)) - F.get("trim", F.lit(a))).cast("int")
    rows = rows.withColumns({"trim_w": side(0, 2), "trim_h": side(1, 3)})
    fit = F.least(*((F.col(whole) - 2 * F.col("padding")) / F.col(part) for whole, part in (("width", "trim_w"), ("height", "trim_h"))))
    rows = rows.withColumn("scale", F.when(F.col("allow_upscale"), fit).otherwise(F.least(F.lit(1.0), fit)))
    rows = rows.withColumns({f"content_{c}": F.greatest(F.lit(1), F.rint(F.col(f"trim_{c}") * F.col("scale")).cast("int")) for c in "wh"})
    low = F.col("alignment") == ALIGNMENTS[1]
    middle = lambda whole, part: F.floor((F.col(whole) - F.col(part)) / 2).cast("int")
    rows = rows.withColumns({"content_x": middle("width", "content_w"), "content_y": F.when(low, F.col("height") - F.col("padding") - F.col("content_h")).otherwise(middle("height", "content_h"))})
    output = F.concat(F.lit("final/"), "category", F.lit("/"), "file")
    entries = rows.select("project", "position", F.substring_index("file", ".", 1).alias("id"), "category", "semantic_name", "state", "source_index", "category_index", F.array(*"ltrb").alias("source_bbox"), output.alias("output"), "width", "height", "padding", "alignment", F.when(low, F.array(F.lit(0.5), F.lit(0.0))).otherwise(F.array(F.lit(0.5), F.lit(0.5))).alias("pivot"), "chroma_key", "trim", "scale", *(f"content_{c}" for c in "whxy"), F.lit("pass").alias("qa"))
    images = made.join(plan.select("project", "position", output.alias("file")), ["project", "position"]).select("project", "file", "width", "height", F.lit(4).alias("channels"), "rgba")

    # The manifest's own checks, over what was made, listed and expected.
    packs = plan.groupBy(F.col("project").alias("pack")).agg(F.count("*").cast("int").alias("expected")).withColumn("chroma_key", F.lit(None).cast("string"))
    none = lambda kind: F.lit(None).cast(kind)
    place = F.row_number().over(Window.partitionBy("project").orderBy(F.substring("id", 1, 2), "category_index", "position"))
    manifest = entries.select(F.col("project").alias("pack"), place.alias("ord"), "id", none("string").alias("job_id"), "category", "output", "width", "height", "category_index", "chroma_key", *(none("string").alias(c) for c in ("transparency_mode", "alpha_origin", "source_sha256", "alpha_provenance", "alpha_matte", "alpha_matte_sha256")))
    there = images.select(F.col("project").alias("pack"), "file")
    there = there.unionByName(listed.select(F.col("project").alias("pack"), "file")) if listed is not None else there
    checked = cut(validation.pack_issues(packs, manifest, images.withColumnRenamed("project", "pack"), there, strict=True))
    unplaced = plan.where("code IS NOT NULL").select(F.col("project").alias("pack"), F.lit("fail").alias("severity"), "code", output.alias("file"), "position")
    late = checked.select("pack", "severity", "code", "file", none("int").alias("position")).unionByName(unplaced)
    text = none("array<string>")
    early = bad.select("project", "position", F.lit("fail").alias("severity"), "code", "other", "recommended", "location", "sources", none("string").alias("file"))
    refused = ready.where("code IS NOT NULL").select("project", none("int").alias("position"), F.lit("fail").alias("severity"), "code", none("int").alias("other"), none("array<int>").alias("recommended"), none("string").alias("location"), text.alias("sources"), none("string").alias("file"))
    issues = early.unionByName(refused).unionByName(late.select(F.col("pack").alias("project"), "position", "severity", "code", none("int").alias("other"), none("array<int>").alias("recommended"), none("string").alias("location"), text.alias("sources"), "file"))
    return Corrected(ready, issues, entries, images, _reports(ready, packs, manifest, late, issues))


def _reports(ready: DataFrame, packs: DataFrame, manifest: DataFrame, late: DataFrame, issues: DataFrame) -> DataFrame:
    """project, status, counts and manual_action_required (what failing issues name: indices, then fields, files or codes) of each project."""
    done = validation.pack_reports(packs, manifest, late).withColumnRenamed("pack", "project")
    # A project's issues are those of one sheet.
    names = F.concat(F.coalesce("sources", F.array().cast("array<string>")), F.array(F.coalesce("location", "file", "code")))
    actions = issues.where("severity = 'fail'").groupBy("project").agg(F.count("*").alias("fails"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(names)))).alias("manual_action_required"))
    rows = ready.select("project", "enabled").join(done, "project", "left").join(actions, "project", "left")
    counts = (F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("manifest_count", "valid_assets", "pass_count", "warning_count"))
    status = F.when(F.coalesce("ok", F.lit(False)), "complete").otherwise("failed")
    return rows.select("project", status.alias("status"), F.col("enabled").alias("expected_count"), *counts, F.coalesce("fails", F.lit(0)).alias("fail_count"), F.coalesce("manual_action_required", F.array().cast("array<string>")).alias("manual_action_required"))


def _rim(page: np.ndarray, box: list[int], x: int, y: int, colour: tuple[int, int, int]) -> None:
    """The outline of a box, moved by x and y, as far as it lies on the page."""
    l, t, r, b = box[0] + x, box[1] + y, max(box[2], box[0] + 1) + x, max(box[3], box[1] + 1) + y  # noqa: E741
    for x0, y0, x1, y1 in ((l, t, r, min(b, t + LINE)), (l, max(t, b - LINE), r, b), (l, t, min(r, l + LINE), b), (max(l, r - LINE), t, r, b)):
        page[max(0, y0) : max(0, y1), max(0, x0) : max(0, x1), :3] = colour


def review_image(rgba: np.ndarray, boxes: list[dict]) -> np.ndarray:
    """A sheet twice: with its boxes as found, and as approved (failing ones in another colour). boxes: found, bbox, failing."""
    h, w = rgba.shape[:2]
    page = np.full((h + HEADER, 2 * w, 4), (*PAGE, 255), np.uint8)
    page[HEADER:, :w, :3] = page[HEADER:, w:, :3] = rgba[..., :3]
    whole = lambda x: x is not None and len(x) == 4 and None not in x
    for box in boxes:
        if whole(box["found"]):
            _rim(page, box["found"], 0, HEADER, FOUND)
        if whole(box["bbox"]):
            _rim(page, box["bbox"], w, HEADER, FAILING if box["failing"] else APPROVED)
    return page


def review_images(candidates: DataFrame, sheets: DataFrame, issues: DataFrame) -> DataFrame:
    """(project, width, height, rgba): the review image of each project's sheet (project, width, height, rgba; null bytes have none).

    candidates also have detected_bbox. A box fails if an issue names its index. Boxes are drawn in order, without labels.
    """
    named = issues.where("sources IS NOT NULL").select("project", F.explode("sources").alias("index")).distinct().withColumn("failing", F.lit(True))
    index = F.coalesce("source_index", (F.col("position") + 1).cast("string"))
    rows = candidates.where(F.coalesce("enabled", F.lit(True))).withColumn("index", index).join(named, ["project", "index"], "left")
    lists = rows.groupBy("project").agg(F.array_sort(F.collect_list(F.struct("position", F.coalesce("detected_bbox", "bbox").alias("found"), "bbox", F.coalesce("failing", F.lit(False)).alias("failing")))).alias("boxes"))
    drawn = sheets.where("rgba IS NOT NULL").select("project", F.col("width").alias("w"), F.col("height").alias("h"), F.col("rgba").alias("source")).join(lists, "project")
    return _drawn(drawn, ["project"], lambda r: review_image(_pixels(r["source"], r["w"], r["h"]), r["boxes"]))
