"""Composite operators: source gate, sheet classification, pack validation, task queues, placements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions import constants as C
from packloom.functions import rules as R
from packloom.functions import scalars as S

from . import boxes, raster
from .lineage import cut

#: Foreground of the gate by transparency mode, and of diagnosis.
KEY_DISTANCE, MATTE_LEVEL, ALPHA_LEVEL, DIAGNOSIS_ALPHA = 48.0, 20, 16, 8
#: Shares of border and image that a flat background covers.
FLAT_BORDER, FLAT_IMAGE = 0.85, 0.20


def foreground(mode: str, key: tuple[int, int, int] = (0, 255, 0)) -> Column:
    """Foreground of a pixel (r, g, b, a) under a transparency mode."""
    rgb = F.col("r"), F.col("g"), F.col("b")
    if mode == "chroma-key":
        return S.colour_distance(rgb, key) > KEY_DISTANCE
    return F.greatest(*rgb) > MATTE_LEVEL if mode == "model-matte-derived" else F.col("a") >= ALPHA_LEVEL


def edge_contacts(pixels: DataFrame, image: str, visible: Column, width: int, height: int) -> DataFrame:
    """Visible pixels of the one-pixel ring of each image, corners twice."""
    sides = (F.col("y") == 0).cast("int") + (F.col("y") == height - 1).cast("int") + (F.col("x") == 0).cast("int") + (F.col("x") == width - 1).cast("int")
    return pixels.groupBy(image).agg(F.sum(F.when(visible, sides).otherwise(0)).alias("edge_pixels"))


def source_gate(pixels: DataFrame, slots: DataFrame, image: str, mode: str, expected: int, width: int, height: int, canvas: tuple[int, int], category: str, **occupancy) -> DataFrame:
    """Issues of source sheets, all found at once: aspect, edges, slots, and green light on status icons."""
    visible = foreground(mode)
    edges = edge_contacts(pixels, image, visible, width, height)
    filled = raster.slot_occupancy(pixels, slots, image, visible, expected, **occupancy)
    greens = raster.green_reflection(pixels, image, visible)
    rows = edges.join(filled, image).join(greens, image)
    rules = {
        "source-aspect-ratio-mismatch": ("fail", F.lit(width * canvas[1] != height * canvas[0])),
        "source-edge-contact": ("fail", F.col("edge_pixels") > 0),
        "source-slot-count-mismatch": ("fail", ~F.col("matches")),
        "status-green-reflection": ("fail", F.col("reflects") & F.lit(category == "Icon_Status" and mode == "chroma-key")),
    }
    return R.issues(rows, rules, image)


def sheet_classes(pixels: DataFrame, image: str, width: int, height: int, checker: DataFrame, threshold: float = 32.0) -> DataFrame:
    """alpha-sheet, checkerboard-presentation, flat-background-sheet or opaque-mixed-image, in this order of tests.

    checker has a boolean `is_checker` for each image (from its lag agreement).
    """
    key = raster.border(pixels, width, height).groupBy(image).agg(*(F.bround(F.percentile(c, F.lit(0.5))).alias(f"k{c}") for c in "rgb"))
    d = S.colour_distance((F.col("r"), F.col("g"), F.col("b")), (F.col("kr"), F.col("kg"), F.col("kb")))
    near = pixels.join(key, image).withColumn("near", d <= threshold)
    ring = (F.col("y") == 0).cast("int") + (F.col("y") == height - 1).cast("int") + (F.col("x") == 0).cast("int") + (F.col("x") == width - 1).cast("int")
    stats = near.groupBy(image).agg(F.min("a").alias("least_alpha"), F.avg(F.col("near").cast("double")).alias("coverage"), (F.sum(F.when(F.col("near"), ring).otherwise(0)) / F.sum(ring)).alias("border_coverage"))
    kind = F.when(F.col("least_alpha") < 255, "alpha-sheet").when(F.col("is_checker"), "checkerboard-presentation").when((F.col("border_coverage") >= FLAT_BORDER) & (F.col("coverage") >= FLAT_IMAGE), "flat-background-sheet").otherwise("opaque-mixed-image")
    return stats.join(checker.select(image, "is_checker"), image).select(image, kind.alias("classification"), "coverage", "border_coverage")


def pack_issues(manifest: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Issues of a manifest (key, declared, prefix, name, digest) against files (key, actual): all rules on one joined row."""
    first = manifest.groupBy("digest").agg(F.min(key).alias("first_holder"))
    rows = manifest.join(files.withColumn("present", F.lit(True)), key, "left").join(first, "digest")
    rules = {
        "missing-file": ("fail", F.col("present").isNull()),
        "invalid-filename": ("fail", ~F.col("name").rlike(r"^\d{2}_[A-Za-z0-9_]+_\d{3}\.png$")),
        "category-prefix-mismatch": ("fail", ~F.col("name").startswith(F.col("prefix"))),
        "dimension-mismatch": ("fail", F.col("present") & (F.col("actual") != F.col("declared"))),
        "empty-alpha": ("fail", F.col("present") & (F.col("actual") == 0)),
        "duplicate-output": ("warning", F.col(key) != F.col("first_holder")),
    }
    return R.issues(rows, rules, key)


def pass_counts(manifest: DataFrame, issues: DataFrame, key: str, group: str) -> DataFrame:
    """Entries, entries without any issue, and entries without a failure, of each group."""
    worst = issues.groupBy(key).agg(F.bool_or(F.col("severity") == "fail").alias("fails"))
    return manifest.select(key, group).join(worst, key, "left").groupBy(group).agg(F.count("*").alias("entries"), F.count_if(F.col("fails").isNull()).alias("clean"), F.count_if(~F.coalesce("fails", F.lit(False))).alias("passing"))


def task_queue(jobs: DataFrame, present: DataFrame, run: str, job: str, order: list[str]) -> DataFrame:
    """One task for each input (sheet, then matte) of each job: sequence, what it waits for, and its status.

    A matte waits for its sheet. Tasks with their file are done; of the rest those whose sheet is there are ready.
    """
    tasks = jobs.select("*", F.posexplode(F.when(F.col("needs_matte"), F.array(F.lit("sheet"), F.lit("matte"))).otherwise(F.array(F.lit("sheet")))).alias("input_ord", "kind"))
    done = present.select(job, "kind").distinct().withColumn("done", F.lit(True))
    sheets = done.where("kind = 'sheet'").select(job, F.lit(True).alias("has_sheet"))
    rows = tasks.join(done, [job, "kind"], "left").join(sheets, job, "left")
    status = F.when(F.col("done"), "complete").when((F.col("kind") == "sheet") | F.col("has_sheet"), "ready").otherwise("blocked")
    place = F.row_number().over(Window.partitionBy(run).orderBy(*order, job, "input_ord"))
    return rows.select(run, job, "kind", place.alias("sequence"), F.when(F.col("kind") == "matte", F.lit("sheet")).alias("depends_on"), status.alias("status"))


def extracted(pixels: DataFrame, slots: DataFrame, image: str, visible: Column, width: int, height: int, padding: int = 1, major: float = C.MAJOR_COMPONENT_RATIO) -> tuple[DataFrame, DataFrame]:
    """(manifest rows, issues) of sheets of one layout, straight from their pixels.

    Components go to the slot whose centre is nearest theirs. Each slot with components is an asset (image, slot,
    components, pixels, and the box of all of them, padded within the image). Issues: components that hold several
    slots' centres, slots without components, and slots with a second component nearly as large as the first.
    """
    found = raster.components(pixels, image, visible).withColumn("layout_id", F.lit(1))
    layout = slots.withColumn("layout_id", F.lit(1))
    placed = cut(boxes.nearest_slot(found, layout, "layout_id").select(image, "comp_id", "slot", "pixels", "l", "t", "r", "b"))
    size = F.array_sort(F.collect_list((-F.col("pixels")).alias("p")))
    assets = placed.groupBy(image, "slot").agg(F.count("*").alias("components"), F.sum("pixels").alias("pixels"), F.slice(size, 1, 2).alias("top"), F.min("l").alias("l"), F.min("t").alias("t"), F.max("r").alias("r"), F.max("b").alias("b"))
    boxed = S.padded(S.box(*(F.col(c) for c in "ltrb")), padding, F.lit(width), F.lit(height))
    manifest = assets.select(image, "slot", "components", "pixels", boxed.alias("box")).select(image, "slot", "components", "pixels", "box.*")
    spans = boxes.slots_spanned(placed.withColumn("layout_id", F.lit(1)).withColumn("component", F.struct(image, "comp_id")), layout, "layout_id", "component")
    crossing = spans.select(f"component.{image}", F.lit(None).cast("int").alias("slot"), F.lit("cross-slot-connected-component").alias("code"))
    every = pixels.select(image).distinct().join(F.broadcast(slots.select(F.col("idx").alias("slot"))))
    empty = every.join(assets.select(image, "slot"), [image, "slot"], "left_anti").select(image, "slot", F.lit("empty-slot").alias("code"))
    several = assets.where(F.get("top", F.lit(1)) <= F.get("top", F.lit(0)) * major).select(image, "slot", F.lit("multiple-major-components").alias("code"))
    return manifest, crossing.unionByName(empty).unionByName(several)


def placements(crops: DataFrame, slots: DataFrame, on: list[str]) -> DataFrame:
    """Where crops (w, h) go in the safe boxes of their slots: scale at most 1, size half to even, centred."""
    sw, sh = F.col("sr") - F.col("sl"), F.col("sb") - F.col("st")
    scale = F.least(F.lit(1.0), sw / F.col("w"), sh / F.col("h"))
    size = lambda c: F.greatest(F.lit(1), F.bround(F.col(c) * F.col("scale")).cast("int"))
    out = crops.join(F.broadcast(slots), on).withColumn("scale", scale).withColumn("pw", size("w")).withColumn("ph", size("h"))
    return out.withColumn("px", F.col("sl") + F.floor((sw - F.col("pw")) / 2).cast("int")).withColumn("py", F.col("st") + F.floor((sh - F.col("ph")) / 2).cast("int"))


def normalised(trims: DataFrame, padding: int) -> DataFrame:
    """Scale, content size and position of trims (w, h) on targets (tw, th, alignment); a null target fits the trim."""
    tw, th = F.coalesce("tw", F.col("w") + 2 * padding), F.coalesce("th", F.col("h") + 2 * padding)
    out = trims.withColumn("cw", tw).withColumn("ch", th)
    out = out.withColumn("scale", F.least(F.lit(1.0), (F.col("cw") - 2 * padding) / F.col("w"), (F.col("ch") - 2 * padding) / F.col("h")))
    size = lambda c: F.greatest(F.lit(1), F.bround(F.col(c) * F.col("scale")).cast("int"))
    out = out.withColumn("rw", size("w")).withColumn("rh", size("h"))
    y = F.when(F.col("alignment") == "bottom-center", F.col("ch") - padding - F.col("rh")).otherwise(F.floor((F.col("ch") - F.col("rh")) / 2).cast("int"))
    return out.withColumn("x", F.floor((F.col("cw") - F.col("rw")) / 2).cast("int")).withColumn("y", y)


def nine_patches(sprites: DataFrame, factors: tuple[float, ...] = (0.5, 1.5, 2.0)) -> DataFrame:
    """The nine source and target boxes of sprites (w, h, left, bottom, right, top) stretched by each factor."""
    rows = sprites.select("*", F.explode(F.array(*map(F.lit, factors))).alias("factor"))
    rows = rows.withColumn("tw", F.greatest(F.col("left") + F.col("right") + 1, F.bround(F.col("w") * F.col("factor")).cast("int"))).withColumn("th", F.greatest(F.col("top") + F.col("bottom") + 1, F.bround(F.col("h") * F.col("factor")).cast("int")))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("patch")).withColumn("i", F.pmod("patch", F.lit(3))).withColumn("j", F.floor(F.col("patch") / 3).cast("int"))
    edges = lambda size, a, b: F.array(F.lit(0), a, size - b, size)
    at = lambda e, k: F.element_at(e, k + 1)
    for name, size_x, size_y in (("s", "w", "h"), ("t", "tw", "th")):
        ex, ey = edges(F.col(size_x), F.col("left"), F.col("right")), edges(F.col(size_y), F.col("top"), F.col("bottom"))
        rows = rows.withColumns({f"{name}l": at(ex, F.col("i")), f"{name}r": at(ex, F.col("i") + 1), f"{name}t": at(ey, F.col("j")), f"{name}b": at(ey, F.col("j") + 1)})
    return rows.drop("i", "j")


def panel_reuse(requests: DataFrame, catalog: DataFrame, project: str) -> DataFrame:
    """(project, screen_ord, asset_ord, action, reuse_id) of framed panels, in order of screens and assets.

    A panel reuses the one generated before it in its frame style; on a later screen also an earlier one of its key or,
    failing that, the catalog's (key, id); else it is generated. Only the first request of a key and frame can be
    generated, so the fold over a project sees these alone, and every request is answered by joins with what it made.
    """
    at = F.struct("screen_ord", "asset_ord")
    known = catalog.groupBy("key").agg(F.min("id").alias("catalog_id"))
    firsts = requests.groupBy(project, "key", "frame").agg(F.min(at).alias("at")).join(known, "key", "left")
    item = F.struct("at.screen_ord", "at.asset_ord", "key", "frame", F.col("catalog_id").isNotNull().alias("listed"))
    ordered = firsts.groupBy(project).agg(F.array_sort(F.collect_list(item)).alias("items"))
    kind = dict(requests.dtypes)
    start = F.array().cast(f"array<struct<screen_ord:{kind['screen_ord']},asset_ord:{kind['asset_ord']},key:{kind['key']},frame:{kind['frame']}>>")

    def step(acc: Column, x: Column) -> Column:
        made = F.exists(acc, lambda y: y["frame"] == x["frame"]) | ((x["screen_ord"] > 0) & (x["listed"] | F.exists(acc, lambda y: y["key"] == x["key"])))
        return F.when(made, acc).otherwise(F.array_append(acc, F.struct(x["screen_ord"], x["asset_ord"], x["key"], x["frame"])))

    # One for each frame style of a project.
    made = ordered.select(project, F.explode(F.aggregate("items", start, step)).alias("m"))
    frames = made.select(project, "m.frame", F.struct("m.screen_ord", "m.asset_ord").alias("frame_at"), F.col("m.key").alias("frame_key"))
    keys = made.groupBy(project, F.col("m.key").alias("key")).agg(F.min(F.struct("m.screen_ord", "m.asset_ord")).alias("key_at"))
    rows = requests.join(frames, [project, "frame"], "left").join(keys, [project, "key"], "left").join(known, "key", "left")
    pending = lambda key: F.concat(F.lit("pending:"), key)
    later = F.col("screen_ord") > 0
    reuse = F.when(F.col("frame_at") < at, pending(F.col("frame_key"))).when(later & (F.col("key_at") < at), pending(F.col("key"))).when(later & (F.col("frame_at").isNull() | (F.col("frame_at") != at)), F.col("catalog_id"))
    return rows.withColumn("reuse_id", reuse).select(project, "screen_ord", "asset_ord", F.when(F.col("reuse_id").isNull(), "generate").otherwise("reuse").alias("action"), "reuse_id")


def policies(requests: DataFrame, category: str, given: str) -> DataFrame:
    """Fragment policies of requests: given values over the category's; unknown keys are listed, not taken."""
    table = {k: dict(zip(("merge_distance", "merge_distance_ratio", "merge_distance_max"), v, strict=True)) for k, v in C.FRAGMENT_POLICIES.items()}
    known = ("merge_distance", "merge_distance_ratio", "merge_distance_max")

    def value(key: str) -> Column:
        out = F.lit(None).cast("double")
        for name, policy in table.items():
            out = F.when(F.col(category) == name, policy[key]).otherwise(out)
        return F.coalesce(F.element_at(F.col(given), F.lit(key)).try_cast("double"), out)

    unknown = F.array_sort(F.array_except(F.map_keys(given), F.array(*map(F.lit, known))))
    return requests.select("*", *(value(k).alias(k) for k in known), unknown.alias("unknown_keys"))
