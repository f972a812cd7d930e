"""What an image's pixels imply: nine-slice borders, checkerboard backgrounds, issues of chroma thresholds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packloom.functions import rules as R
from packloom.functions import scalars as S

from . import raster, tables
from .lineage import cut

#: Least distance of a checkerboard's colours, share that they cover, agreement; border lines looked at.
COLOUR_GAP, CHECKER_COVERAGE, CHECKER_SCORE, EDGE_LINES = 12.0, 0.45, 0.82, 8


def threshold_issues(thresholds: DataFrame, image: str) -> DataFrame:
    """Issues of recommended chroma thresholds (confidence, auto_apply, near_key_risk), in this order."""
    rules = {
        "variable-chroma-border": ("warning", F.col("confidence") == "medium"),
        "unsafe-adaptive-thresholds": ("fail", ~F.col("auto_apply")),
        "near-key-subject-risk": ("fail", F.col("near_key_risk")),
    }
    return R.issues(thresholds, rules, image)


# ---------------------------------------------------------------- nine slices


def _percentile(values: Column, share: float) -> Column:
    """Linear percentile of a non-empty array."""
    ordered = F.array_sort(values)
    at = (F.size(values) - 1) * F.lit(share)
    low = F.get(ordered, F.floor(at).cast("int"))
    return low + (F.get(ordered, F.ceil(at).cast("int")) - low) * (at - F.floor(at))


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.size(values)


def axis_candidates(pixels: DataFrame, image: str, axis: str, least: int = 4) -> DataFrame:
    """(image, length, leading, trailing, threshold, confidence, valid_geometry) of each image's lines across an axis.

    Lines are compared with the median of the central ones, premultiplied by alpha; the stretch grows from the centre
    both ways over lines that are near it, and over one that isn't. An image's lines along an axis are one array.
    """
    across = "y" if axis == "x" else "x"
    shade = {c: F.col(c) / 255.0 * (F.col("a") / 255.0 if c != "a" else F.lit(1.0)) for c in "rgba"}
    rows = pixels.select(image, F.col(axis).alias("at"), F.col(across).alias("line"), *(v.alias(c) for c, v in shade.items()))
    sizes = rows.groupBy(image).agg((F.max("at") + 1).alias("length")).withColumn("centre", F.floor(F.col("length") / 2).cast("int"))
    rows = rows.join(sizes, image)
    central = F.col("at").between(F.greatest(F.lit(0), F.col("centre") - 1), F.col("centre") + 1)
    reference = rows.groupBy(image, "line").agg(*(F.percentile(F.when(central, F.col(c)), F.lit(0.5)).alias(f"m{c}") for c in "rgba"))
    off = reduce(lambda a, b: a + b, (F.abs(F.col(c) - F.col(f"m{c}")) for c in "rgba")) / 4
    lines = rows.join(reference, [image, "line"]).groupBy(image, "length", "centre", "at").agg(F.avg(off).alias("d"))
    d = F.transform(F.array_sort(F.collect_list(F.struct("at", "d"))), lambda x: x["d"])
    out = lines.groupBy(image, "length", "centre").agg(d.alias("d"))
    quarter = F.floor(F.col("length") / 4).cast("int")
    inner = F.slice("d", quarter + 1, F.greatest(F.lit(1), F.col("length") - 2 * quarter))
    out = out.withColumn("threshold", F.greatest(F.lit(0.025), _percentile(inner, 0.65) * 1.8 + 0.01))
    far = lambda ks: F.filter(ks, lambda k: F.get("d", k) > F.col("threshold"))
    none = F.array().cast("array<int>")
    before = far(F.when(F.col("centre") > 0, F.sequence(F.lit(0), F.col("centre") - 1)).otherwise(none))
    after = far(F.when(F.col("centre") < F.col("length") - 1, F.sequence(F.col("centre") + 1, F.col("length") - 1)).otherwise(none))
    out = out.withColumn("before", before).withColumn("after", after)
    out = out.withColumn("start", F.coalesce(F.get("before", F.size("before") - 2) + 1, F.lit(0))).withColumn("end", F.coalesce(F.get("after", F.lit(1)) - 1, F.col("length") - 1))
    left, right, stretch = F.col("start"), F.col("length") - 1 - F.col("end"), F.col("end") - F.col("start") + 1
    most = F.greatest(F.lit(least), F.floor(F.col("length") * 0.45).cast("int"))
    valid = left.between(F.lit(least), most) & right.between(F.lit(least), most) & (stretch >= F.greatest(F.lit(4), F.floor(F.col("length") * 0.15).cast("int")))
    held = F.slice("d", F.col("start") + 1, stretch)
    outside = F.concat(F.slice("d", F.lit(1), F.col("start")), F.slice("d", F.col("end") + 2, F.greatest(F.lit(0), right)))
    one = F.lit(1.0)
    symmetry = 1 - F.least(one, F.abs(left - right) / F.greatest(one, F.greatest(left, right).cast("double")))
    uniform = 1 - F.least(one, _mean(held) / F.greatest(F.col("threshold"), F.lit(1e-6)))
    edge = F.when(F.size(outside) == 0, 0.0).otherwise(F.least(one, _mean(outside) / F.greatest(F.col("threshold") * 1.5, F.lit(1e-6))))
    trust = 0.30 * symmetry + 0.25 * uniform + 0.25 * edge + 0.20 * F.least(one, stretch / F.greatest(one, F.col("length") * 0.45))
    return out.select(image, "length", left.alias("leading"), right.alias("trailing"), F.round("threshold", 6).alias("threshold"), F.round(F.when(valid, trust).otherwise(trust * 0.35), 4).alias("confidence"), valid.alias("valid_geometry"))


def nine_slices(pixels: DataFrame, image: str, least: int = 4, trusted: float = 0.65) -> DataFrame:
    """(image, apply, confidence, left, bottom, right, top, issue): borders that an image can be stretched between.

    Borders are 0 unless both axes have valid ones and the lesser confidence is high enough; images under four least
    borders in either direction are too small.
    """
    side = lambda axis, p: axis_candidates(pixels, image, axis, least).select(image, *(F.col(c).alias(f"{p}{c}") for c in ("length", "leading", "trailing", "confidence", "valid_geometry")))
    rows = side("x", "x_").join(side("y", "y_"), image)
    small = (F.col("x_length") < 4 * least) | (F.col("y_length") < 4 * least)
    trust = F.when(small, 0.0).otherwise(F.least("x_confidence", "y_confidence"))
    rows = rows.withColumn("confidence", trust).withColumn("apply", ~small & F.col("x_valid_geometry") & F.col("y_valid_geometry") & (trust >= trusted))
    border = lambda c: F.when(F.col("apply"), F.col(c)).otherwise(0)
    issue = F.when(small, "image-too-small-for-nine-slice").when(~F.col("apply"), "nine-slice-low-confidence-manual-override-required")
    return rows.select(image, "apply", "confidence", border("x_leading").alias("left"), border("y_trailing").alias("bottom"), border("x_trailing").alias("right"), border("y_leading").alias("top"), issue.alias("issue"))


# ---------------------------------------------------------------- checkerboards


def checkerboards(pixels: DataFrame, image: str, near: float = 18.0) -> DataFrame:
    """(image, first, second, tile, coverage, score) of images whose background is a checkerboard of two colours.

    The colours are the two most frequent ones (in steps of 8, of every 512th part of large images); tile is the median
    run of one colour along the outer lines; score is the mean share of background pixels that change colour one tile
    on and have it again two tiles on, along both axes.
    """
    # What is known of each image is cut after each step, so that no task sorts the pixels for several steps at once.
    sizes = cut(pixels.groupBy(image).agg((F.max("x") + 1).alias("w"), (F.max("y") + 1).alias("h")))
    step = lambda c: F.greatest(F.lit(1), F.floor(F.col(c) / 512).cast("int"))
    some = pixels.select(image, "x", "y", *"rgb").join(sizes, image).where((F.pmod("x", step("w")) == 0) & (F.pmod("y", step("h")) == 0))
    packed = reduce(lambda acc, c: acc * 256 + (F.floor(F.col(c) / 8) * 8).cast("int"), "rgb", F.lit(0))
    top = raster.dominant(some, image, packed).groupBy(image).agg(*(F.max(F.when(F.col("place") == k, F.col("value"))).alias(n) for k, n in ((1, "first"), (2, "second")))).where("second is not null")
    parts = lambda c: tuple(F.shiftright(F.col(c), s).bitwiseAND(F.lit(255)) for s in (16, 8, 0))
    top = cut(top.where(S.colour_distance(parts("first"), parts("second")) >= COLOUR_GAP).join(sizes, image))
    rgb = tuple(F.col(c) for c in "rgb")

    def seen(facts: DataFrame) -> DataFrame:
        px = pixels.select(image, "x", "y", *"rgb").join(facts, image).withColumn("d1", S.colour_distance(rgb, parts("first"))).withColumn("d2", S.colour_distance(rgb, parts("second")))
        return px.select("x", "y", *facts.columns, (F.least("d1", "d2") <= near).alias("back"), (F.col("d2") < F.col("d1")).alias("label"))

    covered = seen(top).groupBy(image, "first", "second", "w", "h").agg(F.avg(F.col("back").cast("double")).alias("coverage"))
    covered = cut(covered.where(F.col("coverage") >= CHECKER_COVERAGE))
    back = seen(covered).where("back")

    edge = F.least(F.lit(EDGE_LINES), F.col("w"), F.col("h"))
    outer = lambda across, size: (F.col(across) < edge) | (F.col(across) >= F.greatest(edge, F.col(size) - edge))
    along = lambda axis, across, size: F.when(outer(across, size), F.struct(F.lit(axis).alias("axis"), F.col(across).alias("line"), F.col(axis).alias("at")))
    lines = back.select(image, "label", F.explode(F.array_compact(F.array(along("x", "y", "h"), along("y", "x", "w")))).alias("o")).select(image, "label", "o.*")
    line = [image, "axis", "line"]
    found = tables.inner_runs(tables.runs(lines, line, "at", "label"), line)
    fits = found.join(covered, image).where((F.col("length") >= 2) & (F.col("length") <= F.floor(F.least("w", "h") / 2)))
    tiles = cut(covered.join(fits.groupBy(image).agg(F.rint(F.percentile("length", F.lit(0.5))).cast("int").alias("tile")), image))
    # Each background pixel with the one a tile before, which is to have the other colour, and two tiles before, the same.
    ways = F.array(*(F.struct(F.lit(axis).alias("axis"), F.lit(times).alias("times")) for axis in "xy" for times in (1, 2)))
    tiled = seen(tiles).where("back").select(image, "x", "y", "label", "tile", F.explode(ways).alias("way")).select(image, "x", "y", "label", "tile", "way.axis", "way.times")
    moved = {c: F.col(c) + F.when(F.col("axis") == c, F.col("tile") * F.col("times")).otherwise(0) for c in "xy"}
    before = tiled.select(image, "axis", "times", *(v.alias(c) for c, v in moved.items()), F.col("label").alias("before"))
    good = (F.col("label") == F.col("before")) == (F.col("times") == 2)
    shares = tiled.join(before, [image, "axis", "times", "x", "y"]).groupBy(image, "axis", "times").agg(F.avg(good.cast("double")).alias("share"))
    scores = shares.groupBy(image).agg(F.avg("share").alias("score")).where(F.col("score") >= CHECKER_SCORE)
    name = lambda c: S.rgb_to_hex(*parts(c))
    return tiles.join(scores, image).select(image, name("first").alias("first"), name("second").alias("second"), "tile", F.round("coverage", 6).alias("coverage"), F.round("score", 6).alias("score"))
