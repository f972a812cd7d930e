"""Nine-slice stretch bands: whether a sprite's middle bands have a straight outline and an even texture."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Gradients, and shares of high ones, that a band may have.
BASELINE_MOST, RELAXED_BELOW, RELAXED_SHARE, SHARE = 0.16, 0.40, 1 / 3, 0.25


def stretch_bands(pixels: DataFrame, image: str, visible: int = 16, middle: float = 0.60) -> DataFrame:
    """One row for each image and edge: deviation of the outline, gradients of the texture, and whether both pass.

    pixels has x, y, r, g, b, a. Positions run along an edge, depths away from it into the sprite. Images without
    visible pixels have no rows.
    """
    seen = F.col("a") >= visible
    spot = lambda f, c: f(F.when(seen, F.col(c)))
    box = pixels.groupBy(image).agg(spot(F.min, "x").alias("l"), spot(F.max, "x").alias("r0"), spot(F.min, "y").alias("t"), spot(F.max, "y").alias("b0")).where("l is not null")
    box = box.withColumn("w", F.col("r0") - F.col("l") + 1).withColumn("h", F.col("b0") - F.col("t") + 1)
    cut = lambda size: F.rint(F.col(size) * ((1 - middle) / 2)).cast("int")
    band = lambda size: F.greatest(F.lit(6), F.least(F.lit(32), F.rint(F.col(size) * 0.12).cast("int")))

    def edge(name: str, along: str, depth, low: str, high: str, size: str, across: str):
        return F.struct(F.lit(name).alias("edge"), F.col(along).alias("pos"), depth.alias("depth"), (F.col(low) + cut(size)).alias("start"), (F.col(high) - cut(size)).alias("stop"), F.col(across).alias("across"), F.least(band(across), F.col(across)).alias("band"))

    edges = F.array(
        edge("top", "x", F.col("y") - F.col("t"), "l", "r0", "w", "h"),
        edge("bottom", "x", F.col("b0") - F.col("y"), "l", "r0", "w", "h"),
        edge("left", "y", F.col("x") - F.col("l"), "t", "b0", "h", "w"),
        edge("right", "y", F.col("r0") - F.col("x"), "t", "b0", "h", "w"),
    )
    light = [(F.col(c) / 255.0 * F.col("a") / 255.0).alias(c) for c in "rgb"]
    rows = pixels.join(box, image).select(image, seen.alias("seen"), *light, (F.col("a") / 255.0).alias("a"), F.explode(edges).alias("e")).select(image, "seen", "r", "g", "b", "a", "e.*").where("pos between start and stop")
    key = [image, "edge"]

    outline = rows.groupBy(*key, "pos", "across").agg(F.min(F.when(F.col("seen"), F.col("depth"))).alias("d"))
    middle_of = outline.groupBy(*key, "across").agg(F.percentile("d", F.lit(0.5)).alias("line"))
    away = F.abs(F.col("d") - F.col("line"))
    allowed = F.greatest(F.lit(4), F.least(F.lit(10), F.rint(F.col("across") * 0.025).cast("int")))
    outlines = outline.join(middle_of.drop("across"), key).groupBy(*key).agg(F.count_if(F.col("d").isNull()).alias("gaps"), F.max(away).alias("deviation"), F.max(allowed).alias("allowed"))

    before = Window.partitionBy(*key, "depth").orderBy("pos")
    steps = [F.abs(F.col(c) - F.lag(c).over(before)) for c in "rgba"]
    textured = rows.where("depth between 0 and band - 1").withColumn("step", F.greatest(*steps)).where("step is not null").groupBy(*key, "pos").agg(F.max("step").alias("g"))
    base = textured.groupBy(*key).agg(F.percentile("g", F.lit(0.5)).alias("baseline"))
    spread = textured.join(base, key).groupBy(*key, "baseline").agg(F.percentile(F.abs(F.col("g") - F.col("baseline")), F.lit(0.5)).alias("mad"))
    limit = F.greatest(F.lit(BASELINE_MOST), F.col("baseline") + 6 * F.col("mad") + 0.04)
    textures = textured.join(spread, key).groupBy(*key, "baseline").agg(F.count_if(F.col("g") > limit).alias("high"), F.max("g").alias("steepest"), F.count("*").alias("n"))
    share = F.when(F.col("steepest") <= RELAXED_BELOW, RELAXED_SHARE).otherwise(SHARE)
    even = (F.col("high") <= F.greatest(F.lit(1), F.rint(F.col("n") * share).cast("int"))) & (F.col("baseline") <= BASELINE_MOST)

    out = outlines.join(textures, key, "left")
    straight = (F.col("gaps") == 0) & (F.col("deviation") <= F.col("allowed"))
    return out.select(*key, "gaps", "deviation", straight.alias("silhouette_ok"), "baseline", "steepest", "high", F.coalesce(even, F.lit(False)).alias("texture_ok")).withColumn("ok", F.coalesce(F.col("silhouette_ok") & F.col("texture_ok"), F.lit(False)))


def stretch_issues(bands: DataFrame, image: str, category: str) -> DataFrame:
    """A failing issue for each image of a Panel or Button with a band that doesn't pass."""
    code = f"{category.lower()}-stretch-band-decoration"
    return bands.groupBy(image).agg(F.bool_and("ok").alias("ok"), F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("edge")))).alias("edges")).where("not ok").select(image, F.lit("fail").alias("severity"), F.lit(code).alias("code"), "edges")

