"""Raster operators over exploded pixels (image_id, x, y, and v, or r, g, b, a)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions import constants as C
from packloom.functions import scalars as S

from .lineage import cut


def exploded(images: DataFrame, image: str, values: str, width: int) -> DataFrame:
    """Pixels of flat arrays: (image, x, y, v)."""
    at = images.select(F.col(image), F.posexplode(values).alias("p", "v"))
    return at.select(image, F.pmod("p", F.lit(width)).alias("x"), F.floor(F.col("p") / width).cast("int").alias("y"), F.col("v").cast("double").alias("v"))


def border(pixels: DataFrame, width: int, height: int, strip: int = 8) -> DataFrame:
    """Pixels of the four border strips; corners come twice, as each strip has them."""
    n = max(1, min(strip, min(width, height) // 4))
    sides = F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in enumerate((F.col("y") < n, F.col("y") >= height - n, F.col("x") < n, F.col("x") >= width - n)))))
    return pixels.select("*", F.explode(sides).alias("side"))


def border_thresholds(pixels: DataFrame, image: str, distance: str, width: int, height: int, strip: int = 8) -> DataFrame:
    """Exact percentiles of the border's distances from the key, and the matte thresholds, confidence and risk from them."""
    d = F.col(distance)
    p = F.percentile(d, F.array(*map(F.lit, (0.5, 0.9, 0.95, 0.99, 0.995))))
    rim = border(pixels, width, height, strip).groupBy(image).agg(p.alias("p"), F.max(d).alias("most"), F.count("*").alias("samples"))
    clear = F.greatest(F.lit(12.0), F.ceil(F.col("p")[4] + 4.0).cast("double"))
    solid = F.least(F.lit(255.0), F.greatest(F.lit(96.0), F.ceil(F.greatest(clear + 48.0, clear * 2.0)).cast("double")))
    solid = F.when(solid <= clear, clear + 1.0).otherwise(solid)
    spread = F.col("p")[4] - F.col("p")[0]
    trust = F.when((F.col("p")[4] <= 32) & (spread <= 20) & (F.col("most") <= 80), "high").when((F.col("p")[4] <= 96) & (spread <= 56) & (F.col("most") <= 160), "medium").otherwise("low")
    rim = rim.select(image, "samples", *(F.col("p")[k].alias(name) for k, name in enumerate(("p50", "p90", "p95", "p99", "p99_5"))), "most", clear.alias("transparent"), solid.alias("opaque"), trust.alias("confidence"))
    ring = lambda size: max(2 * strip, round(0.08 * size))
    mx, my = ring(width), ring(height)
    inside = F.col("x").between(mx, width - mx - 1) & F.col("y").between(my, height - my - 1) if 2 * mx < width and 2 * my < height else F.lit(True)
    soft = pixels.where(inside).join(rim.select(image, "transparent", "opaque"), image).groupBy(image).agg(F.count_if((d > F.col("transparent")) & (d < F.col("opaque"))).alias("transition"), F.count_if(d >= F.col("opaque")).alias("foreground"), F.count("*").alias("interior"))
    risk = (F.col("transition") / F.greatest(F.lit(1), F.col("interior")) >= 0.01) & (F.col("transition") >= 64) & (F.col("transition") / F.greatest(F.lit(1), F.col("foreground")) >= 1.0)
    out = rim.join(soft, image).withColumn("near_key_risk", risk)
    return out.withColumn("auto_apply", F.col("confidence").isin("high", "medium") & (F.col("transparent") < 160) & ~F.col("near_key_risk"))


def soft_matte(distance: Column, transparent: Column | float, opaque: Column | float) -> Column:
    """Alpha 0..255 of a distance from the key, half to even."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(float(x))
    return F.rint(S.clip((distance - lit(transparent)) / (lit(opaque) - lit(transparent)), 0.0, 1.0) * 255.0).cast("int")


def alpha_statistics(pixels: DataFrame, image: str, alpha: str = "a", visible: int = 16) -> DataFrame:
    a = F.col(alpha)
    seen = lambda c: F.when(a >= visible, F.col(c))
    return pixels.groupBy(image).agg(
        F.count_if(a == 0).alias("transparent"),
        F.count_if((a > 0) & (a < 255)).alias("partial"),
        F.count_if(a == 255).alias("opaque"),
        F.count_distinct(a).alias("levels"),
        F.min(seen("x")).alias("l"),
        F.min(seen("y")).alias("t"),
        (F.max(seen("x")) + 1).alias("r"),
        (F.max(seen("y")) + 1).alias("b"),
    )


def matte_recovered(rgb: tuple[Column, ...], matte: tuple[Column, ...], background: tuple[Column, ...]) -> tuple[Column, list[Column]]:
    """(alpha, foreground channels) under a matte: alpha is its luma; channels are truncated, not rounded."""
    alpha = S.luma(*(m.cast("double") for m in matte)) / 255.0
    share = F.greatest(alpha, F.lit(1 / 255))
    front = [F.floor(S.clip((c - (1 - alpha) * b) / share, 0.0, 255.0)).cast("int") for c, b in zip(rgb, background, strict=True)]
    return F.floor(alpha * 255.0).cast("int"), [F.when(alpha <= 0, 0).otherwise(f) for f in front]


def recovered(source: DataFrame, matte: DataFrame, image: str, width: int, height: int, strip: int = 8) -> DataFrame:
    """(image, x, y, r, g, b, a): source pixels under their matte's pixels; the background is the median of the source's border."""
    back = border(source, width, height, strip).groupBy(image).agg(*(F.percentile(c, F.lit(0.5)).alias(f"k{c}") for c in "rgb"))
    rows = source.select(image, "x", "y", *"rgb").join(matte.select(image, "x", "y", *(F.col(c).alias(f"m{c}") for c in "rgb")), [image, "x", "y"]).join(back, image)
    alpha, front = matte_recovered(*(tuple(F.col(f"{p}{c}") for c in "rgb") for p in ("", "m", "k")))
    return rows.select(image, "x", "y", *(f.alias(c) for f, c in zip(front, "rgb", strict=True)), alpha.alias("a"))


def mask_agreement(pixels: DataFrame, image: str, a: Column, b: Column) -> DataFrame:
    """Of two masks of each image: pixels, share of a that b covers, share of b that a supports, IoU of masks and of boxes."""
    both, either = a & b, a | b
    span = lambda m, c: (F.min(F.when(m, F.col(c))), F.max(F.when(m, F.col(c))) + 1)
    cols = {f"{n}{k}": v for n, m in (("a", a), ("b", b)) for k, v in zip("lrtb", (*span(m, "x"), *span(m, "y")), strict=True)}
    sums = pixels.groupBy(image).agg(F.count_if(a).alias("in_a"), F.count_if(b).alias("in_b"), F.count_if(both).alias("in_both"), F.count_if(either).alias("in_either"), *(v.alias(k) for k, v in cols.items()))
    part = lambda n, d: F.coalesce(F.try_divide(F.col(n).cast("double"), F.col(d).cast("double")), F.lit(0.0))
    x = lambda n: S.box(*(F.col(f"{n}{k}") for k in "ltrb"))
    return sums.select(image, "in_a", "in_b", part("in_both", "in_a").alias("coverage"), part("in_both", "in_b").alias("support"), part("in_both", "in_either").alias("mask_iou"), F.coalesce(S.iou(x("a"), x("b")), F.lit(0.0)).alias("box_iou"))


def histogram(values: DataFrame, image: list[str], bin_of: Column, bins: int) -> DataFrame:
    """Every bin of every image with its share, zero bins too."""
    counts = values.withColumn("bin", bin_of.cast("int")).groupBy(*image, "bin").count()
    totals = counts.groupBy(*image).agg(F.sum("count").alias("total"))
    every = totals.select(*image, "total", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(counts, [*image, "bin"], "left").select(*image, "bin", F.coalesce("count", F.lit(0).cast("long")).alias("n"), (F.coalesce("count", F.lit(0)) / F.col("total")).alias("share"))


def dominant(values: DataFrame, image: str, value: Column, most: int = 2) -> DataFrame:
    """The most frequent values of each image, the larger first among equals."""
    counts = values.withColumn("value", value).groupBy(image, "value").count()
    return counts.withColumn("place", F.row_number().over(Window.partitionBy(image).orderBy(F.desc("count"), F.desc("value")))).where(F.col("place") <= most)


def _line(image: str, axis: str) -> Window:
    return Window.partitionBy(image, "y" if axis == "x" else "x").orderBy(axis)


def gradients(pixels: DataFrame, image: str, value: str = "v") -> DataFrame:
    """Absolute steps to the right and down, null at the first pixel of a line."""
    step = lambda axis: F.abs(F.col(value) - F.lag(value).over(_line(image, axis)))
    return pixels.withColumn("gx", step("x")).withColumn("gy", step("y"))


def edge_density(pixels: DataFrame, image: str, value: str, visible: Column, scale: float = 255.0) -> DataFrame:
    """Mean absolute step between visible neighbours of both axes; 0 where there are none."""
    seen = pixels.withColumn("_v", F.when(visible, F.col(value)))
    steps = gradients(seen, image, "_v")
    n = F.count("gx") + F.count("gy")
    total = F.coalesce(F.sum("gx"), F.lit(0.0)) + F.coalesce(F.sum("gy"), F.lit(0.0))
    return steps.groupBy(image).agg(F.coalesce(F.try_divide(total, n.cast("double")), F.lit(0.0)).alias("d")).select(image, (F.col("d") / scale).alias("edge_density"))


def median_deviation(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """Median and median absolute deviation, exact, in two passes."""
    medians = rows.groupBy(*group).agg(F.percentile(value, F.lit(0.5)).alias("median"))
    return rows.join(medians, group).groupBy(*group, "median").agg(F.percentile(F.abs(F.col(value) - F.col("median")), F.lit(0.5)).alias("mad"))


def outer_profile(pixels: DataFrame, image: str, visible: Column, size: int) -> DataFrame:
    """First and last visible pixel of every column of an image, and whether the column has none."""
    seen = pixels.groupBy(image, "x").agg(F.min(F.when(visible, F.col("y"))).alias("top"), F.max(F.when(visible, F.col("y"))).alias("bottom"))
    every = pixels.select(image).distinct().select(image, F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("x"))
    return every.join(seen, [image, "x"], "left").select(image, "x", "top", "bottom", F.col("top").isNull().alias("gap"))


def lag_agreement(pixels: DataFrame, image: str, label: str, lag: int) -> DataFrame:
    """Share of pixels whose label differs from the one `lag` to the left and up, and equals the one twice as far."""
    before = lambda axis, k: F.lag(label, k).over(_line(image, axis))
    names = {"x1": before("x", lag), "y1": before("y", lag), "x2": before("x", 2 * lag), "y2": before("y", 2 * lag)}
    rows = pixels.withColumns(names)
    share = lambda c, same: F.avg(F.when(F.col(c).isNotNull(), (F.col(c) == F.col(label)).cast("double") if same else (F.col(c) != F.col(label)).cast("double")))
    return rows.groupBy(image).agg(share("x1", False).alias("x1"), share("y1", False).alias("y1"), share("x2", True).alias("x2"), share("y2", True).alias("y2")).withColumn("score", (F.col("x1") + F.col("y1") + F.col("x2") + F.col("y2")) / 4)


def box_mean(pixels: DataFrame, image: str, value: str, radius: int) -> DataFrame:
    """Mean over a square, cut at the image's edge: sums and counts along x, then along y."""
    x, y = _line(image, "x").rowsBetween(-radius, radius), _line(image, "y").rowsBetween(-radius, radius)
    rows = pixels.withColumn("_s", F.sum(value).over(x)).withColumn("_n", F.count(value).over(x))
    return rows.withColumn("mean", F.sum("_s").over(y) / F.sum("_n").over(y)).drop("_s", "_n")


def local_max(pixels: DataFrame, image: str, value: str, radius: int) -> DataFrame:
    x, y = _line(image, "x").rowsBetween(-radius, radius), _line(image, "y").rowsBetween(-radius, radius)
    return pixels.withColumn("_m", F.max(value).over(x)).withColumn("local_max", F.max("_m").over(y)).drop("_m")


def slot_occupancy(pixels: DataFrame, slots: DataFrame, image: str, visible: Column, expected: int, share: float = 0.002, floor: int = 16) -> DataFrame:
    """Visible pixels of each slot; a slot is occupied at `floor` or a share of its area; whether slots 1..expected are the occupied ones."""
    inside = (F.col("x") >= F.col("s.l")) & (F.col("x") < F.col("s.r")) & (F.col("y") >= F.col("s.t")) & (F.col("y") < F.col("s.b"))
    # Slots are one layout, a bounded table.
    counts = pixels.where(visible).join(F.broadcast(slots.select("idx", "l", "t", "r", "b").alias("s")), inside).groupBy(image, "s.idx").agg(F.count("*").alias("n"), F.first((F.col("s.r") - F.col("s.l")) * (F.col("s.b") - F.col("s.t"))).alias("area"))
    taken = counts.where(F.col("n") >= F.greatest(F.lit(floor), F.col("area") * share)).groupBy(image).agg(F.array_sort(F.collect_list("idx")).alias("occupied"))
    every = pixels.select(image).distinct().join(taken, image, "left").withColumn("occupied", F.coalesce("occupied", F.array().cast("array<int>")))
    wanted = F.sequence(F.lit(1), F.lit(expected)) if expected else F.array().cast("array<int>")
    return every.withColumn("matches", F.col("occupied") == wanted)


def aura_suppressed(pixels: DataFrame, image: str, alpha: str, core: int = 32, radius: int = 2) -> DataFrame:
    """Alpha set to 0 where faint and with no solid pixel near."""
    marked = pixels.withColumn("_core", (F.col(alpha) >= core).cast("int"))
    near = local_max(marked, image, "_core", radius)
    return near.withColumn("suppressed", (F.col(alpha) > 0) & (F.col(alpha) < core) & (F.col("local_max") == 0)).withColumn(alpha, F.when(F.col("suppressed"), 0).otherwise(F.col(alpha))).drop("_core", "local_max")


def green_reflection(pixels: DataFrame, image: str, visible: Column) -> DataFrame:
    """(image, green, reflects): visible pixels that are clearly green, and whether they are too many for a status icon."""
    green = visible & (F.col("g") >= 90) & (F.col("g") >= F.col("r") + 35) & (F.col("g") >= F.col("b") + 35)
    n = F.count_if(green)
    return pixels.groupBy(image).agg(n.alias("green"), (n > F.greatest(F.lit(12), F.floor(F.count_if(visible) * 0.002))).alias("reflects"))


def hidden_colour_cleared(pixels: DataFrame, alpha: str = "a", channels: tuple[str, ...] = ("r", "g", "b")) -> DataFrame:
    return pixels.withColumns({c: F.when(F.col(alpha) == 0, 0).otherwise(F.col(c)) for c in channels})


def checker(x: Column, y: Column, tile: int) -> Column:
    return F.pmod(F.floor(x / tile) + F.floor(y / tile), F.lit(2)).cast("int")


def components(pixels: DataFrame, image: str, visible: Column, least: int = 1) -> DataFrame:
    """8-connected components of each image's visible pixels: comp_id (least run), pixels and box.

    Runs are found by islands, joined to runs of the next line that they touch, and labelled by the least run that
    they reach; a label also jumps to the label of its label each round, so rounds grow with the logarithm of a path.
    They go on until no label changes.
    """
    seen = pixels.where(visible)
    island = F.col("x") - F.row_number().over(Window.partitionBy(image, "y").orderBy("x"))
    found = seen.withColumn("_i", island).groupBy(image, "y", "_i").agg(F.min("x").alias("x0"), F.max("x").alias("x1")).drop("_i")
    # A run is known by its first pixel, which orders runs by line, then place.
    runs = cut(found.withColumn("run", F.col("y").cast("long") * (1 << 31) + F.col("x0")))
    low = runs.select(image, F.col("y").alias("y2"), F.col("x0").alias("u0"), F.col("x1").alias("u1"), F.col("run").alias("v"))
    touch = (F.col("y2") == F.col("y") + 1) & (F.col("u0") <= F.col("x1") + 1) & (F.col("u1") >= F.col("x0") - 1)
    one_way = runs.withColumnRenamed("run", "u").join(low, image).where(touch).select(image, "u", "v")
    edges = cut(one_way.unionByName(one_way.select(image, F.col("v").alias("u"), F.col("u").alias("v"))))
    labels = cut(runs.select(image, "run", F.col("run").alias("label")))
    while True:
        near = edges.join(labels.select(image, F.col("run").alias("v"), "label"), [image, "v"]).groupBy(image, F.col("u").alias("run")).agg(F.min("label").alias("near"))
        step = cut(labels.join(near, [image, "run"], "left").select(image, "run", "label", F.least("label", F.coalesce("near", "label")).alias("next")))
        jump = step.select(image, F.col("run").alias("next"), F.col("next").alias("far"))
        after = cut(step.join(jump, [image, "next"]).select(image, "run", F.col("label").alias("was"), F.col("far").alias("label")))
        labels = after.select(image, "run", "label")
        if after.where("was <> label").isEmpty():
            break
    out = runs.join(labels, [image, "run"]).groupBy(image, F.col("label").alias("comp_id"))
    size = F.sum(F.col("x1") - F.col("x0") + 1)
    return out.agg(size.alias("pixels"), F.min("x0").alias("l"), F.min("y").alias("t"), (F.max("x1") + 1).alias("r"), (F.max("y") + 1).alias("b")).where(F.col("pixels") >= least)


def style_profile(pixels: DataFrame, image: list[str], r: str, g: str, b: str) -> DataFrame:
    """Mean colour, luminance, saturation (0..1) and visible pixels of each image's pixels."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    saturation = F.when(top > 0, (top - low) / F.greatest(top, F.lit(1.0))).otherwise(0.0)
    return pixels.groupBy(*image).agg(
        *((F.avg(c) / 255.0).alias(f"mean_{k}") for k, c in (("r", r), ("g", g), ("b", b))),
        (F.avg(S.luma(F.col(r), F.col(g), F.col(b))) / 255.0).alias("mean_luminance"),
        F.avg(saturation).alias("mean_saturation"),
        F.count("*").alias("visible_pixels"),
    )


def similarity(a: str, b: str) -> dict[str, Column]:
    """Parts (0..100) and score of two profiles in structs a and b: histogram array, mean_r/g/b, and the three scalars."""
    col = lambda p, c: F.col(f"{p}.{c}")
    palette = F.aggregate(F.zip_with(col(a, "histogram"), col(b, "histogram"), lambda x, y: F.least(x, y)), F.lit(0.0), lambda s, x: s + x)
    colour = F.greatest(F.lit(0.0), 1 - F.sqrt(sum(F.pow(col(a, f"mean_{k}") - col(b, f"mean_{k}"), F.lit(2.0)) for k in "rgb")) / F.sqrt(F.lit(3.0)))
    near = lambda c: F.greatest(F.lit(0.0), 1 - F.abs(col(a, c) - col(b, c)))
    ea, eb = col(a, "edge_density"), col(b, "edge_density")
    edge = F.greatest(F.lit(0.0), 1 - F.abs(ea - eb) / F.greatest(ea, eb, F.lit(0.05)))
    parts = {"palette": palette, "mean_color": colour, "luminance": near("mean_luminance"), "saturation": near("mean_saturation"), "edge": edge}
    score = sum(C.STYLE_WEIGHTS[k] * v for k, v in parts.items())
    return {"score": 100 * score} | {k: 100 * v for k, v in parts.items()}


def job_style_scores(pairs: DataFrame, canonical: DataFrame, job: str) -> DataFrame:
    """(job, canonical, cross, score, severity) from pairs (first, second, score) and canonical (job, canonical).

    A job's score joins its likeness to the canonical profile with the mean of its likenesses to other jobs, each
    rounded to two places; a job without pairs has its canonical likeness for both.
    """
    both = pairs.select(F.col("first").alias(job), "score").unionByName(pairs.select(F.col("second").alias(job), "score"))
    means = both.groupBy(job).agg(F.round(F.avg(F.round("score", 2)), 2).alias("cross"))
    rows = canonical.select(job, F.round("canonical", 2).alias("canonical")).join(means, job, "left").withColumn("cross", F.coalesce("cross", "canonical"))
    rows = rows.withColumn("score", F.round(C.STYLE_CANONICAL * F.col("canonical") + C.STYLE_CROSS * F.col("cross"), 2))
    return rows.withColumn("severity", F.when(F.col("score") < C.STYLE_FAIL, "fail").when(F.col("score") < C.STYLE_WARN, "warning").otherwise("pass"))


def packed(pixels: DataFrame, image: str, width: int, height: int) -> DataFrame:
    """(image, width, height, rgba): each image's pixels as bytes, row by row."""
    byte = lambda c: F.lpad(F.hex(c), 2, "0")
    items = F.array_sort(F.collect_list(F.struct("y", "x", "r", "g", "b", "a")))
    text = F.array_join(F.transform(items, lambda p: F.concat(byte(p["r"]), byte(p["g"]), byte(p["b"]), byte(p["a"]))), "")
    return pixels.groupBy(image).agg(F.unhex(text).alias("rgba")).select(image, F.lit(width).alias("width"), F.lit(height).alias("height"), "rgba")
