"""Repair of failed jobs: the regeneration plan with its budget, and the preflight of hand-made corrections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions import constants as C
from packloom.functions import rules as R
from packloom.functions import scalars as S

from . import boxes, scoring


def retry_prompt(original: Column, code: Column, instruction: Column, attempt: Column, most: int, heading: str = "## Focused correction attempt %d/%d") -> Column:
    """The prompt of a retry: the original one and what alone is to change."""
    lines = (F.regexp_replace(original, r"\s+$", ""), F.lit(""), F.format_string(heading, attempt, F.lit(most)), F.lit(""), F.concat(F.lit("Fix exactly this defect: `"), code, F.lit("`.")), instruction)
    rest = ("Keep the approved style, ordered resource list, canvas, grid, and every unrelated visual decision unchanged.", "Do not combine this retry with unrelated redesigns.", "")
    return F.concat_ws("\n", *lines, *map(F.lit, rest))


def _within_budget(needed: DataFrame, budgets: DataFrame, run: str) -> DataFrame:
    """(run, job_id, fits): jobs in order, each taking its calls while they last.

    What is left never grows and is at most RESERVE_MOST, so of the jobs that need equally many calls only the first
    so many can fit: the fold sees no more than these, however many jobs a run has.
    """
    place = F.row_number().over(Window.partitionBy(run, "calls").orderBy("ord", "job_id"))
    few = needed.where("calls > 0").withColumn("place", place).where(F.col("place") <= C.RESERVE_MOST)
    lists = few.groupBy(run).agg(F.array_sort(F.collect_list(F.struct("ord", "job_id", "calls"))).alias("jobs")).join(budgets, run, "left")
    start = F.struct(F.coalesce("remaining", F.lit(0)).cast("int").alias("left"), F.array().cast("array<string>").alias("fit"))

    def step(acc: Column, x: Column) -> Column:
        fits = x["calls"] <= acc["left"]
        return F.struct((acc["left"] - F.when(fits, x["calls"]).otherwise(0)).cast("int").alias("left"), F.when(fits, F.array_append(acc["fit"], x["job_id"])).otherwise(acc["fit"]).alias("fit"))

    fit = lists.select(run, F.explode(F.aggregate("jobs", start, step, lambda acc: acc["fit"])).alias("job_id"))
    return fit.withColumn("fits", F.lit(True))


def regeneration_plan(jobs: DataFrame, issues: DataFrame, results: DataFrame, budgets: DataFrame, run: str, max_attempts: int = 3) -> DataFrame:
    """What becomes of each judged job: ok, exhausted, generation-budget-exhausted or awaiting-regeneration.

    jobs: run, job_id, ord, transparency_mode, the three paths, attempts (distinct candidates judged so far); issues:
    job_id, code, severity; results: job_id, ok; budgets: run, remaining. Jobs with neither a result nor an issue have
    no row. A failing issue outweighs an ok result. Each retry names its primary issue, its instruction and targets.
    """
    most = max(C.ATTEMPTS_LEAST, min(max_attempts, C.ATTEMPTS_MOST))
    blocked = issues.groupBy("job_id").agg(F.bool_or(F.col("severity") == "fail").alias("blocked"))
    primary = scoring.primary_issues(issues).select("job_id", F.col("code"))
    rows = jobs.join(results.select("job_id", F.col("ok").alias("result")), "job_id", "left").join(blocked, "job_id", "left").join(primary, "job_id", "left")
    rows = rows.where(F.col("result").isNotNull() | F.col("blocked").isNotNull())
    passed = F.coalesce("result", F.lit(False)) & ~F.coalesce("blocked", F.lit(False))
    rows = rows.withColumn("passed", passed).withColumn("code", F.when(~passed, F.coalesce("code", F.lit(C.UNCLASSIFIED))))
    rows = rows.withColumn("fix", S.correction_of(F.col("code"))).withColumn("retry_target", F.col("fix.target"))
    rows = rows.withColumn("targets", S.retry_paths(F.col("code"), F.col("retry_target"), F.col("transparency_mode"), F.col("sheet_path"), F.col("matte_path"), F.col("provenance_path")))
    rows = rows.withColumn("calls", F.size(F.filter("targets", lambda p: F.lower(p).endswith(".png"))))
    open_jobs = rows.where(~F.col("passed") & (F.col("attempts") < most))
    fits = _within_budget(open_jobs.select(run, "job_id", "ord", "calls"), budgets, run)
    status = F.when(F.col("passed"), "ok").when(F.col("attempts") >= most, "exhausted").when((F.col("calls") > 0) & F.col("fits").isNull(), "generation-budget-exhausted").otherwise("awaiting-regeneration")
    rows = rows.join(fits, [run, "job_id"], "left").withColumn("status", status)
    waits = F.col("status") == "awaiting-regeneration"
    return rows.select(run, "job_id", "status", "attempts", "code", F.when(waits, F.col("attempts") + 1).alias("next_attempt"), F.when(waits, F.col("retry_target")).alias("retry_target"), F.when(waits, F.col("targets")).alias("targets"), F.when(waits, F.col("calls")).otherwise(0).alias("planned_extra_calls"), F.when(waits, F.col("fix.instruction")).alias("instruction"))


def correction_issues(assets: DataFrame, pixels: DataFrame | None, image: str, width: Column, height: Column, visible: int = 16, margin: int = 4, spans: DataFrame | None = None) -> DataFrame:
    """(image, position, code, other, recommended): what is wrong with hand-made boxes before they are applied.

    assets: image, position, enabled, source_index, bbox, category, category_index (the indices as text); pixels:
    image, x, y, a. Disabled candidates are left out; an absent source_index is position + 1. A box that is no box,
    leaves the image or is empty gets no further checks. other: the earlier position of a pair or repeated index.
    spans (image, position, x0, x1, y0, y1: what is seen of each box, its ends inclusive) may take the place of pixels.
    """
    rows = assets.where(F.coalesce("enabled", F.lit(True))).withColumn("index", F.coalesce(F.col("source_index").try_cast("int"), F.col("position") + 1))
    firsts = rows.groupBy(image, "index").agg(F.min("position").alias("first"))
    rows = rows.join(firsts, [image, "index"]).withColumns({"w": width, "h": height, "shape": F.coalesce(F.size("bbox") == 4, F.lit(False))})
    side = lambda k: F.get("bbox", F.lit(k))
    rows = rows.withColumns({c: F.when(F.col("shape"), side(k)) for k, c in enumerate("ltrb")})
    outside = F.col("shape") & ((F.col("l") < 0) | (F.col("t") < 0) | (F.col("r") > F.col("w")) | (F.col("b") > F.col("h")))
    empty = F.col("shape") & ~outside & ((F.col("l") >= F.col("r")) | (F.col("t") >= F.col("b")))
    rows = rows.withColumn("outside", outside).withColumn("empty", empty).withColumn("valid", F.col("shape") & ~outside & ~empty)
    named = F.col("category").isin(*(c[0] for c in C.CATEGORIES))
    number = F.col("category_index").try_cast("int")
    rules = {
        "invalid-source-index": ("fail", F.col("source_index").isNotNull() & F.col("source_index").try_cast("int").isNull()),
        "duplicate-source-index": ("fail", F.col("first") < F.col("position")),
        "invalid-bbox-shape": ("fail", ~F.col("shape")),
        "bbox-out-of-bounds": ("fail", F.col("outside")),
        "empty-bbox": ("fail", F.col("empty")),
        "unsupported-category": ("fail", F.col("valid") & ~F.coalesce(named, F.lit(False))),
        "invalid-category-index": ("fail", F.col("valid") & number.isNull()),
    }
    clamp = lambda c, top: F.greatest(F.lit(0), F.least(F.col(c), F.col(top)))
    clamped = F.array(clamp("l", "w"), clamp("t", "h"), clamp("r", "w"), clamp("b", "h"))
    single = R.issues(rows.withColumn("clamped", clamped), rules, image, "position", "first", "clamped")
    none = F.lit(None).cast("array<int>")
    out = [single.select(image, "position", "code", F.when(F.col("code") == "duplicate-source-index", F.col("first")).alias("other"), F.when(F.col("code") == "bbox-out-of-bounds", F.col("clamped")).alias("recommended"))]
    good = rows.where("valid")
    pairs = boxes.overlapping_pairs(good.select(image, "position", *"ltrb"), image, "position")
    out.append(pairs.select(image, F.col("second").alias("position"), F.lit("overlapping-corrections").alias("code"), F.col("first").alias("other"), none.alias("recommended")))
    numbered = good.where(named & number.isNotNull()).withColumn("number", number)
    n = F.count("*")
    gaps = numbered.groupBy(image, "category").agg(((F.min("number") == 1) & (F.max("number") == n) & (F.count_distinct("number") == n)).alias("whole")).where("not whole")
    out.append(numbered.join(gaps, [image, "category"]).select(image, "position", F.lit("non-continuous-category-index").alias("code"), F.lit(None).cast("int").alias("other"), none.alias("recommended")))
    if spans is None:
        # What is seen of each box; an equi join on the image, in which a box takes its own pixels alone.
        seen = pixels.where(F.col("a") >= visible).select(image, "x", "y").join(good.select(image, "position", *"ltrb", "w", "h"), image).where("x >= l and x < r and y >= t and y < b")
        spans = seen.groupBy(image, "position").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    looked = good.join(spans, [image, "position"], "left")
    cut = {"l": F.col("x0") == F.col("l"), "t": F.col("y0") == F.col("t"), "r": F.col("x1") + 1 == F.col("r"), "b": F.col("y1") + 1 == F.col("b")}
    wider = F.array(*(F.greatest(F.lit(0), F.col(c) - F.when(cut[c], margin).otherwise(0)) for c in "lt"), *(F.least(F.col(top), F.col(c) + F.when(cut[c], margin).otherwise(0)) for c, top in (("r", "w"), ("b", "h"))))
    code = F.when(F.col("x0").isNull(), "empty-correction").when(reduce(lambda a, b: a | b, cut.values()), "bbox-cuts-foreground")
    out.append(looked.withColumn("code", code).where("code is not null").select(image, "position", "code", F.lit(None).cast("int").alias("other"), F.when(F.col("code") == "bbox-cuts-foreground", wider).alias("recommended")))
    return reduce(DataFrame.unionByName, out)


def crops(pixels: DataFrame, assets: DataFrame, image: str, position: str) -> DataFrame:
    """Pixels of each box (image, position, l, t, r, b), moved to its corner."""
    inside = pixels.join(assets.select(image, position, *"ltrb"), image).where("x >= l and x < r and y >= t and y < b")
    return inside.withColumn("x", F.col("x") - F.col("l")).withColumn("y", F.col("y") - F.col("t")).drop(*"ltrb")


def composited(base: DataFrame, top: DataFrame, image: str) -> DataFrame:
    """top over base, by alpha, pixel by pixel; channels are rounded half to even, pixels of either alone stay as they are."""
    under = base.select(image, "x", "y", *(F.col(c).alias(f"u{c}") for c in "rgba"))
    rows = under.join(top.select(image, "x", "y", *"rgba"), [image, "x", "y"], "full")
    a, b = F.coalesce("a", F.lit(0)) / 255.0, F.coalesce("ua", F.lit(0)) / 255.0
    alpha = a + b * (1 - a)
    mix = lambda c: F.when(alpha > 0, F.rint((F.coalesce(c, F.lit(0)) * a + F.coalesce(f"u{c}", F.lit(0)) * b * (1 - a)) / alpha)).otherwise(0).cast("int")
    return rows.select(image, "x", "y", *(mix(c).alias(c) for c in "rgb"), F.rint(alpha * 255).cast("int").alias("a"))


def overlay(assets: DataFrame, image: str, position: str, line: int = 1) -> DataFrame:
    """(image, position, x, y, colour): the outline of each box (l, t, r, b, severity, enabled), coloured by severity."""
    names = F.create_map(*(F.lit(x) for pair in C.OVERLAY_COLOURS.items() for x in pair))
    colour = F.when(~F.col("enabled"), C.OVERLAY_DISABLED).otherwise(F.coalesce(F.element_at(names, F.col("severity")), F.lit(C.OVERLAY_OTHER)))
    at = assets.where("l < r and t < b").withColumn("colour", colour).select("*", F.explode(F.sequence(F.col("t"), F.col("b") - 1)).alias("y")).select("*", F.explode(F.sequence(F.col("l"), F.col("r") - 1)).alias("x"))
    rim = (F.col("x") < F.col("l") + line) | (F.col("x") >= F.col("r") - line) | (F.col("y") < F.col("t") + line) | (F.col("y") >= F.col("b") - line)
    return at.where(rim).select(image, position, "x", "y", "colour")
