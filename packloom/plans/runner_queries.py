"""Queries of the runner: sheets of sixteen images each, made of embeddings, from their plan to validated packs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.operators import planning as L
from packloom.operators import raster as P
from packloom.operators import runner as R
from packloom.sources.files import CATEGORY

from .registry import query, table
from .standins import pixels

#: A sheet of SIDE pixels has PLACES slots a side, from MARGIN, GUTTER apart; an image of EDGE pixels stands in the middle of each.
SIDE, PLACES, MARGIN, GUTTER, EDGE = 64, 4, 2, 2, 8


def plan_and_sheets(spark: SparkSession, d: str) -> tuple[L.Plan, DataFrame]:
    """A project for each label, an Icon_Item asset for each of its vectors in order, and the sheets that show them."""
    ids = table(spark, d, "embeddings").select(F.col("label").alias("l"), "vec_id").distinct()
    own = ids.groupBy("l").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asset = lambda v: F.struct(F.concat(F.lit("item"), v.cast("string")).alias("semantic_name"), F.lit("Default").alias("state"), F.lit("").alias("description"), F.lit(None).cast("string").alias("frame_style"), F.lit(None).cast("boolean").alias("enabled"))
    pair = lambda n: F.array(F.lit(n), F.lit(n))
    none = F.lit(None)
    block = F.struct(F.lit("Icon_Item"), pair(SIDE), pair(PLACES), pair(12), F.lit(1), none, none, none, none, F.transform("ids", asset), F.lit(MARGIN), F.lit(GUTTER), F.lit(1)).cast(CATEGORY)
    requests = own.select(F.concat(F.lit("pack-"), F.col("l").cast("string")).alias("project_id"), F.lit("").alias("style_notes"), none.cast("string").alias("generation_method"), F.array(block).alias("categories"))
    plan = L.batch_plan(requests)
    at = plan.assets.join(plan.slots.withColumnRenamed("idx", "slot"), ["project", "job_id", "slot"]).select("project", "job_id", F.substring("semantic_name", 5, 20).cast("long").alias("vec_id"), (F.floor((F.col("l") + F.col("r") - EDGE) / 2)).cast("int").alias("x0"), (F.floor((F.col("t") + F.col("b") - EDGE) / 2)).cast("int").alias("y0"))
    seen = pixels(spark, d).where("a >= 16").join(at, "vec_id").select(F.struct("project", "job_id").alias("sheet"), (F.col("x0") + F.col("x")).alias("x"), (F.col("y0") + F.col("y")).alias("y"), "r", "g", "b", "a")
    place = F.sequence(F.lit(0), F.lit(SIDE - 1))
    grid = plan.jobs.select(F.struct("project", "job_id").alias("sheet"), F.explode(place).alias("x")).select("sheet", "x", F.explode(place).alias("y"))
    full = grid.join(seen, ["sheet", "x", "y"], "left").na.fill(0, ["r", "g", "b", "a"])
    return plan, P.packed(full, "sheet", SIDE, SIDE).select("sheet.*", "width", "height", "rgba")


@query()
def runner_entries(spark, d):
    """Manifest entries of all sheets: component labelling, slots, classes and boxes (SQL has no labelling of this size; tests flood)."""
    plan, sheets = plan_and_sheets(spark, d)
    return R.run(plan, sheets).entries.select("project", "job_id", "slot", "id", "box.*", "component_count", "merged_count", "detached_count", "major_count", "foreground_pixels", "alpha_origin", "qa")


@query()
def runner_reports(spark, d):
    """Reports of all packs, over the finished images and every issue of the run."""
    plan, sheets = plan_and_sheets(spark, d)
    return R.validated(plan, R.run(plan, sheets))[1]
