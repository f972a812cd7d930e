"""Delivery operators: attribution of issues, job overviews, layout targets, element order, retries, prompts, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions import constants as C
from packloom.functions import scalars as S

#: Status of a stopped run -> stage that it may safely resume at; other statuses are their own stage.
SAFE_STAGES = {
    "awaiting-generation": "generation",
    "awaiting-regeneration": "regeneration",
    "ready-for-processing": "processing",
    "assets-complete": "assets-complete",
    "complete": "complete",
    "unity-failed": "assets-complete",
    "configuration-invalid": "preflight",
    "failed": "qa-failed",
}


def attributed(issues: DataFrame, manifest: DataFrame) -> DataFrame:
    """Issues with job and asset: their own, else by (job, source index), else by output file; own values are never replaced."""
    by_index = manifest.groupBy("job_id", "source_index").agg(F.min("asset_id").alias("a1"))
    by_file = manifest.groupBy("file").agg(F.min_by(F.struct("job_id", "asset_id"), "asset_id").alias("m"))
    rows = issues.join(by_index, ["job_id", "source_index"], "left").join(by_file, "file", "left")
    return rows.withColumn("job_id", F.coalesce("job_id", "m.job_id")).withColumn("asset_id", F.coalesce("asset_id", "a1", "m.asset_id")).drop("a1", "m")


def target_sizes(elements: DataFrame, fields: list[str], width: str, height: str) -> DataFrame:
    """Sorted distinct sizes at which layouts use each asset, over all fields that name one; one scan, unpivoted."""
    used = elements.select(F.explode(F.array_distinct(F.array_compact(F.array(*fields)))).alias("asset_id"), F.struct(F.col(width).alias("w"), F.col(height).alias("h")).alias("size"))
    return used.groupBy("asset_id").agg(F.array_sort(F.collect_set("size")).alias("sizes"), F.count("*").alias("uses"))


def element_order(elements: DataFrame, screen: str, order: str, identity: str, parent: str) -> DataFrame:
    """Elements with the problem of their parent: missing from the screen, itself, or later; null if none."""
    places = elements.groupBy(F.col(screen).alias("_screen"), F.col(identity).alias("_parent")).agg(F.min(order).alias("_at"))
    rows = elements.join(places, (F.col(screen) == F.col("_screen")) & (F.col(parent) == F.col("_parent")), "left").drop("_screen")
    problem = F.when(F.col(parent).isNull(), None).when(F.col("_at").isNull(), "unknown-parent").when(F.col(parent) == F.col(identity), "own-parent").when(F.col("_at") >= F.col(order), "parent-not-earlier")
    return rows.withColumn("problem", problem).drop("_at", "_parent")


def job_overview(jobs: DataFrame, issues: DataFrame, scores: DataFrame, results: DataFrame) -> DataFrame:
    """Jobs with their issue codes, score and result; each side is one row a job before it is joined."""
    codes = issues.groupBy("job_id").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return jobs.join(codes, "job_id", "left").join(scores, "job_id", "left").join(results, "job_id", "left").withColumn("codes", F.coalesce("codes", F.array().cast("array<string>")))


def retry_targets(jobs: DataFrame) -> DataFrame:
    """Paths that a retry replaces, by issue, target and mode: the sheet, the matte or the provenance alone, or sheet and matte."""
    return jobs.withColumn("targets", S.retry_paths(*(F.col(c) for c in ("code", "retry_target", "transparency_mode", "sheet_path", "matte_path", "provenance_path"))))


def retry_gate(planned: DataFrame, seen: DataFrame, job: str, path: str) -> DataFrame:
    """A job may run again once no planned target has the digest any more that it awaits a change of.

    A target that isn't there is a missing input, not an unchanged one.
    """
    rows = planned.join(seen.select(path, F.col("sha256").alias("now")), path, "left")
    same = F.coalesce(F.col("now") == F.col("awaiting"), F.lit(False))
    return rows.groupBy(job).agg(F.bool_and(~same).alias("open"), F.count_if(same).alias("waiting"))


def safe_stage(status: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in SAFE_STAGES.items() for x in pair))
    return F.coalesce(F.element_at(table, status), status)


def prompts(assets: DataFrame, job: str, order: str, template: str) -> DataFrame:
    """One prompt for each job: the template with its category and the numbered list of its assets, in order."""
    items = F.array_sort(F.collect_list(F.struct(order, F.concat_ws(" / ", "name", "state").alias("line"))))
    rows = assets.groupBy(job).agg(F.first("category").alias("category"), F.transform(items, lambda x, k: F.concat((k + 1).cast("string"), F.lit(". "), x["line"])).alias("lines"))
    return rows.select(job, F.format_string(template, "category", F.size("lines"), F.array_join("lines", "\n")).alias("prompt"))


def generation_state(inputs: DataFrame, run: str, job: str) -> DataFrame:
    """Counts of each run from the required inputs (run, job, present, unchanged) of its jobs.

    A job is ready when all its inputs are present and none of them awaits a replacement (is there, unchanged).
    """
    waits = F.col("present") & F.col("unchanged")
    n = F.count("*")
    each = inputs.groupBy(run, job).agg(n.alias("required"), F.count_if("present").alias("ready"), F.count_if(waits).alias("waiting"))
    ready = F.count_if((F.col("ready") == F.col("required")) & (F.col("waiting") == 0))
    out = each.groupBy(run).agg(n.alias("job_count"), ready.alias("ready_job_count"), F.sum("required").alias("required_input_count"), F.sum("ready").alias("ready_input_count"), F.sum("waiting").alias("pending_replacement_count"))
    return out.withColumn("pending_job_count", F.col("job_count") - F.col("ready_job_count")).withColumn("missing_input_count", F.col("required_input_count") - F.col("ready_input_count"))


def next_wave(tasks: DataFrame, run: str, effective: int = C.CONCURRENCY_MOST, high_risk: int = C.HIGH_RISK_MOST) -> DataFrame:
    """(run, wave_kind, sequence, slot): the pending tasks that each run starts next.

    tasks: run, sequence, kind, is_retry, priority, job_sequence, inputs_ready. A retry goes alone, first in sequence;
    then sheets of high risk, few of them; then other sheets; then one dependent input whose sheet is there. A wave of
    dependent inputs none of which can start has no slot and no sequence.
    """
    sheet, risky = F.col("kind") == "production-sheet", F.col("priority") < C.RISK_OTHER
    tier = F.when(F.col("is_retry"), 0).when(sheet & risky, 1).when(sheet, 2).otherwise(3)
    most = F.when(F.col("tier") == 1, min(high_risk, effective)).when(F.col("tier") == 2, effective).otherwise(1)
    first = F.when(F.col("tier").isin(1, 2), F.struct("priority", "job_sequence", "sequence")).otherwise(F.struct(F.lit(0).alias("priority"), F.lit(0).cast("long").alias("job_sequence"), "sequence"))
    ranked = tasks.withColumn("tier", tier).withColumn("can", (F.col("tier") < 3) | F.col("inputs_ready"))
    ranked = ranked.withColumn("slot", F.row_number().over(Window.partitionBy(run, "tier", "can").orderBy(first))).where(F.col("slot") <= effective)
    wave = ranked.groupBy(run).agg(F.min("tier").alias("wave"))
    taken = ranked.where(F.col("can") & (F.col("slot") <= most)).select(run, F.col("tier").alias("wave"), "sequence", "slot")
    name = F.element_at(F.array(*map(F.lit, ("retry", "risk-production", "production", "dependent"))), F.col("wave") + 1)
    return wave.join(taken, [run, "wave"], "left").select(run, name.alias("wave_kind"), "sequence", "slot")


def budget_state(jobs: DataFrame, run: str, minutes: tuple[float, float] = (5.0, 8.0), concurrency: int = C.CONCURRENCY_MOST) -> DataFrame:
    """Calls and time of each run from its jobs (run, calls, max_extra, committed): what retries may still cost."""
    top = lambda c: F.max(c)
    out = jobs.groupBy(run).agg(F.count("*").alias("jobs"), F.sum("calls").alias("initial_image_calls"), F.greatest(F.lit(0), F.least(F.lit(C.RESERVE_MOST), top("max_extra"))).alias("max_extra_calls"), F.greatest(F.lit(0), top("committed")).alias("extra_calls_committed"))
    waves = F.ceil(F.col("jobs") / concurrency) + F.greatest(F.lit(0), F.col("initial_image_calls") - F.col("jobs"))
    out = out.withColumn("extra_calls_remaining", F.greatest(F.lit(0), F.col("max_extra_calls") - F.col("extra_calls_committed"))).withColumn("estimated_parallel_waves", waves.cast("long"))
    low, high = minutes
    return out.withColumn("least_minutes", F.round(F.col("estimated_parallel_waves") * low, 1)).withColumn("most_minutes", F.round((F.col("estimated_parallel_waves") + F.col("max_extra_calls")) * high, 1))


def first_of_each(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The first row of each group; the limit is pushed below the sort."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where("_k = 1").drop("_k")


def candidates(attempts: DataFrame, job: str, order: list[str], fingerprint: str) -> DataFrame:
    """First sighting of each candidate of a job, with its attempt number; repeats of a fingerprint don't count."""
    first = attempts.groupBy(job, fingerprint).agg(F.min(F.struct(*order)).alias("_at"))
    return first.withColumn("attempt", F.row_number().over(Window.partitionBy(job).orderBy("_at"))).drop("_at")


def similarity_reductions(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """L1, L-infinity and mean absolute difference of two vectors of each row."""
    d = F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))
    total = F.aggregate(d, F.lit(0.0), lambda s, x: s + x)
    return pairs.withColumn("l1", total).withColumn("linf", F.array_max(d)).withColumn("mean_abs", total / F.size(d))
