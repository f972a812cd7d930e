"""Quality scoring: issues against rules, rolled up by job, asset, dimension and run; the gate; primary issues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.functions import scalars as S


def scored(issues: DataFrame) -> DataFrame:
    """issues with dimension and penalty of their rule; rules are expressions, so no join is needed."""
    return issues.withColumn("rule", S.rule_of(F.col("code"), F.col("severity"))).select("*", "rule.dimension", "rule.penalty").drop("rule")


def _rolled(issues: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Score of each of keys; those without issues score 100. One shuffle of issues, summed on the map side."""
    fails = F.count_if(F.col("severity") == "fail")
    sums = scored(issues).where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("penalty").alias("deduction"), fails.alias("hard_blockers"), F.count("*").alias("issue_count"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    out = keys.select(key).distinct().join(sums, key, "left")
    out = out.select(key, zero(F.col("deduction")).alias("deduction"), zero(F.col("hard_blockers")).alias("hard_blockers"), zero(F.col("issue_count")).alias("issue_count"))
    score = F.greatest(F.lit(0).cast("long"), 100 - F.col("deduction"))
    return out.select(key, score.alias("score"), "hard_blockers", "issue_count").withColumn("status", S.quality_status(F.col("score"), F.col("hard_blockers")))


def job_scores(issues: DataFrame, jobs: DataFrame) -> DataFrame:
    """Issues whose job isn't among jobs count for the run alone."""
    return _rolled(issues, "job_id", jobs)


def asset_scores(issues: DataFrame, assets: DataFrame) -> DataFrame:
    return _rolled(issues, "asset_id", assets)


def dimension_totals(issues: DataFrame) -> DataFrame:
    return scored(issues).groupBy("dimension").agg(F.count("*").alias("issue_count"), F.sum("penalty").cast("long").alias("deduction"))


def run_totals(issues: DataFrame, jobs: DataFrame) -> DataFrame:
    """score, hard_blockers, status of a run, with job_mean and deduction, of which the score is the difference, 0 at least; one row.

    job_mean: mean of the jobs' scores, half to even (100 without jobs); deduction: the penalties of issues of no job.
    """
    mean = job_scores(issues, jobs).agg(F.coalesce(F.bround(F.avg("score")), F.lit(100.0)).cast("long").alias("job_mean"))
    loose = scored(issues).join(jobs.select("job_id").distinct(), "job_id", "left_anti").agg(F.coalesce(F.sum("penalty"), F.lit(0)).cast("long").alias("deduction"))
    fails = issues.agg(F.count_if(F.col("severity") == "fail").alias("hard_blockers"))
    # Three one-row results; the join condition is a constant on one row each.
    one = lambda df: df.withColumn("run", F.lit(1))
    out = one(mean).join(one(loose), "run").join(one(fails), "run")
    score = F.greatest(F.lit(0).cast("long"), F.col("job_mean") - F.col("deduction"))
    return out.select(score.alias("score"), "hard_blockers", "job_mean", "deduction").withColumn("status", S.quality_status(F.col("score"), F.col("hard_blockers")))


def run_score(issues: DataFrame, jobs: DataFrame) -> DataFrame:
    """Mean of the jobs' scores, half to even (100 without jobs), less the penalties of issues of no job; one row."""
    return run_totals(issues, jobs).select("score", "hard_blockers", "status")


def primary_issues(issues: DataFrame) -> DataFrame:
    """Each job's weightiest issue: a fail before others, then the largest penalty, then the code."""
    order = F.struct((F.col("severity") == "fail").cast("int"), F.col("penalty"), F.col("code"))
    top = scored(issues).groupBy("job_id").agg(F.max_by(F.struct("code", "severity", "dimension", "penalty"), order).alias("x"))
    return top.select("job_id", "x.*")


def gate(issues: DataFrame, key: str) -> DataFrame:
    """ok unless any issue fails, whatever the score; with the highest severity."""
    top = F.max(S.severity_rank(F.col("severity")))
    return issues.groupBy(key).agg((~F.bool_or(F.col("severity") == "fail")).alias("ok"), S.severity_name(top).alias("severity"), F.count("*").alias("issues"))


def manual_actions(issues: DataFrame) -> DataFrame:
    """Sorted distinct references of failing issues: asset, else job, else file, else code."""
    named = issues.where("severity = 'fail'").select(F.coalesce("asset_id", "job_id", "file", "code").alias("reference"))
    return named.distinct()
