"""What a delivery does next: gates in order, the state that it is resumed from, and what a rollback removes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions import scalars as S

from .delivery import safe_stage

#: States kept of a run's history; folder below which a rollback may remove files, and that of sprites.
HISTORY_MOST, ASSETS_FOLDER, SPRITES_FOLDER = 100, "Assets/_Project/", "Assets/_Project/UI/Sprites/"


def observed(jobs: DataFrame, inputs: DataFrame, hygiene: DataFrame, planned: DataFrame, gates: DataFrame, run: str) -> DataFrame:
    """What the gates look at, one row a run: hygiene_ok, pending_replacements, candidate_ready, gate_failures, missing_inputs.

    inputs: run, job, path, sha256 (null: not there). hygiene: run of each misplaced file. planned: run, path, sha256
    of files that wait to be replaced, as they were then; they are pending until each has changed, and then a new
    candidate is ready. gates: run, job of each issue of a source gate. jobs: run, job; runs without jobs have no row.
    """
    runs = jobs.select(run).distinct()
    have = inputs.groupBy(run).agg(F.count_if(F.col("sha256").isNull()).alias("missing_inputs"))
    same = planned.select(run, "path", F.col("sha256").alias("_before")).distinct().join(inputs.select(run, "path", "sha256").distinct(), [run, "path"], "left")
    waiting = same.groupBy(run).agg(F.count_if(F.col("sha256").isNull() | F.col("sha256").eqNullSafe(F.col("_before"))).alias("pending_replacements"), F.count("*").alias("_planned"))
    failed = gates.groupBy(run).agg(F.count("*").alias("gate_failures"))
    rows = runs.join(have, run, "left").join(waiting, run, "left").join(failed, run, "left").join(hygiene.select(run).distinct().withColumn("_bad", F.lit(True)), run, "left")
    number = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    ready = (F.coalesce("_planned", F.lit(0)) > 0) & (F.col("pending_replacements") == 0)
    return rows.select(run, F.col("_bad").isNull().alias("hygiene_ok"), number("pending_replacements"), F.coalesce(ready, F.lit(False)).alias("candidate_ready"), number("gate_failures"), number("missing_inputs"))


def next_status() -> Column:
    """struct<status, ok, action, reused> of a row of observations.

    Columns: hygiene_ok, pending_replacements, gate_failures, retry_items, missing_inputs, prior_status, has_manifest,
    force, candidate_ready, result_ok (null before the run), delivery_status (null: no delivery is asked for). The
    first gate that holds decides: misplaced files, replacements to wait for, failed source gates, missing inputs, a
    finished delivery to reuse, a manifest that must not be overwritten, then the run and what came of it.
    """
    c = F.col
    force = c("force") | c("candidate_ready")
    delivered = F.coalesce(c("delivery_status"), F.lit("complete"))
    final = F.when(delivered.isin("complete", "configuration-invalid") | F.startswith(delivered, F.lit("unity-")), delivered).otherwise("unity-failed")
    retried = F.when(c("retry_items") > 0, "awaiting-regeneration").otherwise("failed")

    def out(status: Column | str, ok: Column | bool, action: Column | str, reused: Column | bool = False) -> Column:
        of = lambda x: x if isinstance(x, Column) else F.lit(x)
        return F.struct(of(status).alias("status"), of(ok).alias("ok"), of(action).alias("action"), of(reused).alias("reused"))

    complete = final == "complete"
    return (
        F.when(~c("hygiene_ok"), out("configuration-invalid", False, "clean-run-directory"))
        .when(c("pending_replacements") > 0, out("awaiting-regeneration", True, "replace-inputs"))
        .when(c("gate_failures") > 0, out(retried, c("retry_items") > 0, F.when(c("retry_items") > 0, "replace-inputs").otherwise("review")))
        .when(c("missing_inputs") > 0, out("awaiting-generation", True, "generate-inputs"))
        .when((c("prior_status").eqNullSafe("complete")) & c("has_manifest") & ~force, out(final, complete, F.when(complete, "review").otherwise("repair-delivery"), complete))
        .when(c("has_manifest") & ~force, out("failed", False, "force-run"))
        .when(c("result_ok").isNull(), out("ready-for-processing", True, "run"))
        .when(c("result_ok"), out(final, complete, F.when(complete, "review").otherwise("repair-delivery")))
        .otherwise(out(retried, c("retry_items") > 0, F.when(c("retry_items") > 0, "replace-inputs").otherwise("review")))
    )


def resumable(states: DataFrame, inputs: DataFrame, history: DataFrame, run: str) -> tuple[DataFrame, DataFrame]:
    """(state, history): where each run resumes, and its history with a state more if anything changed.

    states: run, status, seq (after those of history). inputs: run, path, sha256. history: run, seq, status,
    safe_stage, signature. A state's signature covers its status and all paths and digests, in order of paths; one that
    equals the last is not added. The last HISTORY_MOST are kept.
    """
    item = F.struct("path", F.coalesce("sha256", F.lit("")).alias("sha256"))
    known = inputs.groupBy(run).agg(F.count("*").alias("input_count"), F.count("sha256").alias("ready_input_count"), F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: F.concat_ws(":", x["path"], x["sha256"])), "\n").alias("_text"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    now = states.join(known, run, "left").select(run, "seq", "status", safe_stage(F.col("status")).alias("safe_stage"), F.sha2(F.concat_ws("\n", "status", F.coalesce("_text", F.lit(""))), 256).alias("signature"), zero("input_count"), zero("ready_input_count"))
    last = history.groupBy(run).agg(F.max_by("signature", "seq").alias("_last"))
    new = now.join(last, run, "left").where(~F.col("signature").eqNullSafe(F.col("_last")))
    every = history.select(run, "seq", "status", "safe_stage", "signature").unionByName(new.select(run, "seq", "status", "safe_stage", "signature"))
    newest = F.row_number().over(Window.partitionBy(run).orderBy(F.col("seq").desc()))
    return now.drop("seq"), every.withColumn("_n", newest).where(F.col("_n") <= HISTORY_MOST).drop("_n")


def rollback_set(manifests: DataFrame, present: DataFrame, project: str) -> tuple[DataFrame, DataFrame]:
    """(files to remove, refused paths) of export manifests (project, sprite_root, created_assets).

    Removed are what lies below the sprite root, created assets, and the .meta file of each; a sprite root or asset
    that leaves its folder is refused, and with it the project's whole rollback. present: project, path.
    """
    made = manifests.select(project, F.explode_outer("created_assets").alias("path")).where("path IS NOT NULL").withColumn("folder", F.lit(ASSETS_FOLDER)).withColumn("root", F.lit(False))
    roots = manifests.select(project, F.col("sprite_root").alias("path"), F.lit(SPRITES_FOLDER).alias("folder"), F.lit(True).alias("root"))
    asked = made.unionByName(roots).distinct().withColumn("path", F.regexp_replace(F.translate("path", "\\", "/"), "/+$", ""))
    inside = F.when(F.col("root"), S.path_is_safe(F.concat("path", F.lit("/x")), SPRITES_FOLDER)).otherwise(S.path_is_safe(F.col("path"), ASSETS_FOLDER))
    judged = asked.withColumn("safe", F.coalesce(inside, F.lit(False)) & (F.length(F.regexp_replace("path", "/+$", "")) > F.length("folder") - 1))
    refused = judged.where("NOT safe").select(project, "path").distinct()
    good = judged.join(refused.select(project).distinct(), project, "left_anti")
    there = present.select(project, F.translate("path", "\\", "/").alias("file")).distinct()
    exact = good.where("NOT root").select(project, F.explode(F.array("path", F.concat("path", F.lit(".meta")))).alias("file"))
    beside = good.where("root").select(project, F.concat("path", F.lit(".meta")).alias("file"))
    named = there.join(exact.unionByName(beside).distinct(), [project, "file"], "left_semi")
    # A project has one sprite root, so each file meets one row.
    below = there.join(good.where("root").select(project, F.col("path").alias("_root")), project).where(F.startswith("file", F.concat("_root", F.lit("/")))).select(project, "file")
    return named.unionByName(below).distinct().withColumnRenamed("file", "path"), refused
