"""Streaming twins of the folds: degradation and budget state, readiness, candidate dedup, windowed issue counts, heartbeats."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from packloom.functions import constants as C

#: Fixed value: no budget allows more extra calls.
EXTRA_CALLS_MOST = 5


def degradation(events: DataFrame, most: int = C.CONCURRENCY_MOST, least: int = C.CONCURRENCY_LEAST) -> DataFrame:
    """Concurrency of each run after each micro-batch of (run_id, ts, event_id, event).

    State is the level and the last event, however long the run is; events of a batch are folded in order of ts and id.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        level, last, seen = state.get if state.exists else (most, "", 0)
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        for event in rows["event"]:
            if event in C.FALLBACK_EVENTS and event != last:
                level = max(least, level - 1)
            last, seen = event, seen + 1
        state.update((level, last, seen))
        yield pd.DataFrame({"run_id": [key[0]], "effective": [level], "events": [seen]})

    return events.groupBy("run_id").applyInPandasWithState(step, "run_id long, effective int, events long", "level int, last string, seen long", "update", GroupStateTimeout.NoTimeout)


def budgets(requests: DataFrame, allowed: int = 1) -> DataFrame:
    """Extra calls of each run after each micro-batch of (run_id, ts, event_id, calls): granted, committed and remaining.

    A request is granted if its calls fit into what remains of `allowed`, which is cut to 0..5; null or no calls grant
    nothing. Requests of a batch are judged in order of ts and id; state is the number of calls committed.
    """
    allowed = max(0, min(allowed, EXTRA_CALLS_MOST))

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        committed, granted = state.get[0] if state.exists else 0, 0
        for calls in pd.concat(list(frames)).sort_values(["ts", "event_id"])["calls"]:
            if 0 < calls <= allowed - committed:
                committed, granted = committed + int(calls), granted + 1
        state.update((committed,))
        yield pd.DataFrame({"run_id": [key[0]], "granted": [granted], "committed": [committed], "remaining": [allowed - committed]})

    return requests.groupBy("run_id").applyInPandasWithState(step, "run_id long, granted int, committed int, remaining int", "committed int", "update", GroupStateTimeout.NoTimeout)


def new_candidates(events: DataFrame, keys: list[str], time: str, late: str = "1 day") -> DataFrame:
    """First sighting of each candidate fingerprint; state older than the watermark is dropped."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def readiness(files: DataFrame, required: int, time: str, late: str = "1 day") -> DataFrame:
    """Jobs with the exact number of their distinct inputs that arrived, and whether all have; a job's inputs are few."""
    seen = files.withWatermark(time, late).groupBy("job_id").agg(F.size(F.collect_set("path")).alias("arrived"))
    return seen.withColumn("ready", F.col("arrived") >= required)


def issue_windows(issues: DataFrame, time: str, length: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """Issues by code and event-time window, tumbling or sliding, closed by the watermark."""
    w = F.window(time, length, slide) if slide else F.window(time, length)
    return issues.withWatermark(time, late).groupBy(w.alias("w"), "code").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "code", "n")


def issue_sessions(issues: DataFrame, time: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Bursts of issues of each job, apart by at least the gap."""
    return issues.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), "job_id").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "job_id", "n")


def merged_catalog(batch: DataFrame, batch_id: int, catalog_path: str) -> None:
    """foreachBatch sink: writes the catalog as of a batch to a folder of its own, so a replayed batch changes nothing."""
    from packloom.operators.tables import upsert

    spark = batch.sparkSession
    folder = lambda k: f"{catalog_path}/version={k}"
    # A batch reads the version before it, whichever run wrote it.
    old = spark.read.parquet(folder(batch_id - 1)) if batch_id else batch.limit(0)
    upsert(old, batch, "asset_key", ["recorded_at", "output"]).drop("action").write.mode("overwrite").parquet(folder(batch_id))


@contextmanager
def heartbeat(spark: SparkSession, folder: str, operation: str) -> Iterator[dict]:
    """Keeps an operation's one-row state in folder/operation: running, then complete or failed, or interrupted-or-failed.

    Yields a dict; whoever runs the operation sets its "ok" to False where it ended without success.
    """

    def beat(status: str) -> None:
        row = spark.range(1).select(F.lit(operation).alias("operation"), F.lit(status).alias("status"), F.current_timestamp().alias("updated_at"))
        row.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{operation}")

    outcome = {"ok": True}
    beat("running")
    try:
        yield outcome
    except BaseException:
        beat("interrupted-or-failed")
        raise
    beat("complete" if outcome["ok"] else "failed")
