import json

import pytest
from pyspark.sql import functions as F

from packloom.operators import tables
from packloom.plans.standins import generation_events
from packloom.sources import files
from packloom.streaming import state

from .conftest import SF


def test_images_round_trip_and_bad_files_are_rows(spark, tmp_path):
    rgba = bytes(range(64))
    (tmp_path / "a.png").write_bytes(files.png(4, 4, rgba))
    (tmp_path / "bad.png").write_bytes(b"not an image")
    images = files.images(spark, str(tmp_path))
    assert {r.error for r in images.collect()} == {None, "source-decode-failed"}
    pixels = files.image_pixels(images)
    got = sorted((r.y, r.x, r.r, r.g, r.b, r.a) for r in pixels.collect())
    assert got == [(k // 4, k % 4, *rgba[4 * k : 4 * k + 4]) for k in range(16)]
    again = files.png_images(pixels, "path").first()
    assert (again.width, again.height, bytes(again.content)) == (4, 4, files.png(4, 4, rgba))
    assert files.listing(spark, str(tmp_path)).count() == 2
    assert files.file_digests(spark, str(tmp_path)).where("length(sha256) = 64").count() == 2


def test_requests_with_defaults_and_a_corrupt_one(spark, tmp_path):
    good = {"project_id": "p", "categories": [{"category": "Panel", "assets": [{"semantic_name": " Bag "}, {"semantic_name": "Off", "enabled": False}, {"semantic_name": "Close", "state": "Hover"}]}]}
    (tmp_path / "a.json").write_text(json.dumps(good))
    (tmp_path / "b.json").write_text("{broken")
    rows = files.requests(spark, str(tmp_path)).cache()
    assert rows.where("_corrupt_record is not null").count() == 1
    got = [(r.asset_ord, r.semantic_name, r.state, r.frame_style) for r in files.requested_assets(rows.where("_corrupt_record is null")).orderBy("asset_ord").collect()]
    assert got == [(0, "Bag", "Default", "default"), (2, "Close", "Hover", "default")]


def test_streamed_degradation_equals_the_batch_fold(spark, tmp_path):
    events = generation_events(spark, SF)
    events.orderBy("ts", "event_id").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    query = state.degradation(stream).writeStream.outputMode("update").format("memory").queryName("degraded").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {r.run_id: r.effective for r in spark.table("degraded").groupBy("run_id").agg(F.min_by("effective", -F.col("events")).alias("effective")).collect()}
    want = {r.run_id: r.effective for r in tables.concurrency(events, "run_id", ["ts", "event_id"], "event").collect()}
    assert got == want


def test_readiness_counts_distinct_inputs_exactly(spark, tmp_path):
    rows = [(j, f"p{k % (j + 1)}", f"2024-01-01 00:{k % 60:02d}:00") for j in range(1, 60, 7) for k in range(80)]
    files_seen = spark.createDataFrame(rows, "job_id int, path string, at string").select("job_id", "path", F.to_timestamp("at").alias("at"))
    files_seen.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(files_seen.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = state.readiness(stream, 30, "at").writeStream.outputMode("update").format("memory").queryName("arrived").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {r.job_id: (r.arrived, r.ready) for r in spark.table("arrived").groupBy("job_id").agg(F.max("arrived").alias("arrived"), F.bool_or("ready").alias("ready")).collect()}
    assert got == {j: (j + 1, j + 1 >= 30) for j in range(1, 60, 7)}


def test_windows_count_every_issue(spark):
    rows = spark.read.parquet(f"{SF}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("code"), F.col("user_id").cast("string").alias("job_id"))
    assert state.issue_windows(rows, "ts").agg(F.sum("n")).first()[0] == rows.count()
    assert state.issue_sessions(rows, "ts").agg(F.sum("n")).first()[0] == rows.count()


def test_streamed_budgets_equal_a_plain_fold(spark, tmp_path):
    rows = [(run, ts, ts, (run * 7 + ts * 5) % 4) for run in range(6) for ts in range(9)]
    for k in range(3):  # three micro-batches, in order of time
        part = spark.createDataFrame([r for r in rows if r[1] // 3 == k], "run_id long, ts long, event_id long, calls int")
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("run_id long, ts long, event_id long, calls int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = state.budgets(stream, 9).writeStream.outputMode("update").format("memory").queryName("budgets").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {r.run_id: (r.committed, r.remaining) for r in spark.table("budgets").groupBy("run_id").agg(F.max("committed").alias("committed"), F.min("remaining").alias("remaining")).collect()}
    want = dict.fromkeys(range(6), 0)
    for run, _, _, calls in rows:
        want[run] += calls if calls <= 5 - want[run] else 0
    assert got == {run: (n, 5 - n) for run, n in want.items()} and set(want.values()) > {5}


def test_heartbeat_tells_how_an_operation_ended(spark, tmp_path):
    status = lambda name: spark.read.parquet(str(tmp_path / name)).first().status
    with state.heartbeat(spark, str(tmp_path), "good"):
        assert status("good") == "running"
    with state.heartbeat(spark, str(tmp_path), "bad") as outcome:
        outcome["ok"] = False
    with pytest.raises(KeyError), state.heartbeat(spark, str(tmp_path), "broken"):
        raise KeyError
    assert [status(x) for x in ("good", "bad", "broken")] == ["complete", "failed", "interrupted-or-failed"]


def test_a_replayed_batch_leaves_the_catalog_as_it_was(spark, tmp_path):
    batch = lambda rows: spark.createDataFrame(rows, "asset_key string, output string, recorded_at int")
    read = lambda k: sorted((r.asset_key, r.output) for r in spark.read.parquet(f"{tmp_path}/version={k}").collect())
    first, second = batch([("a", "x", 1), ("b", "y", 1), ("a", "z", 2)]), batch([("b", "w", 3), ("c", "v", 3)])
    for rows, k in [(first, 0), (second, 1), (second, 1)]:
        state.merged_catalog(rows, k, str(tmp_path))
    assert read(0) == [("a", "z"), ("b", "y")]
    assert read(1) == [("a", "z"), ("b", "w"), ("c", "v")]


def test_first_sighting_of_each_candidate_alone(spark, tmp_path):
    rows = spark.createDataFrame([(1, "f"), (1, "f"), (1, "g"), (2, "f"), (2, "f")], "job_id int, fingerprint string").withColumn("at", F.lit("2024-01-01").cast("timestamp"))
    rows.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = state.new_candidates(stream, ["job_id", "fingerprint"], "at").writeStream.format("memory").queryName("fresh").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.job_id, r.fingerprint) for r in spark.table("fresh").collect()) == [(1, "f"), (1, "g"), (2, "f")]
