"""Queries of orchestration: orders as runs, their lineitems as inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.operators import orchestration as O

from .registry import query, table


def _observed(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("run"), F.col("l_linenumber").alias("job"), "l_quantity", "l_tax", F.concat_ws("/", F.lit("generated"), F.col("l_linenumber").cast("string"), F.col("l_suppkey").cast("string")).alias("path"), F.sha2(F.col("l_partkey").cast("string"), 256).alias("digest"))
    inputs = items.select("run", "job", "path", F.when(F.col("l_quantity") >= 2, F.col("digest")).alias("sha256"))
    planned = items.where("run % 5 = 0 AND l_tax > 0.05").select("run", "path", F.when(F.col("run") % 2 == 0, F.col("digest")).otherwise("old").alias("sha256"))
    hygiene = items.where("run % 23 = 0").select("run")
    gates = items.where("l_quantity = 50").select("run", "job")
    return O.observed(items.select("run", "job"), inputs, hygiene, planned, gates, "run")


_OBSERVED = """
p AS (SELECT DISTINCT l_orderkey AS run, 'generated/' || l_linenumber || '/' || l_suppkey AS path, CASE WHEN l_orderkey % 2 = 0 THEN sha256(CAST(l_partkey AS VARCHAR)) ELSE 'old' END AS before FROM lineitem WHERE l_orderkey % 5 = 0 AND l_tax > 0.05),
i AS (SELECT DISTINCT l_orderkey AS run, 'generated/' || l_linenumber || '/' || l_suppkey AS path, CASE WHEN l_quantity >= 2 THEN sha256(CAST(l_partkey AS VARCHAR)) END AS sha FROM lineitem),
w AS (SELECT p.run, count(*) FILTER (WHERE sha IS NULL OR sha = before) AS pending FROM p LEFT JOIN i USING (run, path) GROUP BY p.run),
o AS (SELECT l_orderkey AS run, l_orderkey % 23 <> 0 AS hygiene_ok, coalesce(any_value(w.pending), 0) AS pending_replacements, coalesce(any_value(w.pending) = 0, false) AS candidate_ready,
  count(*) FILTER (WHERE l_quantity = 50) AS gate_failures, count(*) FILTER (WHERE l_quantity < 2) AS missing_inputs FROM lineitem LEFT JOIN w ON w.run = l_orderkey GROUP BY l_orderkey)"""


@query(f"WITH {_OBSERVED.strip()} SELECT * FROM o")
def delivery_observations(spark, d):
    return _observed(spark, d)


@query(f"""WITH {_OBSERVED.strip()}, f AS (SELECT o.*, o_orderkey % 3 AS retry_items, o_orderstatus = 'F' AS done, o_orderkey % 2 = 0 AS has_manifest, o_orderpriority = '1-URGENT' OR candidate_ready AS force,
  CASE o_orderkey % 3 WHEN 1 THEN true WHEN 2 THEN false END AS result_ok, CASE o_orderkey % 4 WHEN 1 THEN 'complete' WHEN 2 THEN 'unity-blocked' WHEN 3 THEN 'odd' ELSE 'complete' END AS delivery, CASE WHEN o_orderkey % 3 > 0 THEN 'awaiting-regeneration' ELSE 'failed' END AS retried FROM o JOIN orders ON o_orderkey = run),
s AS (SELECT *, CASE WHEN NOT hygiene_ok THEN 1 WHEN pending_replacements > 0 THEN 2 WHEN gate_failures > 0 THEN 3 WHEN missing_inputs > 0 THEN 4 WHEN done AND has_manifest AND NOT force THEN 5 WHEN has_manifest AND NOT force THEN 6 WHEN result_ok IS NULL THEN 7 WHEN result_ok THEN 8 ELSE 9 END AS gate,
  CASE WHEN delivery = 'odd' THEN 'unity-failed' ELSE delivery END AS final FROM f)
SELECT run, CASE gate WHEN 1 THEN 'configuration-invalid' WHEN 2 THEN 'awaiting-regeneration' WHEN 3 THEN retried WHEN 4 THEN 'awaiting-generation' WHEN 5 THEN final WHEN 6 THEN 'failed' WHEN 7 THEN 'ready-for-processing' WHEN 8 THEN final ELSE retried END AS status,
  CASE WHEN gate IN (1, 6) THEN false WHEN gate IN (2, 4, 7) THEN true WHEN gate IN (3, 9) THEN retry_items > 0 ELSE final = 'complete' END AS ok, gate = 5 AND final = 'complete' AS reused FROM s""")
def delivery_statuses(spark, d):
    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    facts = o.select(key.alias("run"), (key % 3).alias("retry_items"), F.when(F.col("o_orderstatus") == "F", "complete").alias("prior_status"), (key % 2 == 0).alias("has_manifest"), (F.col("o_orderpriority") == "1-URGENT").alias("force"), F.when(key % 3 == 1, True).when(key % 3 == 2, False).alias("result_ok"), F.when(key % 4 == 1, "complete").when(key % 4 == 2, "unity-blocked").when(key % 4 == 3, "odd").alias("delivery_status"))
    return _observed(spark, d).join(facts, "run").select("run", O.next_status().alias("n")).select("run", "n.status", "n.ok", "n.reused")
