"""Queries of the delivery operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from packloom.operators import delivery as D
from packloom.operators import scoring

from .registry import query, table
from .standins import ISSUES, issues, jobs
from .table_queries import _ROLLED


@query("""WITH m AS (SELECT CAST(o_custkey AS VARCHAR) AS job_id, o_orderkey % 10 AS source_index, CAST(o_orderkey AS VARCHAR) || '.png' AS file, CAST(o_orderkey AS VARCHAR) AS asset_id FROM orders),
i AS (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN CAST(user_id AS VARCHAR) END AS job_id, event_id % 10 AS source_index, CAST(event_id AS VARCHAR) || '.png' AS file, CASE WHEN event_id % 7 = 0 THEN 'own' END AS asset_id FROM events),
x AS (SELECT job_id, source_index, min(asset_id) AS a1 FROM m GROUP BY ALL), f AS (SELECT file, arg_min(job_id, asset_id) AS j, min(asset_id) AS a2 FROM m GROUP BY file)
SELECT event_id, coalesce(i.job_id, f.j) AS job_id, coalesce(i.asset_id, a1, a2) AS asset_id FROM i LEFT JOIN x ON x.job_id = i.job_id AND x.source_index = i.source_index LEFT JOIN f ON f.file = i.file""")
def issue_attribution(spark, d):
    k = F.col("o_orderkey")
    manifest = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("job_id"), (k % 10).alias("source_index"), F.concat(k.cast("string"), F.lit(".png")).alias("file"), k.cast("string").alias("asset_id"))
    e = F.col("event_id")
    found = table(spark, d, "events").select("event_id", F.when(e % 3 != 0, F.col("user_id").cast("string")).alias("job_id"), (e % 10).alias("source_index"), F.concat(e.cast("string"), F.lit(".png")).alias("file"), F.when(e % 7 == 0, "own").alias("asset_id"))
    return D.attributed(found, manifest).select("event_id", "job_id", "asset_id")


@query("""WITH u AS (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_tax, l_discount, l_shipdate, l_returnflag, l_linestatus, l_suppkey, l_partkey FROM lineitem),
e AS (SELECT l_partkey AS asset_id, l_quantity AS w, l_tax AS h FROM u UNION ALL SELECT l_suppkey, l_quantity, l_tax FROM u WHERE l_suppkey <> l_partkey)
SELECT asset_id, CAST(count(DISTINCT (w, h)) AS INTEGER) AS n_sizes, min(w) AS least_w, count(*) AS uses FROM e GROUP BY asset_id""")
def layout_target_sizes(spark, d):
    elements = table(spark, d, "lineitem").distinct()
    out = D.target_sizes(elements, ["l_partkey", "l_suppkey"], "l_quantity", "l_tax")
    return out.select("asset_id", F.size("sizes").alias("n_sizes"), F.element_at("sizes", 1)["w"].alias("least_w"), "uses")


_ELEMENTS = "el AS (SELECT DISTINCT l_orderkey AS screen, l_linenumber AS ord, l_partkey AS id, CASE WHEN l_suppkey % 4 > 0 THEN l_partkey - l_suppkey % 4 + 1 END AS parent FROM lineitem)"


@query(f"""WITH {_ELEMENTS}, p AS (SELECT screen, id, min(ord) AS at FROM el GROUP BY screen, id)
SELECT el.screen, el.ord, el.id, el.parent, CASE WHEN el.parent IS NULL THEN NULL WHEN p.at IS NULL THEN 'unknown-parent' WHEN el.parent = el.id THEN 'own-parent' WHEN p.at >= el.ord THEN 'parent-not-earlier' END AS problem
FROM el LEFT JOIN p ON p.screen = el.screen AND p.id = el.parent""".replace(" AS at FROM", ' AS "at" FROM').replace("p.at", 'p."at"'))
def element_order_validity(spark, d):
    rest = F.col("l_suppkey") % 4
    elements = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("screen"), F.col("l_linenumber").alias("ord"), F.col("l_partkey").alias("id"), F.when(rest > 0, F.col("l_partkey") - rest + 1).alias("parent")).distinct()
    return D.element_order(elements, "screen", "ord", "id", "parent")


@query(f"""WITH {ISSUES}, sc AS ({_ROLLED.format(key='job_id', keys='jobs')}), c AS (SELECT job_id, list_sort(list(DISTINCT code)) AS codes FROM issues GROUP BY job_id),
r AS (SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS job_id, round(max(value), 6) AS result FROM events GROUP BY 1)
SELECT j.job_id, array_to_string(coalesce(codes, []), ',') AS codes, score, status, result FROM jobs j LEFT JOIN c USING (job_id) LEFT JOIN sc USING (job_id) LEFT JOIN r USING (job_id)""")
def job_overview(spark, d):
    key = F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"))
    results = table(spark, d, "events").groupBy(key.alias("job_id")).agg(F.round(F.max("value"), 6).alias("result"))
    found, every = issues(spark, d), jobs(spark, d)
    return D.job_overview(every, found, scoring.job_scores(found, every), results).select("job_id", F.array_join("codes", ",").alias("codes"), "score", "status", "result")


@query("""WITH k AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS k, o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 AS of_source, o_orderkey % 3 = 0 AS to_matte, o_orderkey % 3 = 1 AS to_proof, o_custkey % 2 = 0 AS matte, o_custkey % 3 = 0 AS proof FROM orders)
SELECT o_orderkey, CASE WHEN of_source THEN 's' || k WHEN to_matte AND matte THEN 'm' || k WHEN to_proof AND proof THEN 'p' || k WHEN matte THEN 's' || k || ',m' || k ELSE 's' || k END AS targets FROM k""")
def retry_targets(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    path = lambda letter: F.concat(F.lit(letter), k.cast("string"))
    code = F.when(k % 7 == 0, "source-edge-contact").when(k % 11 == 0, "status-green-reflection").otherwise("empty-slot")
    target = F.when(k % 3 == 0, "alpha-matte").when(k % 3 == 1, "native-alpha-provenance").otherwise("production-sheet")
    rows = table(spark, d, "orders").select("o_orderkey", code.alias("code"), target.alias("retry_target"), F.when(c % 2 == 0, "model-matte-derived").otherwise("chroma-key").alias("transparency_mode"), path("s").alias("sheet_path"), F.when(c % 2 == 0, path("m")).alias("matte_path"), F.when(c % 3 == 0, path("p")).alias("provenance_path"))
    return D.retry_targets(rows).select("o_orderkey", F.array_join("targets", ",").alias("targets"))


@query("""WITH p AS (SELECT DISTINCT source, doc_id, sha256(lang || CAST(doc_id % 2 AS VARCHAR)) AS awaiting FROM documents), n AS (SELECT doc_id, sha256(lang || CAST(quality AS VARCHAR)) AS now FROM documents JOIN labels USING (doc_id))
SELECT source, count(*) FILTER (WHERE now = awaiting) = 0 AS open, count(*) FILTER (WHERE now = awaiting) AS waiting FROM p LEFT JOIN n USING (doc_id) GROUP BY source""")
def retry_gate(spark, d):
    docs = table(spark, d, "documents")
    planned = docs.select("source", "doc_id", F.sha2(F.concat("lang", (F.col("doc_id") % 2).cast("string")), 256).alias("awaiting"))
    seen = docs.join(table(spark, d, "labels"), "doc_id").select("doc_id", F.sha2(F.concat("lang", F.col("quality").cast("string")), 256).alias("sha256"))
    return D.retry_gate(planned, seen, "source", "doc_id")


@query("SELECT event_id, CASE event_type WHEN 'error' THEN 'qa-failed' WHEN 'click' THEN 'processing' WHEN 'view' THEN 'regeneration' WHEN 'purchase' THEN 'assets-complete' ELSE event_type END AS stage FROM events")
def safe_stage_mapping(spark, d):
    kind = F.col("event_type")
    status = F.when(kind == "error", "failed").when(kind == "click", "ready-for-processing").when(kind == "view", "awaiting-regeneration").when(kind == "purchase", "unity-failed").otherwise(kind)
    return table(spark, d, "events").select("event_id", D.safe_stage(status).alias("stage"))


@query("""WITH o AS (SELECT p_brand, p_name, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part)
SELECT p_brand, 'Sheet for ' || p_brand || ' with ' || CAST(count(*) AS VARCHAR) || ' assets:' || chr(10) || string_agg(CAST(k AS VARCHAR) || '. ' || p_name || ' / ' || p_type, chr(10) ORDER BY k) AS prompt FROM o GROUP BY p_brand""")
def sheet_prompts(spark, d):
    assets = table(spark, d, "part").select("p_brand", "p_partkey", F.col("p_brand").alias("category"), F.col("p_name").alias("name"), F.col("p_type").alias("state"))
    return D.prompts(assets, "p_brand", "p_partkey", "Sheet for %s with %d assets:\n%s")


@query("""WITH i AS (SELECT DISTINCT o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag <> 'N' AS present, l_suppkey % 7 = 0 AS unchanged FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
j AS (SELECT o_custkey, l_orderkey, count(*) AS n, sum(CAST(present AS BIGINT)) AS p, sum(CAST(present AND unchanged AS BIGINT)) AS w FROM i GROUP BY ALL)
SELECT o_custkey, count(*) AS job_count, count(*) FILTER (WHERE p = n AND w = 0) AS ready_job_count, count(*) FILTER (WHERE p < n OR w > 0) AS pending_job_count, CAST(sum(n) AS BIGINT) AS required_input_count,
  CAST(sum(p) AS BIGINT) AS ready_input_count, CAST(sum(n - p) AS BIGINT) AS missing_input_count, CAST(sum(w) AS BIGINT) AS pending_replacement_count FROM j GROUP BY o_custkey""")
def generation_state(spark, d):
    # A customer's orders are the jobs of a run, their lineitems the required inputs.
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_returnflag") != "N").alias("present"), (F.col("l_suppkey") % 7 == 0).alias("unchanged")).distinct()
    owners = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return D.generation_state(items.join(owners, "l_orderkey"), "o_custkey", "l_orderkey")


@query("""WITH t AS (SELECT o_custkey, o_orderkey * 2 + k AS sequence, CASE k WHEN 0 THEN 'production-sheet' ELSE 'alpha-matte' END AS kind, o_orderkey % 40 = 0 AS is_retry, o_orderkey AS job_sequence, o_orderstatus = 'F' AS inputs_ready,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 0 WHEN '2' THEN 1 ELSE 10 END AS priority FROM orders, (VALUES (0), (1)) AS v(k) WHERE CASE k WHEN 0 THEN o_custkey % 3 > 0 AND o_orderstatus <> 'F' ELSE o_orderkey % 2 = 0 END),
w AS (SELECT o_custkey, CASE WHEN bool_or(is_retry) THEN 'retry' WHEN bool_or(kind = 'production-sheet' AND priority < 10) THEN 'risk-production' WHEN bool_or(kind = 'production-sheet') THEN 'production' ELSE 'dependent' END AS wave_kind FROM t GROUP BY o_custkey),
c AS (SELECT t.*, wave_kind, row_number() OVER (PARTITION BY t.o_custkey ORDER BY CASE WHEN wave_kind LIKE '%production' THEN priority ELSE 0 END, sequence) AS slot FROM t JOIN w USING (o_custkey)
  WHERE CASE wave_kind WHEN 'retry' THEN is_retry WHEN 'risk-production' THEN kind = 'production-sheet' AND priority < 10 WHEN 'production' THEN kind = 'production-sheet' ELSE inputs_ready END)
SELECT w.o_custkey, w.wave_kind, sequence, CAST(slot AS INTEGER) AS slot FROM w LEFT JOIN c ON c.o_custkey = w.o_custkey AND slot <= CASE w.wave_kind WHEN 'risk-production' THEN 2 WHEN 'production' THEN 3 ELSE 1 END""")
def generation_wave(spark, d):
    k = F.col("o_orderkey")
    first = F.substring("o_orderpriority", 1, 1)
    rows = table(spark, d, "orders").select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    rows = rows.where(F.when(F.col("k") == 0, (F.col("o_custkey") % 3 > 0) & (F.col("o_orderstatus") != "F")).otherwise(k % 2 == 0))
    tasks = rows.select("o_custkey", (k * 2 + F.col("k")).alias("sequence"), F.when(F.col("k") == 0, "production-sheet").otherwise("alpha-matte").alias("kind"), (k % 40 == 0).alias("is_retry"), k.cast("long").alias("job_sequence"), (F.col("o_orderstatus") == "F").alias("inputs_ready"), F.when(first == "1", 0).when(first == "2", 1).otherwise(10).alias("priority"))
    return D.next_wave(tasks, "o_custkey")


@query("""WITH j AS (SELECT o_custkey, o_orderkey, 1 + CAST(o_orderkey % 3 = 0 AS INTEGER) AS calls, o_custkey % 8 - 1 AS extra, o_custkey % 4 AS committed FROM orders),
r AS (SELECT o_custkey, count(*) AS jobs, CAST(sum(calls) AS BIGINT) AS initial_image_calls, greatest(0, least(5, max(extra))) AS max_extra_calls, max(committed) AS extra_calls_committed FROM j GROUP BY o_custkey),
w AS (SELECT *, greatest(0, max_extra_calls - extra_calls_committed) AS extra_calls_remaining, CAST(ceil(jobs / 3.0) AS BIGINT) + initial_image_calls - jobs AS estimated_parallel_waves FROM r)
SELECT *, CAST(estimated_parallel_waves * 5 AS DOUBLE) AS least_minutes, CAST((estimated_parallel_waves + max_extra_calls) * 8 AS DOUBLE) AS most_minutes FROM w""")
def generation_budget_totals(spark, d):
    k = F.col("o_orderkey")
    jobs = table(spark, d, "orders").select("o_custkey", (1 + (k % 3 == 0).cast("int")).alias("calls"), (F.col("o_custkey") % 8 - 1).alias("max_extra"), (F.col("o_custkey") % 4).alias("committed"))
    return D.budget_state(jobs, "o_custkey")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def first_tasks(spark, d):
    return D.first_of_each(table(spark, d, "events").select("user_id", "event_id", "event_type", "ts"), "user_id", ["ts", "event_id"]).drop("ts")


@query("""WITH f AS (SELECT user_id, json_extract_string(props, '$.k') AS fingerprint, min((ts, event_id)) AS a FROM events GROUP BY ALL)
SELECT user_id, fingerprint, CAST(row_number() OVER (PARTITION BY user_id ORDER BY a) AS INTEGER) AS attempt FROM f""")
def candidate_attempts(spark, d):
    rows = table(spark, d, "events").select("user_id", "ts", "event_id", F.get_json_object("props", "$.k").alias("fingerprint"))
    return D.candidates(rows, "user_id", ["ts", "event_id"], "fingerprint")


@query("""WITH v AS (SELECT a.vec_id, CAST(a.embedding[i] AS DOUBLE) AS x, CAST(b.embedding[i] AS DOUBLE) AS y FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1, range(1, 65) AS t(i))
SELECT vec_id, round(sum(abs(x - y)), 6) AS l1, round(max(abs(x - y)), 6) AS linf, round(avg(abs(x - y)), 6) AS mean_abs FROM v GROUP BY vec_id""")
def signature_distances(spark, d):
    e = table(spark, d, "embeddings")
    pairs = e.select("vec_id", F.col("embedding").alias("a")).join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b")), "vec_id")
    return D.similarity_reductions(pairs, "a", "b").select("vec_id", *(F.round(c, 6).alias(c) for c in ("l1", "linf", "mean_abs")))
