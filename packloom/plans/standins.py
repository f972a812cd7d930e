"""The pipeline's entities as views of the given tables, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table

#: Event type -> (issue code, severity); views raise no issue.
EVENT_ISSUES = {"error": ("canvas-edge-contact", "fail"), "click": ("detached-components", "warning"), "purchase": ("alpha-review-requested", "warning"), "signup": ("no-transparent-padding", "info")}
#: Event type -> generation event.
GENERATION = {"error": "timeout", "click": "rate-limit", "signup": "disconnect"}


def _case(column: Column, values: dict, k: int | None = None) -> Column:
    out = F.lit(None).cast("string")
    for name, v in values.items():
        out = F.when(column == name, v if k is None else v[k]).otherwise(out)
    return out


def _sql_case(column: str, values: dict, k: int | None = None) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{n}' THEN '{v if k is None else v[k]}'" for n, v in values.items()) + " END"


def jobs(spark: SparkSession, d: str) -> DataFrame:
    """A job is a user's day; all events name it."""
    return table(spark, d, "events").select(_job().alias("job_id")).distinct()


def _job() -> Column:
    return F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"))


def issues(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where("event_type <> 'view'")
    return e.select(F.col("event_id").alias("ord"), _job().alias("job_id"), F.get_json_object("props", "$.k").alias("asset_id"), _case(F.col("event_type"), EVENT_ISSUES, 0).alias("code"), _case(F.col("event_type"), EVENT_ISSUES, 1).alias("severity"), F.lit(None).cast("string").alias("file"))


ISSUES = f"""
jobs AS (SELECT DISTINCT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS job_id FROM events),
issues AS (
  SELECT event_id AS ord, CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS job_id, json_extract_string(props, '$.k') AS asset_id,
    {_sql_case("event_type", EVENT_ISSUES, 0)} AS code, {_sql_case("event_type", EVENT_ISSUES, 1)} AS severity
  FROM events WHERE event_type <> 'view'),
scored AS (
  SELECT *, CASE code WHEN 'canvas-edge-contact' THEN 'framing' WHEN 'detached-components' THEN 'separation' WHEN 'no-transparent-padding' THEN 'framing'
      ELSE CASE WHEN contains(code, 'matte') THEN 'matte_alignment' WHEN contains(code, 'alpha') THEN 'alpha_layering' ELSE 'other' END END AS dimension,
    CASE code WHEN 'canvas-edge-contact' THEN 34 WHEN 'detached-components' THEN 6 WHEN 'no-transparent-padding' THEN 4
      ELSE CASE WHEN contains(code, 'matte') THEN CASE WHEN severity = 'fail' THEN 30 ELSE 5 END WHEN contains(code, 'alpha') THEN CASE WHEN severity = 'fail' THEN 28 ELSE 4 END
      ELSE CASE WHEN severity = 'fail' THEN 20 ELSE 3 END END END AS penalty
  FROM issues)"""


def quantised(v: Column, shift: float = 0.55, scale: float = 230.0) -> Column:
    """0..255 of an embedding value, half to even."""
    return F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.rint((v.cast("double") + shift) * scale))).cast("int")


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """8 x 8 images of embeddings: x, y, value v, colours r, g, b and alpha a from values at fixed distances."""
    e = table(spark, d, "embeddings").select("vec_id", "label", "embedding", F.posexplode("embedding").alias("p", "e"))
    at = lambda k: F.element_at("embedding", (F.pmod(F.col("p") + k, F.lit(64)) + 1).cast("int"))
    return e.select("vec_id", "label", F.pmod("p", F.lit(8)).alias("x"), F.floor(F.col("p") / 8).cast("int").alias("y"), F.col("e").cast("double").alias("v"), quantised(at(0)).alias("r"), quantised(at(21)).alias("g"), quantised(at(42)).alias("b"), quantised(at(11), 0.2, 640.0).alias("a"))


def _q(e: str, shift: float = 0.55, scale: float = 230.0) -> str:
    return f"CAST(greatest(0.0, least(255.0, round_even((CAST({e} AS DOUBLE) + {shift}) * {scale}, 0))) AS INTEGER)"


PIXELS = f"""
px AS (
  SELECT vec_id, label, CAST((i - 1) % 8 AS INTEGER) AS x, CAST((i - 1) // 8 AS INTEGER) AS y, CAST(embedding[i] AS DOUBLE) AS v,
    {_q("embedding[i]")} AS r, {_q("embedding[(i - 1 + 21) % 64 + 1]")} AS g, {_q("embedding[(i - 1 + 42) % 64 + 1]")} AS b,
    {_q("embedding[(i - 1 + 11) % 64 + 1]", 0.2, 640.0)} AS a
  FROM embeddings, range(1, 65) AS t(i))"""


def boxes(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of an order's lineitems; pos orders them and is unique among distinct rows."""
    rows = table(spark, d, "lineitem")
    l, t = F.col("l_quantity").cast("int"), F.rint(F.col("l_discount") * 500).cast("int")  # noqa: E741
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_suppkey", l.alias("l"), t.alias("t"), (F.rint(F.col("l_tax") * 250).cast("int") + 4).alias("w"), (F.pmod("l_partkey", F.lit(17)) + 3).cast("int").alias("h"))).alias("k")).select(F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("comp_id"), "k.l", "k.t", (F.col("k.l") + F.col("k.w")).alias("r"), (F.col("k.t") + F.col("k.h")).alias("b"), (F.col("k.w") * F.col("k.h")).alias("pixels"))


BOXES = """
boxes AS (
  SELECT image_id, comp_id, l, t, l + w AS r, t + h AS b, w * h AS pixels FROM (
    SELECT l_orderkey AS image_id, l_linenumber AS comp_id, CAST(l_quantity AS INTEGER) AS l, CAST(round_even(l_discount * 500, 0) AS INTEGER) AS t,
      CAST(round_even(l_tax * 250, 0) AS INTEGER) + 4 AS w, CAST(l_partkey % 17 + 3 AS INTEGER) AS h,
      row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, CAST(l_quantity AS INTEGER), round_even(l_discount * 500, 0), round_even(l_tax * 250, 0)) AS k
    FROM lineitem) WHERE k = 1)"""


def generation_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(F.col("user_id").alias("run_id"), "ts", "event_id", F.coalesce(_case(F.col("event_type"), GENERATION), F.lit("success")).alias("event"))


GENERATED = f"""
gen AS (SELECT user_id AS run_id, ts, event_id, coalesce({_sql_case("event_type", GENERATION)}, 'success') AS event FROM events)"""
