"""Queries of batch planning, over request documents made of the events of a user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.operators import planning as L
from packloom.sources.files import ASSET, CATEGORY

from .registry import query, table

#: Event type -> (category, its place in the request, grid or None, transparency mode or None).
BLOCKS = {
    "signup": ("Panel", 0, (2, 2), None),
    "purchase": ("Button", 1, None, None),
    "error": ("Icon_Status", 2, (2, 3), None),
    "click": ("Icon_Item", 3, (2, 2), "chroma-key"),
    "view": ("Icon_Effect", 4, None, "model-matte-derived"),
}


def _assets(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    pick = lambda k, kind: F.coalesce(*(F.when(F.col("event_type") == t, F.lit(b[k])) for t, b in BLOCKS.items())).cast(kind)
    words = F.when(F.col("event_type") == "error", "emerald glass").when((F.col("event_type") == "purchase") & (F.col("user_id") % 2 == 0), "violet and lime").otherwise("")
    return e.select(
        F.concat(F.lit("Project "), F.col("user_id").cast("string")).alias("project_id"),
        "event_id",
        pick(0, "string").alias("category"),
        pick(1, "int").alias("place"),
        F.concat(F.lit("Asset"), (F.col("event_id") % 7).cast("string")).alias("semantic_name"),
        F.when(F.col("event_id") % 3 == 0, "Default").when(F.col("event_id") % 3 == 1, " Hover ").otherwise("Down").alias("state"),
        words.alias("description"),
        F.concat(F.lit("Frame"), (F.col("event_id") % 3).cast("string")).alias("frame_style"),
        (F.col("event_id") % 5).cast("int").alias("screen_ord"),
    )


def requests(spark: SparkSession, d: str) -> DataFrame:
    """One document for each user; a category's assets stand in the order of their events."""
    rows = _assets(spark, d)
    asset = F.struct("semantic_name", "state", "description", "frame_style", F.lit(None).cast("boolean").alias("enabled")).cast(ASSET)
    own = rows.groupBy("project_id", "category", "place").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", asset.alias("a")))), lambda x: x["a"]).alias("assets"))
    grid, mode = F.lit(None).cast("array<int>"), F.lit(None).cast("string")
    for name, _, size, how in BLOCKS.values():
        grid = F.when(F.col("category") == name, F.array(*map(F.lit, size))).otherwise(grid) if size else grid
        mode = F.when(F.col("category") == name, how).otherwise(mode) if how else mode
    none = {k: F.lit(None) for k in ("canvas", "target_size", "padding", "alignment", "chroma_key", "fragment_policy", "outer_margin", "gutter", "safe_padding")}
    order = ("category", "canvas", "grid", "target_size", "padding", "alignment", "chroma_key", "transparency_mode", "fragment_policy", "assets", "outer_margin", "gutter", "safe_padding")
    values = none | {"category": F.col("category"), "grid": grid, "transparency_mode": mode, "assets": F.col("assets")}
    block = F.struct(*(values[k].alias(k) for k in order)).cast(CATEGORY)
    grouped = own.groupBy("project_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", F.to_json(block).alias("j"), block.alias("c")).cast(f"struct<place:int,j:string,c:{CATEGORY}>")), lambda a, b: a["place"] - b["place"]), lambda x: x["c"]).alias("categories"))
    return grouped.select("project_id", F.lit("").alias("style_notes"), F.lit(None).cast("string").alias("generation_method"), "categories")


def _case(field: int) -> str:
    value = lambda b: "NULL" if b[field] is None else str(b[field][0] * b[field][1]) if field == 2 else f"'{b[field]}'" if isinstance(b[field], str) else str(b[field])
    return "CASE event_type " + " ".join(f"WHEN '{t}' THEN {value(b)}" for t, b in BLOCKS.items()) + " END"


#: Assets kept and aliases, groups packed next-fit into sheets, and the projects that are refused.
PLANNED = f"""
raw AS (SELECT 'project-' || user_id AS project, user_id, event_id, {_case(0)} AS category, {_case(1)} AS category_ord, coalesce({_case(2)}, CASE event_type WHEN 'purchase' THEN 12 ELSE 12 END) AS capacity,
  coalesce({_case(3)}, 'chroma-key') AS mode, 'Asset' || event_id % 7 AS semantic_name, ['Default', 'Hover', 'Down'][event_id % 3 + 1] AS state, 'Frame' || event_id % 3 AS frame_style FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY project, category ORDER BY event_id) - 1 AS asset_ord,
  row_number() OVER (PARTITION BY project, category, CASE WHEN category = 'Panel' THEN frame_style ELSE CAST(event_id AS VARCHAR) END ORDER BY event_id) AS copy FROM raw),
kept AS (SELECT *, row_number() OVER (PARTITION BY project, category ORDER BY asset_ord) AS category_index FROM ranked WHERE copy = 1),
grp AS (SELECT project, category, category_ord, capacity, semantic_name, min(asset_ord) AS first, count(*) AS n FROM kept GROUP BY ALL),
bad AS (SELECT DISTINCT project, category, category_ord FROM grp WHERE n > capacity),
ord AS (SELECT *, row_number() OVER (PARTITION BY project, category ORDER BY first) AS k FROM grp WHERE project NOT IN (SELECT project FROM bad)),
fit AS (WITH RECURSIVE f AS (SELECT *, 1 AS sheet, n AS fill FROM ord WHERE k = 1 UNION ALL
  SELECT o.*, CASE WHEN f.fill + o.n <= o.capacity THEN f.sheet ELSE f.sheet + 1 END, CASE WHEN f.fill + o.n <= o.capacity THEN f.fill + o.n ELSE o.n END FROM f JOIN ord o ON o.project = f.project AND o.category = f.category AND o.k = f.k + 1) SELECT * FROM f),
planned AS (SELECT kept.*, sheet, row_number() OVER (PARTITION BY project, category, sheet ORDER BY first, asset_ord) AS slot,
  lower(replace(category, '_', '-')) || '-sheet-' || lpad(CAST(sheet AS VARCHAR), 2, '0') AS job_id FROM kept JOIN fit USING (project, category, semantic_name))"""


@query(f"WITH {PLANNED} SELECT project, job_id, CAST(slot AS INTEGER) AS slot, CAST(category_index AS INTEGER) AS category_index, semantic_name, state FROM planned")
def batch_assets(spark, d):
    return L.batch_plan(requests(spark, d)).assets.select("project", "job_id", "slot", "category_index", "semantic_name", "state")


@query(f"""WITH {PLANNED} SELECT project, job_id, CAST(row_number() OVER (PARTITION BY project ORDER BY category_ord, sheet) AS INTEGER) AS generation_sequence, CAST(sheet AS INTEGER) AS sheet_number, CAST(count(*) AS INTEGER) AS expected_count,
  CASE category WHEN 'Panel' THEN 0 WHEN 'Button' THEN 1 WHEN 'Icon_Status' THEN 2 ELSE 10 END AS risk_priority, mode,
  CASE WHEN mode <> 'chroma-key' THEN NULL WHEN category = 'Icon_Status' THEN '#FF00FF' WHEN category = 'Button' AND user_id % 2 = 0 THEN '#00FFFF' ELSE '#00FF00' END AS chroma_key,
  'generated/current/' || job_id || '.png' AS generated_output, CASE WHEN mode = 'model-matte-derived' THEN 'generated/current/' || job_id || '-alpha-matte.png' END AS alpha_matte_output
FROM planned GROUP BY project, user_id, job_id, category, category_ord, sheet, mode""")
def batch_jobs(spark, d):
    return L.batch_plan(requests(spark, d)).jobs.select("project", "job_id", "generation_sequence", "sheet_number", "expected_count", "risk_priority", "mode", "chroma_key", "generated_output", "alpha_matte_output")


@query(f"""WITH {PLANNED} SELECT r.project, r.semantic_name, r.state, k.semantic_name AS reuse_semantic_name, k.state AS reuse_state FROM ranked r JOIN kept k ON k.project = r.project AND k.category = 'Panel' AND k.frame_style = r.frame_style
  WHERE r.category = 'Panel' AND r.copy > 1 AND r.project NOT IN (SELECT project FROM bad)""")
def batch_aliases(spark, d):
    return L.batch_plan(requests(spark, d)).aliases.select("project", "semantic_name", "state", "reuse_semantic_name", "reuse_state")


@query(f"WITH {PLANNED} SELECT project, category, CAST(category_ord AS INTEGER) AS category_ord, 'group-exceeds-sheet' AS code FROM bad")
def batch_issues(spark, d):
    return L.batch_plan(requests(spark, d)).issues.select("project", "category", "category_ord", "code")


@query(f"""WITH {PLANNED}, j AS (SELECT DISTINCT project, job_id, category FROM planned),
g AS (SELECT *, CASE category WHEN 'Panel' THEN 1024 ELSE 2048 END AS size, CASE category WHEN 'Panel' THEN 2 WHEN 'Button' THEN 3 WHEN 'Icon_Status' THEN 2 WHEN 'Icon_Item' THEN 2 ELSE 4 END AS nx, CASE category WHEN 'Panel' THEN 2 WHEN 'Button' THEN 4 WHEN 'Icon_Status' THEN 3 WHEN 'Icon_Item' THEN 2 ELSE 3 END AS ny FROM j),
u AS (SELECT *, size - 192 - (nx - 1) * 48 AS ux, size - 192 - (ny - 1) * 48 AS uy FROM g),
s AS (SELECT u.*, cx.i AS c, ry.i AS r FROM u, range(0, 4) AS cx(i), range(0, 4) AS ry(i) WHERE cx.i < nx AND ry.i < ny)
SELECT project, job_id, CAST(r * nx + c + 1 AS INTEGER) AS idx, CAST(96 + c * (ux // nx + 48) + least(c, ux % nx) + 64 AS INTEGER) AS sl, CAST(96 + r * (uy // ny + 48) + least(r, uy % ny) + 64 AS INTEGER) AS st FROM s""")
def batch_slots(spark, d):
    return L.batch_plan(requests(spark, d)).slots.select("project", "job_id", "idx", F.col("sl").cast("int").alias("sl"), F.col("st").cast("int").alias("st"))


_MADE = "(screen_ord = 0 OR event_id % 4 > 0)"


@query(f"""WITH a AS (SELECT user_id, event_id, event_id % 5 AS screen_ord, {_case(0)} AS category, 'Asset' || event_id % 7 AS name, CASE event_id % 3 WHEN 0 THEN 'Default' WHEN 1 THEN ' Hover ' ELSE 'Down' END AS state FROM events),
m AS (SELECT user_id, category, min(screen_ord * 1000000000 + event_id) AS first, string_agg(name || ':' || state, ',' ORDER BY screen_ord, event_id) AS names FROM a WHERE {_MADE} GROUP BY ALL),
t AS (SELECT user_id, count(*) FILTER (WHERE {_MADE}) AS generate_count, count(*) FILTER (WHERE NOT {_MADE}) AS reuse_count FROM a GROUP BY user_id),
c AS (SELECT user_id, string_agg(category || '=' || names, ';' ORDER BY first) AS assets, CAST(least(5, 1 + max(CAST(category = 'Panel' AS INTEGER)) + max(CAST(category = 'Button' AS INTEGER)) + max(CAST(category IN ('Icon_Status', 'Icon_Item') AS INTEGER))) AS INTEGER) AS budget FROM m GROUP BY user_id)
SELECT 'Project ' || t.user_id AS project_id, generate_count, reuse_count, generate_count = 0 AS all_assets_reused, coalesce(budget, 1) AS max_extra_calls, assets FROM t LEFT JOIN c USING (user_id)""")
def intake_requests(spark, d):
    rows = _assets(spark, d).withColumn("asset_ord", F.col("event_id"))
    made = (F.col("screen_ord") == 0) | (F.col("event_id") % 4 > 0)
    found = L.batch_requests(rows.withColumn("action", F.when(made, "generate").otherwise("reuse")))
    names = lambda c: F.array_join(F.transform(c["assets"], lambda a: F.concat_ws(":", a["semantic_name"], a["state"])), ",")
    text = F.array_join(F.transform("categories", lambda c: F.concat_ws("=", c["category"], names(c))), ";")
    return found.select("project_id", "generate_count", "reuse_count", "all_assets_reused", "max_extra_calls", text.alias("assets"))
