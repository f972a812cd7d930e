"""Queries of whole corrections: sheets of two 8 x 8 images each, with hand-made boxes around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.operators import corrections as X
from packloom.operators import raster as P

from .registry import query, table
from .standins import PIXELS, pixels

#: A sheet of WIDE x HIGH pixels shows images 2 s and 2 s + 1, 4 from its top, at 4 and 20 from its left.
WIDE, HIGH = 32, 16

#: Candidates of a sheet: boxes three pixels out, but for some that cut, overlap, leave the sheet or are numbered wrongly.
_PARTS = f"""{PIXELS}, sh AS (SELECT DISTINCT vec_id // 2 AS s FROM embeddings), cd AS (
  SELECT s, k AS position, CASE WHEN s % 9 = 4 THEN k = 0 ELSE true END AS enabled, CASE WHEN s % 11 = 5 THEN 1 ELSE k + 1 END AS idx, CASE WHEN s % 13 = 6 THEN 'Other' ELSE 'Icon_Item' END AS category, CASE WHEN s % 17 = 7 THEN k + 2 ELSE k + 1 END AS number,
    CASE WHEN s % 7 = 3 AND k = 1 THEN 12 ELSE 1 + 16 * k END AS l, 1 AS t, CASE WHEN s % 19 = 8 AND k = 1 THEN 40 ELSE 15 + 16 * k END AS r, CASE WHEN s % 23 = 9 AND k = 0 THEN 7 ELSE 15 END AS b, CASE WHEN k = 1 THEN 12 ELSE 4 END AS padding, s % 2 = 1 AND k = 0 AS low, s % 29 <> 10 AS approved FROM sh, range(2) AS u(k)),
en AS (SELECT * FROM cd WHERE enabled AND approved), sp AS (SELECT vec_id // 2 AS s, x + 4 + 16 * (vec_id % 2) AS x, y + 4 AS y, a FROM px),
vw AS (SELECT en.s, position, min(x) FILTER (WHERE a >= 16) AS x0, max(x) FILTER (WHERE a >= 16) AS x1, min(y) FILTER (WHERE a >= 16) AS y0, max(y) FILTER (WHERE a >= 16) AS y1, min(x) FILTER (WHERE a > 0) AS tx0, max(x) FILTER (WHERE a > 0) AS tx1, min(y) FILTER (WHERE a > 0) AS ty0, max(y) FILTER (WHERE a > 0) AS ty1 FROM en JOIN sp ON sp.s = en.s AND x >= l AND x < r AND y >= t AND y < b GROUP BY ALL),
iv AS (SELECT en.*, r > {WIDE} AS outside, x0, x1, y0, y1, tx0, tx1, ty0, ty1 FROM en LEFT JOIN vw USING (s, position)),
gp AS (SELECT s FROM iv WHERE NOT outside AND category = 'Icon_Item' GROUP BY s HAVING NOT (min(number) = 1 AND max(number) = count(*) AND count(DISTINCT number) = count(*))),
iss AS (SELECT s, position, 'bbox-out-of-bounds' AS code FROM iv WHERE outside UNION ALL SELECT s, position, 'duplicate-source-index' FROM iv WHERE position = 1 AND idx = 1
  UNION ALL SELECT s, position, 'unsupported-category' FROM iv WHERE NOT outside AND category = 'Other' UNION ALL SELECT y.s, 1, 'overlapping-corrections' FROM iv x JOIN iv y ON x.s = y.s AND x.position = 0 AND y.position = 1 AND NOT x.outside AND NOT y.outside AND y.l < x.r AND y.t < x.b
  UNION ALL SELECT s, position, 'non-continuous-category-index' FROM iv JOIN gp USING (s) WHERE NOT outside AND category = 'Icon_Item' UNION ALL SELECT s, position, 'empty-correction' FROM iv WHERE NOT outside AND x0 IS NULL
  UNION ALL SELECT s, position, 'bbox-cuts-foreground' FROM iv WHERE NOT outside AND (x0 = l OR x1 + 1 = r OR y0 = t OR y1 + 1 = b)),
ok AS (SELECT * FROM iv WHERE s NOT IN (SELECT s FROM iss)),
ds AS (SELECT *, tx1 + 1 - tx0 AS tw, ty1 + 1 - ty0 AS th, CASE WHEN low THEN 24 ELSE tx1 + 1 - tx0 + 2 * padding END AS w, CASE WHEN low THEN 24 ELSE ty1 + 1 - ty0 + 2 * padding END AS h FROM ok)"""


def _corrected(spark: SparkSession, d: str) -> X.Corrected:
    e = table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 2).alias("s")).distinct()
    s, k = F.col("s"), F.col("position")
    project = s.cast("string").alias("project")
    settings = e.select(project, (s % 29 != 10).alias("approved"), F.lit(WIDE).alias("width"), F.lit(HIGH).alias("height"), F.lit("alpha").alias("mode"), *(F.lit(None).cast(kind).alias(c) for c, kind in (("color", "string"), ("transparent", "double"), ("opaque", "double"), ("visible", "int"), ("target_size", "array<int>"))), F.lit(12).alias("padding"), F.lit(None).cast("string").alias("alignment"), F.lit(None).cast("boolean").alias("allow_upscale"))
    rows = e.select("s", F.explode(F.array(F.lit(0), F.lit(1))).alias("position"))
    box = F.array(F.when((s % 7 == 3) & (k == 1), 12).otherwise(1 + 16 * k), F.lit(1), F.when((s % 19 == 8) & (k == 1), 40).otherwise(15 + 16 * k), F.when((s % 23 == 9) & (k == 0), 7).otherwise(15))
    low = (s % 2 == 1) & (k == 0)
    number = F.when(s % 17 == 7, k + 2).otherwise(k + 1).cast("string")
    candidates = rows.select(
        project, "position", ((s % 9 != 4) | (k == 0)).alias("enabled"), F.when(s % 11 == 5, "1").otherwise((k + 1).cast("string")).alias("source_index"), box.alias("bbox"), F.when(s % 13 == 6, "Other").otherwise("Icon_Item").alias("category"), number.alias("category_index"),
        F.concat(F.lit("image "), s.cast("string")).alias("semantic_name"), F.lit(None).cast("string").alias("state"), F.when(low, F.array(F.lit(24), F.lit(24))).alias("target_size"), F.when(k == 0, 4).alias("padding"), F.when(low, "bottom-center").alias("alignment"), low.alias("allow_upscale"),
    )
    seen = pixels(spark, d).select(F.floor(F.col("vec_id") / 2).cast("string").alias("project"), (F.col("x") + 4 + 16 * (F.col("vec_id") % 2)).cast("int").alias("x"), (F.col("y") + 4).alias("y"), *"rgba")
    grid = e.select(project, F.explode(F.sequence(F.lit(0), F.lit(WIDE - 1))).alias("x")).select("project", "x", F.explode(F.sequence(F.lit(0), F.lit(HIGH - 1))).alias("y"))
    full = grid.join(seen, ["project", "x", "y"], "left").na.fill(0, ["r", "g", "b", "a"])
    return X.applied(settings, candidates, P.packed(full, "project", WIDE, HIGH))


@query(f"""WITH {_PARTS}, sc AS (SELECT *, CASE WHEN low THEN least((w - 2 * padding) / tw, (h - 2 * padding) / th) ELSE least(1.0::DOUBLE, (w - 2 * padding) / tw, (h - 2 * padding) / th) END AS scale FROM ds), ct AS (SELECT *, greatest(1, CAST(round_even(tw * scale, 0) AS INTEGER)) AS cw, greatest(1, CAST(round_even(th * scale, 0) AS INTEGER)) AS ch FROM sc)
SELECT CAST(s AS VARCHAR) AS project, CAST(position AS INTEGER) AS position, '06_Icon_Item_Image' || s || '_Default_' || lpad(CAST(number AS VARCHAR), 3, '0') AS id, CAST(idx AS INTEGER) AS source_index, 'final/Icon_Item/06_Icon_Item_Image' || s || '_Default_' || lpad(CAST(number AS VARCHAR), 3, '0') || '.png' AS output,
  CAST(w AS INTEGER) AS width, CAST(h AS INTEGER) AS height, CASE WHEN low THEN 'bottom-center' ELSE 'center' END AS alignment, concat_ws(',', tx0 - l, ty0 - t, tx1 + 1 - l, ty1 + 1 - t) AS trim, scale, cw AS content_w, ch AS content_h, CAST((w - cw) // 2 AS INTEGER) AS content_x, CAST(CASE WHEN low THEN h - padding - ch ELSE (h - ch) // 2 END AS INTEGER) AS content_y FROM ct""")
def corrected_entries(spark, d):
    """Manifest entries of all accepted sheets, with where each crop stands on its target."""
    columns = ("project", "position", "id", "source_index", "output", "width", "height", "alignment", "scale", "content_w", "content_h", "content_x", "content_y")
    return _corrected(spark, d).entries.select(*columns, F.array_join("trim", ",").alias("trim"))


@query(f"""WITH {_PARTS} SELECT CAST(s AS VARCHAR) AS project, CAST(position AS INTEGER) AS position, code FROM iss UNION ALL SELECT DISTINCT CAST(s AS VARCHAR), CAST(NULL AS INTEGER), 'corrections-not-approved' FROM cd WHERE NOT approved""")
def corrected_issues(spark, d):
    """All issues of the flow: refusals, preflight, and those of the finished packs (which have none)."""
    return _corrected(spark, d).issues.select("project", "position", "code")


@query(f"""WITH {_PARTS}, ex AS (SELECT s, count(*) AS made FROM ok GROUP BY s), fl AS (SELECT s, count(*) AS fails FROM (SELECT s FROM iss UNION ALL SELECT DISTINCT s FROM cd WHERE NOT approved) GROUP BY s), nb AS (SELECT s, count(*) FILTER (WHERE enabled) AS enabled FROM cd GROUP BY s)
SELECT CAST(s AS VARCHAR) AS project, CASE WHEN made > 0 THEN 'complete' ELSE 'failed' END AS status, enabled AS expected_count, coalesce(made, 0) AS manifest_count, coalesce(made, 0) AS valid_assets, coalesce(made, 0) AS pass_count, CAST(0 AS BIGINT) AS warning_count, coalesce(fails, 0) AS fail_count FROM nb LEFT JOIN ex USING (s) LEFT JOIN fl USING (s)""")
def corrected_reports(spark, d):
    """One report a sheet."""
    return _corrected(spark, d).reports.drop("manual_action_required")
