"""Queries of the repair operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from packloom.functions import constants as C
from packloom.functions import scalars as S
from packloom.operators import repair as X

from .registry import query, table
from .standins import ISSUES, PIXELS, issues, jobs, pixels

_USER = "CAST(split_part(job_id, '-', 1) AS BIGINT)"
#: Failing issues of some users are of the matte or of the provenance.
_FAILED = f"""{ISSUES}, fx AS (SELECT job_id, severity, CASE WHEN severity = 'fail' AND {_USER} % 4 = 0 THEN 'insufficient-partial-alpha-pixels' WHEN severity = 'fail' AND {_USER} % 4 = 1 THEN 'missing-native-alpha-provenance' WHEN severity = 'fail' AND {_USER} % 8 = 2 THEN 'source-matte-pixel-mismatch' ELSE code END AS code FROM issues),
fp AS (SELECT *, CASE code WHEN 'insufficient-partial-alpha-pixels' THEN 30 WHEN 'missing-native-alpha-provenance' THEN 35 WHEN 'source-matte-pixel-mismatch' THEN 40 WHEN 'canvas-edge-contact' THEN 34 WHEN 'detached-components' THEN 6 ELSE 4 END AS penalty FROM fx)"""


def _failed(spark, d):
    user, fails = F.split_part("job_id", F.lit("-"), F.lit(1)).cast("long"), F.col("severity") == "fail"
    code = F.when(fails & (user % 4 == 0), "insufficient-partial-alpha-pixels").when(fails & (user % 4 == 1), "missing-native-alpha-provenance").when(fails & (user % 8 == 2), "source-matte-pixel-mismatch").otherwise(F.col("code"))
    return issues(spark, d).withColumn("code", code)


_TEXTS = {k: C.ISSUE_INSTRUCTIONS[k] for k in ("insufficient-partial-alpha-pixels", "missing-native-alpha-provenance", "source-matte-pixel-mismatch", "canvas-edge-contact", "detached-components", "no-transparent-padding")}
_ALPHA, _OTHER = C.FALLBACK_CORRECTIONS[1][1], C.FALLBACK_CORRECTIONS[2][1]
_INSTRUCTION = "CASE code " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _TEXTS.items()) + f" WHEN 'alpha-review-requested' THEN '{_ALPHA}' ELSE '{_OTHER}' END"
_TARGET = "CASE code WHEN 'insufficient-partial-alpha-pixels' THEN 'alpha-matte' WHEN 'source-matte-pixel-mismatch' THEN 'alpha-matte' WHEN 'missing-native-alpha-provenance' THEN 'native-alpha-provenance' ELSE 'production-sheet' END"


@query(f"WITH {_FAILED} SELECT DISTINCT code, {_INSTRUCTION} AS instruction, {_TARGET} AS target FROM fp")
def issue_corrections(spark, d):
    fix = S.correction_of(F.col("code"))
    return _failed(spark, d).select("code", fix["instruction"].alias("instruction"), fix["target"].alias("target")).distinct()


_PLAN = f"""{_FAILED}, jb AS (SELECT job_id, {_USER} AS run, CAST(split_part(job_id, '-', 2) AS BIGINT) AS ord FROM jobs),
bl AS (SELECT job_id, bool_or(severity = 'fail') AS blocked FROM fp GROUP BY job_id),
pr AS (SELECT job_id, code FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY (severity = 'fail') DESC, penalty DESC, code DESC) AS k FROM fp) WHERE k = 1),
j0 AS (SELECT jb.*, CASE run % 3 WHEN 0 THEN 'model-matte-derived' WHEN 1 THEN 'native-alpha-required' ELSE 'chroma-key' END AS mode, 's' || job_id || '.png' AS sheet, CASE WHEN run % 3 = 0 THEN 'm' || job_id || '.png' END AS matte, CASE WHEN run % 3 = 1 THEN 'p' || job_id || '.json' END AS prov, CAST(ord % 4 AS INTEGER) AS attempts,
  CASE WHEN ord % 5 > 0 THEN ord % 7 > 0 END AS result, blocked, code AS c0 FROM jb LEFT JOIN bl USING (job_id) LEFT JOIN pr USING (job_id)),
j1 AS (SELECT *, coalesce(result, false) AND NOT coalesce(blocked, false) AS passed FROM j0 WHERE result IS NOT NULL OR blocked IS NOT NULL),
j2 AS (SELECT *, CASE WHEN NOT passed THEN coalesce(c0, 'unclassified-job-failure') END AS code FROM j1), j3 AS (SELECT *, {_TARGET} AS target FROM j2),
j4 AS (SELECT *, CASE WHEN starts_with(code, 'source-') THEN [sheet] WHEN target = 'alpha-matte' AND matte IS NOT NULL THEN [matte] WHEN target = 'native-alpha-provenance' AND prov IS NOT NULL THEN [prov] WHEN mode = 'model-matte-derived' THEN [sheet, matte] ELSE [sheet] END AS targets FROM j3),
j5 AS (SELECT *, len([x FOR x IN targets IF ends_with(x, '.png')]) AS calls FROM j4), nd AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY ord, job_id) AS k FROM j5 WHERE NOT passed AND attempts < 3),
fo AS (WITH RECURSIVE fold AS (SELECT run, job_id, k, calls, calls <= 3 - run % 3 AS fits, 3 - run % 3 - CASE WHEN calls <= 3 - run % 3 THEN calls ELSE 0 END AS rem FROM nd WHERE k = 1
  UNION ALL SELECT nd.run, nd.job_id, nd.k, nd.calls, nd.calls <= rem, rem - CASE WHEN nd.calls <= rem THEN nd.calls ELSE 0 END FROM fold JOIN nd ON nd.run = fold.run AND nd.k = fold.k + 1) SELECT * FROM fold),
pl AS (SELECT j5.*, CASE WHEN passed THEN 'ok' WHEN attempts >= 3 THEN 'exhausted' WHEN fits THEN 'awaiting-regeneration' ELSE 'generation-budget-exhausted' END AS status FROM j5 LEFT JOIN fo ON fo.job_id = j5.job_id)"""


def _plan(spark, d):
    user, ord_ = F.split_part("job_id", F.lit("-"), F.lit(1)).cast("long"), F.split_part("job_id", F.lit("-"), F.lit(2)).cast("long")
    rows = jobs(spark, d).select("job_id", user.alias("run"), ord_.alias("ord"))
    mode = F.element_at(F.array(*map(F.lit, ("model-matte-derived", "native-alpha-required", "chroma-key"))), (F.col("run") % 3 + 1).cast("int"))
    path = lambda a, b: F.concat(F.lit(a), "job_id", F.lit(b))
    every = rows.withColumns({"transparency_mode": mode, "sheet_path": path("s", ".png"), "matte_path": F.when(F.col("run") % 3 == 0, path("m", ".png")), "provenance_path": F.when(F.col("run") % 3 == 1, path("p", ".json")), "attempts": (F.col("ord") % 4).cast("int")})
    results = rows.where("ord % 5 > 0").select("job_id", (F.col("ord") % 7 > 0).alias("ok"))
    budgets = rows.select("run").distinct().withColumn("remaining", (3 - F.col("run") % 3).cast("int"))
    return X.regeneration_plan(every, _failed(spark, d), results, budgets, "run")


@query(f"""WITH {_PLAN} SELECT run, job_id, status, attempts, code, CASE WHEN status LIKE 'await%' THEN attempts + 1 END AS next_attempt, CASE WHEN status LIKE 'await%' THEN target END AS retry_target, CASE WHEN status LIKE 'await%' THEN array_to_string(targets, ',') END AS targets,
  CAST(CASE WHEN status LIKE 'await%' THEN calls ELSE 0 END AS INTEGER) AS planned_extra_calls, CASE WHEN status LIKE 'await%' THEN {_INSTRUCTION} END AS instruction FROM pl""")
def regeneration_plan(spark, d):
    return _plan(spark, d).withColumn("targets", F.array_join("targets", ","))


@query(f"""WITH {_PLAN} SELECT job_id, 'Draw ' || job_id || chr(10) || chr(10) || '## Focused correction attempt ' || CAST(attempts + 1 AS VARCHAR) || '/3' || chr(10) || chr(10) || 'Fix exactly this defect: `' || code || '`.' || chr(10) || {_INSTRUCTION} || chr(10)
  || 'Keep the approved style, ordered resource list, canvas, grid, and every unrelated visual decision unchanged.' || chr(10) || 'Do not combine this retry with unrelated redesigns.' || chr(10) AS prompt FROM pl WHERE status LIKE 'await%'""")
def retry_prompts(spark, d):
    rows = _plan(spark, d).where("status = 'awaiting-regeneration'")
    return rows.select("job_id", X.retry_prompt(F.concat(F.lit("Draw "), "job_id", F.lit("  ")), F.col("code"), F.col("instruction"), F.col("next_attempt"), 3).alias("prompt"))


#: Four candidates for each 8 x 8 image: boxes that may leave it, be empty or overlap, and indices that may be no numbers.
_CANDIDATES = """cd AS (SELECT vec_id, k AS position, vec_id % 11 <> k AS enabled, CASE WHEN vec_id % 7 = k THEN 'x' WHEN vec_id % 5 = k THEN '1' ELSE CAST(k + 1 AS VARCHAR) END AS source_index,
  CASE WHEN vec_id % 13 = k THEN [1, 2, 3] ELSE [CAST((vec_id + 3 * k) % 9 - 1 AS INTEGER), CAST((vec_id + 5 * k) % 7 AS INTEGER), CAST((vec_id + 3 * k) % 9 - 1 + vec_id % 4 AS INTEGER), CAST((vec_id + 5 * k) % 7 + 2 AS INTEGER)] END AS bbox,
  CASE WHEN vec_id % 17 = k THEN 'Other' ELSE 'Panel' END AS category, CASE WHEN vec_id % 19 = k THEN 'y' ELSE CAST(k + 1 AS VARCHAR) END AS category_index FROM embeddings, range(4) AS t(k)),
en AS (SELECT *, coalesce(TRY_CAST(source_index AS INTEGER), position + 1) AS idx, len(bbox) = 4 AS shape, bbox[1] AS l, bbox[2] AS t, bbox[3] AS r, bbox[4] AS b FROM cd WHERE enabled),
e2 AS (SELECT *, min(position) OVER (PARTITION BY vec_id, idx) AS first, shape AND (l < 0 OR t < 0 OR r > 8 OR b > 8) AS outside FROM en),
e3 AS (SELECT *, shape AND NOT outside AND (l >= r OR t >= b) AS empty, shape AND NOT outside AND NOT (l >= r OR t >= b) AS valid FROM e2),
vd AS (SELECT * FROM e3 WHERE valid), nm AS (SELECT *, TRY_CAST(category_index AS INTEGER) AS number FROM vd WHERE category = 'Panel' AND TRY_CAST(category_index AS INTEGER) IS NOT NULL),
gp AS (SELECT vec_id FROM nm GROUP BY vec_id HAVING NOT (min(number) = 1 AND max(number) = count(*) AND count(DISTINCT number) = count(*))),
sp AS (SELECT vd.vec_id, vd.position, vd.l, vd.t, vd.r, vd.b, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM vd LEFT JOIN px ON px.vec_id = vd.vec_id AND px.a >= 16 AND x >= vd.l AND x < vd.r AND y >= vd.t AND y < vd.b GROUP BY ALL),
ct AS (SELECT *, x0 = l AS cl, y0 = t AS ctp, x1 + 1 = r AS cr, y1 + 1 = b AS cb FROM sp)"""


@query(f"""WITH {PIXELS}, {_CANDIDATES}
SELECT vec_id, CAST(position AS INTEGER) AS position, code, CAST(other AS INTEGER) AS other, recommended FROM (
  SELECT vec_id, position, 'invalid-source-index' AS code, NULL AS other, NULL::VARCHAR AS recommended FROM e3 WHERE TRY_CAST(source_index AS INTEGER) IS NULL
  UNION ALL SELECT vec_id, position, 'duplicate-source-index', first, NULL FROM e3 WHERE first < position UNION ALL SELECT vec_id, position, 'invalid-bbox-shape', NULL, NULL FROM e3 WHERE NOT shape
  UNION ALL SELECT vec_id, position, 'bbox-out-of-bounds', NULL, concat_ws(',', greatest(0, least(l, 8)), greatest(0, least(t, 8)), greatest(0, least(r, 8)), greatest(0, least(b, 8))) FROM e3 WHERE outside UNION ALL SELECT vec_id, position, 'empty-bbox', NULL, NULL FROM e3 WHERE empty
  UNION ALL SELECT vec_id, position, 'unsupported-category', NULL, NULL FROM vd WHERE category <> 'Panel' UNION ALL SELECT vec_id, position, 'invalid-category-index', NULL, NULL FROM vd WHERE TRY_CAST(category_index AS INTEGER) IS NULL
  UNION ALL SELECT y.vec_id, y.position, 'overlapping-corrections', x.position, NULL FROM vd x JOIN vd y ON x.vec_id = y.vec_id AND x.position < y.position AND greatest(x.l, y.l) < least(x.r, y.r) AND greatest(x.t, y.t) < least(x.b, y.b)
  UNION ALL SELECT vec_id, position, 'non-continuous-category-index', NULL, NULL FROM nm JOIN gp USING (vec_id)
  UNION ALL SELECT vec_id, position, CASE WHEN x0 IS NULL THEN 'empty-correction' ELSE 'bbox-cuts-foreground' END, NULL,
    CASE WHEN x0 IS NOT NULL THEN concat_ws(',', greatest(0, l - CASE WHEN cl THEN 4 ELSE 0 END), greatest(0, t - CASE WHEN ctp THEN 4 ELSE 0 END), least(8, r + CASE WHEN cr THEN 4 ELSE 0 END), least(8, b + CASE WHEN cb THEN 4 ELSE 0 END)) END FROM ct WHERE x0 IS NULL OR cl OR ctp OR cr OR cb)""")
def correction_preflight(spark, d):
    v, k = F.col("vec_id"), F.col("position")
    rows = table(spark, d, "embeddings").select("vec_id", F.explode(F.array(*map(F.lit, range(4)))).alias("position"))
    l, t = ((v + 3 * k) % 9 - 1).cast("int"), ((v + 5 * k) % 7).cast("int")  # noqa: E741
    box = F.when(v % 13 == k, F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(F.array(l, t, (l + v % 4).cast("int"), t + 2))
    assets = rows.select("vec_id", "position", (v % 11 != k).alias("enabled"), F.when(v % 7 == k, "x").when(v % 5 == k, "1").otherwise((k + 1).cast("string")).alias("source_index"), box.alias("bbox"), F.when(v % 17 == k, "Other").otherwise("Panel").alias("category"), F.when(v % 19 == k, "y").otherwise((k + 1).cast("string")).alias("category_index"))
    found = X.correction_issues(assets, pixels(spark, d).select("vec_id", "x", "y", "a"), "vec_id", F.lit(8), F.lit(8))
    return found.withColumn("recommended", F.array_join("recommended", ","))


_BOXED = "bx AS (SELECT vec_id, k AS position, CAST((vec_id + k) % 4 AS INTEGER) AS l, CAST(k AS INTEGER) AS t, CAST((vec_id + k) % 4 + 2 + k AS INTEGER) AS r, CAST(k + 3 AS INTEGER) AS b FROM embeddings, range(3) AS t(k))"


def _boxed(spark, d):
    v, k = F.col("vec_id"), F.col("position")
    rows = table(spark, d, "embeddings").select("vec_id", F.explode(F.array(*map(F.lit, range(3)))).alias("position"))
    left = ((v + k) % 4).cast("int")
    return rows.select("vec_id", "position", left.alias("l"), k.alias("t"), (left + 2 + k).alias("r"), (k + 3).alias("b"), F.when(v % 3 == 0, "fail").when(v % 3 == 1, "warning").otherwise("none").alias("severity"), (v % 5 != k).alias("enabled"))


@query(f"WITH {PIXELS}, {_BOXED} SELECT px.vec_id, CAST(position AS INTEGER) AS position, x - l AS x, y - t AS y, px.r, px.g, px.b, a FROM px JOIN bx ON bx.vec_id = px.vec_id AND x >= l AND x < bx.r AND y >= t AND y < bx.b")
def cropped_assets(spark, d):
    px = pixels(spark, d).select("vec_id", "x", "y", F.struct(*"rgba").alias("p"))
    return X.crops(px, _boxed(spark, d), "vec_id", "position").select("vec_id", "position", "x", "y", "p.r", "p.g", "p.b", "p.a")


@query(f"""WITH {PIXELS}, o AS (SELECT vec_id, x + 2 AS x, y, b AS r, r AS g, g AS b, a FROM px), m AS (SELECT coalesce(px.vec_id, o.vec_id) AS vec_id, coalesce(px.x, o.x) AS x, coalesce(px.y, o.y) AS y, coalesce(px.r, 0) AS ur, coalesce(px.g, 0) AS ug, coalesce(px.b, 0) AS ub, coalesce(px.a, 0) / 255.0::DOUBLE AS ua,
  coalesce(o.r, 0) AS r, coalesce(o.g, 0) AS g, coalesce(o.b, 0) AS b, coalesce(o.a, 0) / 255.0::DOUBLE AS a FROM px FULL JOIN o ON px.vec_id = o.vec_id AND px.x = o.x AND px.y = o.y), z AS (SELECT *, a + ua * (1 - a) AS al FROM m)
SELECT vec_id, x, y, CASE WHEN al > 0 THEN CAST(round_even((r * a + ur * ua * (1 - a)) / al, 0) AS INTEGER) ELSE 0 END AS r, CASE WHEN al > 0 THEN CAST(round_even((g * a + ug * ua * (1 - a)) / al, 0) AS INTEGER) ELSE 0 END AS g,
  CASE WHEN al > 0 THEN CAST(round_even((b * a + ub * ua * (1 - a)) / al, 0) AS INTEGER) ELSE 0 END AS b, CAST(round_even(al * 255, 0) AS INTEGER) AS a FROM z""")
def composited_images(spark, d):
    px = pixels(spark, d).select("vec_id", "x", "y", *"rgba")
    top = px.select("vec_id", (F.col("x") + 2).alias("x"), "y", F.col("b").alias("r"), F.col("r").alias("g"), F.col("g").alias("b"), "a")
    return X.composited(px, top, "vec_id")


@query(f"""WITH {_BOXED}, p AS (SELECT bx.*, l + i AS x, t + j AS y FROM bx, range(8) AS a(i), range(8) AS c(j) WHERE l + i < r AND t + j < b)
SELECT vec_id, CAST(position AS INTEGER) AS position, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, CASE WHEN vec_id % 5 = position THEN '#6B7280' WHEN vec_id % 3 = 0 THEN '#EF4444' WHEN vec_id % 3 = 1 THEN '#F59E0B' ELSE '#60A5FA' END AS colour FROM p WHERE x = l OR x = r - 1 OR y = t OR y = b - 1""")
def review_overlay(spark, d):
    return X.overlay(_boxed(spark, d), "vec_id", "position")
