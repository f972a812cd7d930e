"""Queries of diagnosed sheets: 32 x 16 pixels that show two 8 x 8 images on transparent, flat, checkered or mixed ground."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.operators import diagnosis as X
from packloom.operators import raster as P

from .registry import query, table
from .standins import PIXELS, pixels

#: A sheet shows images 2 s and 2 s + 1, 4 from its top, at 4 and 20 from its left; least pixels and room of a candidate.
WIDE, HIGH, LEAST, ROOM = 32, 16, 2, 1


def _sheets(spark: SparkSession, d: str) -> DataFrame:
    """By s % 4: real alpha, a flat green with noise, a checkerboard, a colour gradient; some of an unknown category, some without bytes."""
    e = table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 2).alias("s")).distinct()
    s, x, y = F.col("s"), F.col("x"), F.col("y")
    grid = e.select("s", F.explode(F.sequence(F.lit(0), F.lit(WIDE - 1))).alias("x")).select("s", "x", F.explode(F.sequence(F.lit(0), F.lit(HIGH - 1))).alias("y"))
    shown = pixels(spark, d).select(F.floor(F.col("vec_id") / 2).alias("s"), (x + 4 + 16 * (F.col("vec_id") % 2)).cast("int").alias("x"), (y + 4).alias("y"), *(F.col(c).alias(f"i{c}") for c in "rgba"))
    kind, turn = s % 4, F.floor(s / 4)
    step, level = x * 7 + y * 13 + s, F.pmod(turn, F.lit(5))
    noise = F.when((F.pmod(step, F.lit(29)) == 0) & (level > 2), level * 40 - 70).otherwise(F.pmod(step, level * 3 + 1))
    tile = 2 + F.pmod(turn, F.lit(2))
    grey = F.when(F.pmod(F.floor(x / tile) + F.floor(y / tile), F.lit(2)) == 1, 200).otherwise(120)
    ground = {"r": (F.lit(0), F.lit(0), grey, x * 8), "g": (F.lit(0), 255 - noise, grey, y * 16), "b": (F.lit(0), F.lit(0), grey, F.lit(128))}
    on = F.coalesce(F.col("ia") >= F.when(kind == 0, 0).when(kind == 2, 128).otherwise(16), F.lit(False))
    colours = [F.when(on, F.col(f"i{c}")).otherwise(F.when(kind == 0, v[0]).when(kind == 1, v[1]).when(kind == 2, v[2]).otherwise(v[3])).cast("int").alias(c) for c, v in ground.items()]
    full = grid.join(shown, ["s", "x", "y"], "left").select(s.cast("string").alias("project"), "x", "y", *colours, F.when(kind == 0, F.coalesce("ia", F.lit(0))).otherwise(255).alias("a"))
    rows, n = P.packed(full, "project", WIDE, HIGH), F.col("project").cast("long")
    return rows.select("project", F.when(n % 37 == 5, "Hat").otherwise("Icon_Item").alias("category"), "width", "height", F.when(n % 41 != 6, F.col("rgba")).alias("rgba"))


def _diagnosed(spark: SparkSession, d: str) -> X.Diagnosis:
    return X.diagnosed(_sheets(spark, d), LEAST, ROOM)


def _far(colour: str) -> str:
    return f"sqrt(pow(r - ({colour} >> 16 & 255), 2) + pow(g - ({colour} >> 8 & 255), 2) + pow(b - ({colour} & 255), 2))"


def _hex(colour: str) -> str:
    return f"format('#{{:02X}}{{:02X}}{{:02X}}', {colour} >> 16 & 255, {colour} >> 8 & 255, {colour} & 255)"


_STRIPS = "SELECT *, {n} AS n FROM {t} WHERE y < {n} UNION ALL SELECT *, {n} FROM {t} WHERE y >= 16 - {n} UNION ALL SELECT *, {n} FROM {t} WHERE x < {n} UNION ALL SELECT *, {n} FROM {t} WHERE x >= 32 - {n}"

#: im: the pixels; bd: checkerboards; ky: key colours; st: kinds and thresholds; cp: components; cd: candidates; iss: issues.
_PARTS = f"""{PIXELS}, sh AS (SELECT DISTINCT vec_id // 2 AS s FROM embeddings), sp AS (SELECT vec_id // 2 AS s, x + 4 + 16 * (vec_id % 2) AS x, y + 4 AS y, r, g, b, a FROM px),
gr AS (SELECT s, u.i AS x, w.i AS y, 255 - CASE WHEN (u.i * 7 + w.i * 13 + s) % 29 = 0 AND s // 4 % 5 > 2 THEN s // 4 % 5 * 40 - 70 ELSE (u.i * 7 + w.i * 13 + s) % (s // 4 % 5 * 3 + 1) END AS noisy, CASE WHEN (u.i // (2 + s // 4 % 2) + w.i // (2 + s // 4 % 2)) % 2 = 1 THEN 200 ELSE 120 END AS grey FROM sh, range({WIDE}) AS u(i), range({HIGH}) AS w(i) WHERE s % 37 <> 5 AND s % 41 <> 6),
im AS (SELECT gr.s, gr.x, gr.y, CASE WHEN o THEN r ELSE [0, 0, grey, gr.x * 8][gr.s % 4 + 1] END AS r, CASE WHEN o THEN g ELSE [0, noisy, grey, gr.y * 16][gr.s % 4 + 1] END AS g, CASE WHEN o THEN b ELSE [0, 0, grey, 128][gr.s % 4 + 1] END AS b, CASE WHEN gr.s % 4 = 0 THEN coalesce(a, 0) ELSE 255 END AS a
  FROM gr LEFT JOIN (SELECT *, a >= [0, 16, 128, 16][s % 4 + 1] AS o FROM sp) AS z ON z.s = gr.s AND z.x = gr.x AND z.y = gr.y),
opq AS (SELECT * FROM im WHERE s IN (SELECT s FROM im GROUP BY s HAVING min(a) = 255)),
q AS (SELECT s, (r // 8 * 8) * 65536 + (g // 8 * 8) * 256 + b // 8 * 8 AS value, count(*) AS n FROM opq GROUP BY ALL), o AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY n DESC, value DESC) AS k FROM q),
tp AS (SELECT s, CAST(max(value) FILTER (WHERE k = 1) AS BIGINT) AS c1, CAST(max(value) FILTER (WHERE k = 2) AS BIGINT) AS c2 FROM o GROUP BY s HAVING max(value) FILTER (WHERE k = 2) IS NOT NULL),
t2 AS (SELECT * FROM tp WHERE sqrt(pow((c1 >> 16 & 255) - (c2 >> 16 & 255), 2) + pow((c1 >> 8 & 255) - (c2 >> 8 & 255), 2) + pow((c1 & 255) - (c2 & 255), 2)) >= 12),
p2 AS (SELECT s, x, y, c1, c2, least({_far('c1')}, {_far('c2')}) <= 18 AS back, {_far('c2')} < {_far('c1')} AS label FROM opq JOIN t2 USING (s)),
cv AS (SELECT s, c1, c2, avg(CAST(back AS INTEGER)) AS coverage FROM p2 GROUP BY ALL HAVING avg(CAST(back AS INTEGER)) >= 0.45), bk AS (SELECT p2.* FROM p2 JOIN cv USING (s) WHERE back),
ln AS (SELECT s, 'x' AS axis, y AS line, x AS p, label FROM bk UNION ALL SELECT s, 'y', x, y, label FROM bk WHERE x < 8 OR x >= 24), il AS (SELECT *, p - row_number() OVER (PARTITION BY s, axis, line, label ORDER BY p) AS i FROM ln),
rn AS (SELECT s, axis, line, min(p) AS st, count(*) AS len FROM il GROUP BY s, axis, line, label, i), rk AS (SELECT *, row_number() OVER (PARTITION BY s, axis, line ORDER BY st) AS k, count(*) OVER (PARTITION BY s, axis, line) AS n FROM rn),
tl AS (SELECT s, CAST(round_even(median(len), 0) AS INTEGER) AS tile FROM rk WHERE (n <= 2 OR k > 1 AND k < n) AND len BETWEEN 2 AND 8 GROUP BY s), bt AS (SELECT bk.*, tile FROM bk JOIN tl USING (s)),
sr AS (SELECT z.s, m, ax, avg(CAST(CASE WHEN m = 1 THEN z.label <> w.label ELSE z.label = w.label END AS INTEGER)) AS share FROM bt z JOIN (VALUES (1, 'x'), (1, 'y'), (2, 'x'), (2, 'y')) AS c(m, ax) ON true
  JOIN bt w ON z.s = w.s AND z.x = w.x + CASE ax WHEN 'x' THEN m * z.tile ELSE 0 END AND z.y = w.y + CASE ax WHEN 'y' THEN m * z.tile ELSE 0 END GROUP BY ALL),
bd AS (SELECT s, c1, c2, tile, coverage, score FROM cv JOIN tl USING (s) JOIN (SELECT s, avg(share) AS score FROM sr GROUP BY s HAVING avg(share) >= 0.82) AS sc USING (s)),
op2 AS (SELECT * FROM opq WHERE s NOT IN (SELECT s FROM bd)), ky AS (SELECT s, CAST(round_even(median(r), 0) AS BIGINT) * 65536 + CAST(round_even(median(g), 0) AS BIGINT) * 256 + CAST(round_even(median(b), 0) AS BIGINT) AS key FROM ({_STRIPS.format(n=4, t='op2')}) GROUP BY s),
di AS (SELECT op2.s, x, y, key, {_far('key')} AS d FROM op2 JOIN ky USING (s)), sc4 AS ({_STRIPS.format(n=4, t='di')}), sc1 AS ({_STRIPS.format(n=1, t='di')}),
b4 AS (SELECT s, quantile_cont(d, 0.5) AS p50, quantile_cont(d, 0.995) AS p99, max(d) AS most FROM sc4 GROUP BY s), b1 AS (SELECT s, avg(CAST(d <= 24 AS INTEGER)) AS border FROM sc1 GROUP BY s), ca AS (SELECT s, key, avg(CAST(d <= 24 AS INTEGER)) AS coverage FROM di GROUP BY ALL),
fb AS (SELECT *, border >= 0.85 AND coverage >= 0.20 AS flat, greatest(12.0, ceil(p99 + 4.0)) AS tr FROM ca JOIN b1 USING (s) JOIN b4 USING (s)),
ft AS (SELECT *, least(255.0, greatest(96.0, ceil(greatest(tr + 48.0, tr * 2.0)))) AS op, CASE WHEN p99 <= 32 AND p99 - p50 <= 20 AND most <= 80 THEN 'high' WHEN p99 <= 96 AND p99 - p50 <= 56 AND most <= 160 THEN 'medium' ELSE 'low' END AS trust FROM fb WHERE flat),
sf AS (SELECT s, count(*) FILTER (WHERE d > tr AND d < op) AS soft, count(*) FILTER (WHERE d >= op) AS front, count(*) AS n FROM di JOIN ft USING (s) GROUP BY s),
fr AS (SELECT ft.*, soft / n >= 0.01 AND soft >= 64 AND soft / greatest(1, front) >= 1 AS risk FROM ft JOIN sf USING (s)),
st AS (SELECT sh.s, sh.s % 37 = 5 AS hat, sh.s % 41 = 6 AND sh.s % 37 <> 5 AS gone, CASE WHEN sh.s % 37 = 5 OR sh.s % 41 = 6 THEN NULL WHEN bd.s IS NOT NULL THEN 'checkerboard-presentation' WHEN fr.s IS NOT NULL THEN 'flat-background-sheet' WHEN fb.s IS NOT NULL THEN 'opaque-mixed-image' ELSE 'alpha-sheet' END AS kind,
  fb.key, fr.tr, fr.op, fr.trust, fr.risk, fr.trust <> 'low' AND fr.tr < 160 AND NOT fr.risk AS auto, coalesce(bd.coverage, fb.coverage) AS coverage, fb.border, bd.tile, bd.score, bd.c1, bd.c2 FROM sh LEFT JOIN bd USING (s) LEFT JOIN fb USING (s) LEFT JOIN fr USING (s)),
fg AS (SELECT s, x, y FROM im WHERE s NOT IN (SELECT s FROM opq) AND a >= 8 UNION ALL SELECT s, x, y FROM p2 WHERE s IN (SELECT s FROM bd) AND NOT back UNION ALL SELECT s, x, y FROM di WHERE d > 24),
ru AS (SELECT s, y, min(x) AS x0, max(x) AS x1 FROM (SELECT *, x - row_number() OVER (PARTITION BY s, y ORDER BY x) AS i FROM fg) GROUP BY s, y, i),
wk AS (WITH RECURSIVE walk AS (SELECT s, y, x0, x1, y * {WIDE} + x0 AS label FROM ru UNION SELECT ru.s, ru.y, ru.x0, ru.x1, w.label FROM walk w JOIN ru ON ru.s = w.s AND abs(ru.y - w.y) = 1 AND ru.x0 <= w.x1 + 1 AND ru.x1 >= w.x0 - 1) SELECT * FROM walk),
cp AS (SELECT s, label, sum(x1 - x0 + 1) AS pixels, min(x0) AS l, min(y) AS t, max(x1) + 1 AS r, max(y) + 1 AS b FROM (SELECT s, y, x0, x1, min(label) AS label FROM wk GROUP BY ALL) GROUP BY s, label HAVING sum(x1 - x0 + 1) >= {LEAST}),
md AS (SELECT s, greatest(1.0, median(b - t)) AS high FROM cp GROUP BY s),
cd AS (SELECT s, row_number() OVER (PARTITION BY s ORDER BY round_even((t + b) / 2.0 / high, 0), l, t, pixels DESC, label) AS idx, greatest(0, l - {ROOM}) AS l, greatest(0, t - {ROOM}) AS t, least({WIDE}, r + {ROOM}) AS r, least({HIGH}, b + {ROOM}) AS b FROM cp JOIN md USING (s)),
ce AS (SELECT *, l = 0 OR t = 0 OR r = {WIDE} OR b = {HIGH} AS touches FROM cd), nc AS (SELECT s, count(*) AS n FROM ce GROUP BY s),
iss AS (SELECT s, 0 AS ord, 'fail' AS severity, 'unsupported-category' AS code, 'category' AS location FROM st WHERE hat UNION ALL SELECT s, 1, 'fail', 'source-decode-failed', 'source_image' FROM st WHERE gone UNION ALL SELECT s, 2, 'fail', 'fake-checkerboard-background', 'background.mode' FROM st WHERE kind = 'checkerboard-presentation'
  UNION ALL SELECT s, 3, 'warning', 'variable-chroma-border', 'background.threshold_diagnostics' FROM st WHERE trust = 'medium' UNION ALL SELECT s, 4, 'fail', 'unsafe-adaptive-thresholds', 'background.threshold_diagnostics' FROM st WHERE NOT auto UNION ALL SELECT s, 5, 'fail', 'near-key-subject-risk', 'background.threshold_diagnostics' FROM st WHERE risk
  UNION ALL SELECT s, 6, 'fail', 'unresolved-opaque-background', 'background.mode' FROM st WHERE kind = 'opaque-mixed-image' UNION ALL SELECT s, 7, 'fail', 'no-candidates', 'assets' FROM st WHERE kind IS NOT NULL AND s NOT IN (SELECT s FROM nc) UNION ALL SELECT s, 7 + idx, 'warning', 'candidate-touches-canvas', 'assets[' || (idx - 1) || '].bbox' FROM ce WHERE touches),
ct AS (SELECT s, count(*) FILTER (WHERE severity = 'warning') AS warnings, count(*) FILTER (WHERE severity = 'fail') AS fails FROM iss GROUP BY s)"""


@query(f"""WITH {_PARTS} SELECT CAST(s AS VARCHAR) AS project, CASE WHEN coalesce(fails, 0) = 0 THEN 'ready-for-review' ELSE 'manual-review-required' END AS status, kind AS classification, CASE WHEN tile IS NULL THEN {_hex('key')} END AS color, CASE WHEN tile IS NOT NULL THEN {_hex('c1')} || ' ' || {_hex('c2')} END AS colors, CAST(tr AS DOUBLE) AS transparent, CAST(op AS DOUBLE) AS opaque, trust AS confidence, auto AS auto_apply,
  round_even(coverage, 6) AS coverage, round_even(border, 6) AS border_coverage, tile AS tile_size, round_even(score, 6) AS pattern_score, coalesce(n, 0) AS candidate_count, coalesce(warnings, 0) AS warning_count, coalesce(fails, 0) AS fail_count FROM st LEFT JOIN nc USING (s) LEFT JOIN ct USING (s)""")
def diagnosed_sheets(spark, d):
    """One report a sheet: kind of ground, its colours and thresholds, counts."""
    b = "background."
    return _diagnosed(spark, d).reports.select("project", "status", "classification", b + "color", F.array_join(b + "colors", " ").alias("colors"), F.col(b + "transparent_threshold").alias("transparent"), F.col(b + "opaque_threshold").alias("opaque"), b + "confidence", b + "auto_apply", b + "coverage", b + "border_coverage", b + "tile_size", b + "pattern_score", "candidate_count", "warning_count", "fail_count")


@query(f"""WITH {_PARTS} SELECT CAST(s AS VARCHAR) AS project, CAST(idx AS INTEGER) AS source_index, concat_ws(',', l, t, r, b) AS bbox, format('Asset{{:03d}}', idx) AS semantic_name, CASE WHEN touches THEN 'warning' ELSE 'info' END AS severity FROM ce""")
def diagnosed_candidates(spark, d):
    """Candidates of all sheets in reading order."""
    return _diagnosed(spark, d).candidates.select("project", "source_index", F.array_join("bbox", ",").alias("bbox"), "semantic_name", "severity")


@query(f"""WITH {_PARTS} SELECT CAST(s AS VARCHAR) AS project, CAST(ord AS BIGINT) AS ord, severity, code, location FROM iss""")
def diagnosed_issues(spark, d):
    """All issues of the sheets, in order."""
    return _diagnosed(spark, d).issues.select("project", "ord", "severity", "code", "location")
