"""Queries of the raster and style operators, over 8 x 8 images made of embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from packloom.functions import constants as C
from packloom.functions import rules as R
from packloom.functions import scalars as S
from packloom.operators import boxes as B
from packloom.operators import kernels as K
from packloom.operators import raster as P
from packloom.operators import stretch as B2
from packloom.operators import tables as T

from .registry import query
from .standins import PIXELS, pixels

_KEY = (0, 255, 0)
_DIST = "sqrt(pow(r - 120.0, 2) + pow(g - 120.0, 2) + pow(b - 120.0, 2))"


def _with_distance(spark, d):
    rgb = (F.col("r"), F.col("g"), F.col("b"))
    return pixels(spark, d).withColumn("d", S.colour_distance(rgb, (120, 120, 120)))


_RIM = f"""rim AS (SELECT vec_id, {_DIST} AS d FROM px WHERE y < 2 UNION ALL SELECT vec_id, {_DIST} FROM px WHERE y >= 6 UNION ALL SELECT vec_id, {_DIST} FROM px WHERE x < 2 UNION ALL SELECT vec_id, {_DIST} FROM px WHERE x >= 6)"""


@query(f"""WITH {PIXELS}, {_RIM}, p AS (SELECT vec_id, count(*) AS samples, quantile_cont(d, 0.5) AS p50, quantile_cont(d, 0.9) AS p90, quantile_cont(d, 0.95) AS p95, quantile_cont(d, 0.99) AS p99, quantile_cont(d, 0.995) AS p99_5, max(d) AS most FROM rim GROUP BY vec_id),
t AS (SELECT *, greatest(12.0, ceil(p99_5 + 4.0)) AS tr FROM p), o AS (SELECT *, least(255.0, greatest(96.0, ceil(greatest(tr + 48.0, tr * 2.0)))) AS o0 FROM t),
u AS (SELECT *, CASE WHEN o0 <= tr THEN tr + 1.0 ELSE o0 END AS op FROM o),
s AS (SELECT px.vec_id, count(*) FILTER (WHERE {_DIST} > tr AND {_DIST} < op) AS transition, count(*) FILTER (WHERE {_DIST} >= op) AS foreground, count(*) AS interior FROM px JOIN u USING (vec_id) GROUP BY px.vec_id)
SELECT u.vec_id, samples, p50, p90, p95, p99, p99_5, most, tr AS transparent, op AS opaque,
  CASE WHEN p99_5 <= 32 AND p99_5 - p50 <= 20 AND most <= 80 THEN 'high' WHEN p99_5 <= 96 AND p99_5 - p50 <= 56 AND most <= 160 THEN 'medium' ELSE 'low' END AS confidence, transition, foreground, interior,
  transition / CAST(interior AS DOUBLE) >= 0.01 AND transition >= 64 AND transition / CAST(greatest(1, foreground) AS DOUBLE) >= 1 AS near_key_risk,
  (p99_5 <= 96 AND p99_5 - p50 <= 56 AND most <= 160) AND tr < 160 AND NOT (transition / CAST(interior AS DOUBLE) >= 0.01 AND transition >= 64 AND transition / CAST(greatest(1, foreground) AS DOUBLE) >= 1) AS auto_apply
FROM u JOIN s USING (vec_id)""")
def chroma_threshold_recommendation(spark, d):
    return P.border_thresholds(_with_distance(spark, d), "vec_id", "d", 8, 8)


@query(f"WITH {PIXELS}, {_RIM} SELECT vec_id, quantile_cont(d, 0.5) AS p50, quantile_cont(d, 0.995) AS p99_5, count(*) AS samples FROM rim GROUP BY vec_id")
def border_percentiles(spark, d):
    p = F.percentile("d", F.array(F.lit(0.5), F.lit(0.995)))
    return P.border(_with_distance(spark, d), 8, 8).groupBy("vec_id").agg(p.alias("p"), F.count("*").alias("samples")).select("vec_id", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p99_5"), "samples")


@query(f"""WITH {PIXELS} SELECT vec_id, count(*) FILTER (WHERE g - greatest(r, b) > 20) AS spill, CAST(max(g - greatest(r, b)) AS DOUBLE) AS most, count(*) FILTER (WHERE sqrt(pow(r, 2) + pow(g - 255, 2) + pow(b, 2)) < 150) AS near_key,
  CAST(max(least(r, b) - g) AS DOUBLE) AS magenta, CAST(max(least(g, b) - r) AS DOUBLE) AS cyan FROM px GROUP BY vec_id""")
def spill_score_counts(spark, d):
    rgb = (F.col("r"), F.col("g"), F.col("b"))
    score = S.spill_score(rgb, _KEY)
    return pixels(spark, d).groupBy("vec_id").agg(F.count_if(score > 20).alias("spill"), F.max(score).alias("most"), F.count_if(S.colour_distance(rgb, _KEY) < 150).alias("near_key"), *(F.max(S.spill_score(rgb, key)).alias(name) for name, key in (("magenta", (255, 0, 255)), ("cyan", (0, 255, 255)))))


@query(f"""WITH {PIXELS} SELECT vec_id, x, y, CAST(round_even(greatest(0.0, least(1.0, ({_DIST} - 12.0) / 84.0)) * 255.0, 0) AS INTEGER) AS alpha FROM px""")
def soft_matte(spark, d):
    return _with_distance(spark, d).select("vec_id", "x", "y", P.soft_matte(F.col("d"), 12, 96).alias("alpha"))


@query(f"WITH {PIXELS} SELECT vec_id, x, y, CASE WHEN a = 0 THEN 0 ELSE r END AS r, CASE WHEN a = 0 THEN 0 ELSE g END AS g, CASE WHEN a = 0 THEN 0 ELSE b END AS b, a FROM px")
def hidden_rgb_cleanup(spark, d):
    return P.hidden_colour_cleared(pixels(spark, d)).select("vec_id", "x", "y", "r", "g", "b", "a")


@query(f"""WITH {PIXELS} SELECT vec_id, count(*) FILTER (WHERE a = 0) AS transparent, count(*) FILTER (WHERE a > 0 AND a < 255) AS partial, count(*) FILTER (WHERE a = 255) AS opaque, count(DISTINCT a) AS levels,
  min(x) FILTER (WHERE a >= 16) AS l, min(y) FILTER (WHERE a >= 16) AS t, max(x) FILTER (WHERE a >= 16) + 1 AS r, max(y) FILTER (WHERE a >= 16) + 1 AS b FROM px GROUP BY vec_id""")
def alpha_levels(spark, d):
    return P.alpha_statistics(pixels(spark, d), "vec_id")


@query(f"""WITH {PIXELS}, m AS (SELECT vec_id, count(*) FILTER (WHERE r > 130) AS ia, count(*) FILTER (WHERE a > 100) AS ib, count(*) FILTER (WHERE r > 130 AND a > 100) AS c, count(*) FILTER (WHERE r > 130 OR a > 100) AS e,
  min(x) FILTER (WHERE r > 130) AS zal, min(y) FILTER (WHERE r > 130) AS zat, max(x) FILTER (WHERE r > 130) + 1 AS zar, max(y) FILTER (WHERE r > 130) + 1 AS zab,
  min(x) FILTER (WHERE a > 100) AS zbl, min(y) FILTER (WHERE a > 100) AS zbt, max(x) FILTER (WHERE a > 100) + 1 AS zbr, max(y) FILTER (WHERE a > 100) + 1 AS zbb FROM px GROUP BY vec_id),
o AS (SELECT *, greatest(0, least(zar, zbr) - greatest(zal, zbl)) * greatest(0, least(zab, zbb) - greatest(zat, zbt)) AS i FROM m)
SELECT vec_id, ia AS in_a, ib AS in_b, coalesce(c / CAST(nullif(ia, 0) AS DOUBLE), 0.0) AS coverage, coalesce(c / CAST(nullif(ib, 0) AS DOUBLE), 0.0) AS support, coalesce(c / CAST(nullif(e, 0) AS DOUBLE), 0.0) AS mask_iou,
  coalesce(i / CAST(nullif((zar - zal) * (zab - zat) + (zbr - zbl) * (zbb - zbt) - i, 0) AS DOUBLE), 0.0) AS box_iou FROM o""")
def matte_coverage_iou(spark, d):
    return P.mask_agreement(pixels(spark, d), "vec_id", F.col("r") > 130, F.col("a") > 100)


@query(f"""WITH {PIXELS}, f AS (SELECT *, (0.2126 * CAST(a AS DOUBLE) + 0.7152 * CAST(a AS DOUBLE) + 0.0722 * CAST(a AS DOUBLE)) / 255.0 AS al FROM px)
SELECT vec_id, x, y, CAST(floor(al * 255.0) AS INTEGER) AS alpha, CASE WHEN al <= 0 THEN 0 ELSE CAST(floor(greatest(0.0, least(255.0, (r - (1 - al) * 10.0) / greatest(al, 1.0 / 255)))) AS INTEGER) END AS front FROM f""")
def matte_recovery(spark, d):
    a, r = F.col("a"), F.col("r")
    alpha, front = P.matte_recovered((r,), (a, a, a), (F.lit(10.0),))
    return pixels(spark, d).select("vec_id", "x", "y", alpha.alias("alpha"), front[0].alias("front"))


@query(f"""WITH {PIXELS}, s AS (SELECT vec_id, count(*) FILTER (WHERE a = 0) AS zero, count(*) FILTER (WHERE a > 0 AND a < 255) AS partial, count(DISTINCT a) AS levels FROM px GROUP BY vec_id)
SELECT vec_id, severity, code, ord FROM (SELECT vec_id, 'fail' AS severity, unnest([CASE WHEN zero = 0 THEN 'matte-has-no-transparent-pixels' END, CASE WHEN partial < 30 THEN 'insufficient-partial-alpha-pixels' END, CASE WHEN levels < 26 THEN 'insufficient-alpha-levels' END]) AS code, unnest([2, 3, 4]) AS ord FROM s) WHERE code IS NOT NULL""")
def matte_issues(spark, d):
    rules = {k: v for k, v in R.matte_rules({"partial": 30, "levels": 26}).items() if k.startswith(("matte-has", "insufficient"))}
    stats = P.alpha_statistics(pixels(spark, d), "vec_id").withColumnRenamed("transparent", "zero")
    return R.issues(stats, rules, "vec_id").withColumn("ord", F.col("ord") + 2)


_BIN = "least(3, r // 64) * 16 + least(3, g // 64) * 4 + least(3, b // 64)"


def _histogram(spark, d, image):
    bin_of = F.floor(F.col("r") / 64) * 16 + F.floor(F.col("g") / 64) * 4 + F.floor(F.col("b") / 64)
    return P.histogram(pixels(spark, d).where("a >= 16"), [image], bin_of, 64)


_HIST = f"""hist AS (SELECT label, bin, n, n / CAST(sum(n) OVER (PARTITION BY label) AS DOUBLE) AS share FROM (SELECT l.label, CAST(i AS INTEGER) AS bin, count(px.vec_id) AS n FROM (SELECT DISTINCT label FROM px WHERE a >= 16) l CROSS JOIN range(64) AS r(i) LEFT JOIN px ON px.label = l.label AND a >= 16 AND {_BIN} = i GROUP BY l.label, i))"""


@query(f"WITH {PIXELS}, {_HIST} SELECT * FROM hist")
def palette_histogram(spark, d):
    return _histogram(spark, d, "label")


def _profiles(spark, d):
    seen = pixels(spark, d).where("a >= 16")
    means = P.style_profile(seen, ["label"], "r", "g", "b")
    gray = pixels(spark, d).withColumn("gray", S.luma(F.col("r"), F.col("g"), F.col("b")))
    images = P.edge_density(gray, "vec_id", "gray", F.col("a") >= 16)
    edges = images.join(pixels(spark, d).select("vec_id", "label").distinct(), "vec_id").groupBy("label").agg(F.avg("edge_density").alias("edge_density"))
    bins = _histogram(spark, d, "label").groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("bin", "share"))), lambda x: x["share"]).alias("histogram"))
    return means.join(edges, "label").join(bins, "label")


_PROFILE = f"""{_HIST}, gray AS (SELECT *, CASE WHEN a >= 16 THEN 0.2126 * r + 0.7152 * g + 0.0722 * b END AS gr FROM px),
st AS (SELECT vec_id, label, abs(gr - lag(gr) OVER (PARTITION BY vec_id, y ORDER BY x)) AS gx, abs(gr - lag(gr) OVER (PARTITION BY vec_id, x ORDER BY y)) AS gy FROM gray),
im AS (SELECT vec_id, label, coalesce((coalesce(sum(gx), 0.0) + coalesce(sum(gy), 0.0)) / CAST(nullif(count(gx) + count(gy), 0) AS DOUBLE), 0.0) / 255.0 AS e FROM st GROUP BY vec_id, label),
ed AS (SELECT label, avg(e) AS edge_density FROM im GROUP BY label),
prof AS (SELECT label, avg(r) / 255.0 AS mean_r, avg(g) / 255.0 AS mean_g, avg(b) / 255.0 AS mean_b, avg(0.2126 * r + 0.7152 * g + 0.0722 * b) / 255.0 AS mean_luminance,
  avg(CASE WHEN greatest(r, g, b) > 0 THEN (greatest(r, g, b) - least(r, g, b)) / greatest(greatest(r, g, b), 1.0) ELSE 0.0 END) AS mean_saturation, count(*) AS visible_pixels FROM px WHERE a >= 16 GROUP BY label)"""


@query(f"""WITH {PIXELS}, {_PROFILE} SELECT label, round(mean_r, 9) AS mean_r, round(mean_g, 9) AS mean_g, round(mean_b, 9) AS mean_b, round(mean_luminance, 9) AS mean_luminance, round(mean_saturation, 9) AS mean_saturation, visible_pixels, round(edge_density, 9) AS edge_density FROM prof JOIN ed USING (label)""")
def style_profile(spark, d):
    scalars = ("mean_r", "mean_g", "mean_b", "mean_luminance", "mean_saturation", "edge_density")
    out = _profiles(spark, d)
    return out.select("label", *(F.round(c, 9).alias(c) for c in scalars), "visible_pixels")


_SIMILAR = f"""{_PROFILE}, one AS (SELECT * FROM prof JOIN ed USING (label)), pal AS (SELECT a.label AS first, b.label AS second, sum(least(a.share, b.share)) AS palette FROM hist a JOIN hist b ON a.bin = b.bin AND a.label < b.label GROUP BY a.label, b.label),
parts AS (SELECT a.label AS first, b.label AS second, palette, greatest(0.0, 1 - sqrt(pow(a.mean_r - b.mean_r, 2) + pow(a.mean_g - b.mean_g, 2) + pow(a.mean_b - b.mean_b, 2)) / sqrt(3.0)) AS colour, greatest(0.0, 1 - abs(a.mean_luminance - b.mean_luminance)) AS lum,
  greatest(0.0, 1 - abs(a.mean_saturation - b.mean_saturation)) AS sat, greatest(0.0, 1 - abs(a.edge_density - b.edge_density) / greatest(a.edge_density, b.edge_density, 0.05)) AS edge FROM one a JOIN one b ON a.label < b.label JOIN pal ON pal.first = a.label AND pal.second = b.label),
pairs AS (SELECT *, 100 * (0.35 * palette + 0.20 * colour + 0.20 * lum + 0.15 * sat + 0.10 * edge) AS score FROM parts)"""


def _pairs(spark, d):
    # One row for each job's style: few, and each pair of them is the result.
    profiles = _profiles(spark, d)
    one = lambda k: profiles.select(F.col("label").alias(f"label_{k}"), F.struct(*profiles.columns).alias(k))
    pairs = one("a").join(one("b"), F.col("label_a") < F.col("label_b"))
    return pairs.select(F.col("label_a").alias("first"), F.col("label_b").alias("second"), *(v.alias(k) for k, v in P.similarity("a", "b").items()))


@query(f"WITH {PIXELS}, {_SIMILAR} SELECT first, second, round(score, 6) AS score, round(100 * palette, 6) AS palette, round(100 * colour, 6) AS mean_color, round(100 * lum, 6) AS luminance, round(100 * sat, 6) AS saturation, round(100 * edge, 6) AS edge FROM pairs")
def style_pair_similarity(spark, d):
    pairs = _pairs(spark, d)
    return pairs.select("first", "second", *(F.round(c, 6).alias(c) for c in pairs.columns[2:]))


@query(f"""WITH {PIXELS}, {_SIMILAR}, sides AS (SELECT first AS label, score FROM pairs UNION ALL SELECT second, score FROM pairs), low AS (SELECT min(label) AS c FROM one),
x AS (SELECT label, round(avg(round(score, 2)), 2) AS cross_score FROM sides GROUP BY label), c AS (SELECT second AS label, round(score, 2) AS canonical FROM pairs, low WHERE first = c UNION ALL SELECT c, 100.0 FROM low),
s AS (SELECT label, canonical, cross_score, round(0.45 * canonical + 0.55 * cross_score, 2) AS score FROM c JOIN x USING (label))
SELECT *, CASE WHEN score < 40 THEN 'fail' WHEN score < 60 THEN 'warning' ELSE 'pass' END AS severity FROM s""")
def style_job_scores(spark, d):
    # The canonical profile is that of the least label.
    profiles = _profiles(spark, d)
    least = F.broadcast(profiles.orderBy("label").limit(1).select(F.struct(*profiles.columns).alias("b")))
    canonical = profiles.select("label", F.struct(*profiles.columns).alias("a")).join(least).select("label", P.similarity("a", "b")["score"].alias("canonical"))
    return P.job_style_scores(_pairs(spark, d), canonical, "label").withColumnRenamed("cross", "cross_score")


@query(f"""WITH {PIXELS}, ih AS (SELECT vec_id, label, CAST({_BIN} AS INTEGER) AS bin, count(*) AS n FROM px WHERE a >= 16 GROUP BY ALL), t AS (SELECT vec_id, sum(n) AS w FROM ih GROUP BY vec_id),
tl AS (SELECT label, sum(w) AS w FROM t JOIN (SELECT DISTINCT vec_id, label FROM ih) USING (vec_id) GROUP BY label)
SELECT ih.label, bin, round(sum(n / CAST(t.w AS DOUBLE) * t.w) / CAST(any_value(tl.w) AS DOUBLE), 9) AS share FROM ih JOIN t USING (vec_id) JOIN tl ON tl.label = ih.label GROUP BY ih.label, bin""")
def profile_weighted_merge(spark, d):
    seen = pixels(spark, d).where("a >= 16")
    bin_of = (F.floor(F.col("r") / 64) * 16 + F.floor(F.col("g") / 64) * 4 + F.floor(F.col("b") / 64)).cast("int")
    bins = seen.groupBy("label", "vec_id", bin_of.alias("bin")).count()
    weights = bins.groupBy("label", "vec_id").agg(F.greatest(F.lit(1), F.sum("count")).alias("w"))
    shares = bins.join(weights, ["label", "vec_id"]).groupBy("label", "bin").agg(F.sum(F.col("count") / F.col("w") * F.col("w")).alias("s"))
    return shares.join(weights.groupBy("label").agg(F.sum("w").alias("total")), "label").select("label", "bin", F.round(F.col("s") / F.col("total"), 9).alias("share"))


@query(f"""WITH {PIXELS}, q AS (SELECT vec_id, (r // 8 * 8) * 65536 + (g // 64 * 64) * 256 + b // 64 * 64 AS value, count(*) AS count FROM px GROUP BY ALL)
SELECT vec_id, value, count, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY count DESC, value DESC) AS INTEGER) AS place FROM q) WHERE place <= 2""")
def dominant_values(spark, d):
    quantised = lambda c, n: (F.floor(F.col(c) / n) * n).cast("int")
    packed = quantised("r", 8) * 65536 + quantised("g", 64) * 256 + quantised("b", 64)
    return P.dominant(pixels(spark, d), "vec_id", packed).select("vec_id", "value", "count", "place")


@query(f"""WITH {PIXELS}, s AS (SELECT vec_id, abs(v - lag(v) OVER (PARTITION BY vec_id, y ORDER BY x)) AS gx, abs(v - lag(v) OVER (PARTITION BY vec_id, x ORDER BY y)) AS gy FROM px)
SELECT vec_id, round((sum(gx) + sum(gy)) / (count(gx) + count(gy)), 9) AS edge_density FROM s GROUP BY vec_id""")
def edge_density(spark, d):
    return P.edge_density(pixels(spark, d), "vec_id", "v", F.lit(True), 1.0).select("vec_id", F.round("edge_density", 9).alias("edge_density"))


@query(f"""WITH {PIXELS}, s AS (SELECT vec_id, y, abs(v - lag(v) OVER (PARTITION BY vec_id, y ORDER BY x)) AS gx FROM px)
SELECT vec_id, y, round(median(gx), 9) AS median, round(mad(gx), 9) AS mad FROM s WHERE gx IS NOT NULL GROUP BY vec_id, y""")
def axis_gradients_mad(spark, d):
    steps = P.gradients(pixels(spark, d), "vec_id").where("gx is not null")
    return P.median_deviation(steps, ["vec_id", "y"], "gx").select("vec_id", "y", F.round("median", 9).alias("median"), F.round("mad", 9).alias("mad"))


@query(f"""WITH {PIXELS}, p AS (SELECT vec_id, x, min(y) FILTER (WHERE v > 0.05) AS top, max(y) FILTER (WHERE v > 0.05) AS bottom FROM px GROUP BY vec_id, x) SELECT *, top IS NULL AS gap FROM p""")
def outer_profile_gaps(spark, d):
    return P.outer_profile(pixels(spark, d), "vec_id", F.col("v") > 0.05, 8)


@query(f"""WITH {PIXELS}, l AS (SELECT vec_id, x, y, v > 0 AS s FROM px), g AS (SELECT vec_id, s, lag(s, 1) OVER h AS x1, lag(s, 1) OVER w AS y1, lag(s, 2) OVER h AS x2, lag(s, 2) OVER w AS y2 FROM l WINDOW h AS (PARTITION BY vec_id, y ORDER BY x), w AS (PARTITION BY vec_id, x ORDER BY y))
SELECT vec_id, avg(CAST(x1 <> s AS INTEGER)) AS x1, avg(CAST(y1 <> s AS INTEGER)) AS y1, avg(CAST(x2 = s AS INTEGER)) AS x2, avg(CAST(y2 = s AS INTEGER)) AS y2,
  (avg(CAST(x1 <> s AS INTEGER)) + avg(CAST(y1 <> s AS INTEGER)) + avg(CAST(x2 = s AS INTEGER)) + avg(CAST(y2 = s AS INTEGER))) / 4 AS score FROM g GROUP BY vec_id""")
def checker_lag_score(spark, d):
    return P.lag_agreement(pixels(spark, d).withColumn("s", F.col("v") > 0), "vec_id", "s", 1)


@query(f"""WITH {PIXELS}, i AS (SELECT vec_id, y, x, x - row_number() OVER (PARTITION BY vec_id, y ORDER BY x) AS k FROM px WHERE v > 0.05) SELECT vec_id, y, min(x) AS start, max(x) AS "end", count(*) AS length FROM i GROUP BY vec_id, y, k""")
def run_lengths(spark, d):
    lit = pixels(spark, d).where("v > 0.05").withColumn("on", F.lit(True))
    return T.runs(lit, ["vec_id", "y"], "x", "on").drop("on")


@query(f"""WITH {PIXELS}, i AS (SELECT vec_id, y, s, x, x - row_number() OVER (PARTITION BY vec_id, y, s ORDER BY x) AS k FROM (SELECT *, v > 0 AS s FROM px)), r AS (SELECT vec_id, y, s, min(x) AS start, max(x) AS "end", count(*) AS length FROM i GROUP BY vec_id, y, s, k),
n AS (SELECT *, row_number() OVER (PARTITION BY vec_id, y ORDER BY start) AS a, count(*) OVER (PARTITION BY vec_id, y) AS b FROM r) SELECT vec_id, y, s, start, "end", length FROM n WHERE b <= 2 OR (a > 1 AND a < b)""")
def inner_run_lengths(spark, d):
    found = T.runs(pixels(spark, d).withColumn("s", F.col("v") > 0), ["vec_id", "y"], "x", "s")
    return T.inner_runs(found, ["vec_id", "y"])


@query(f"""WITH {PIXELS}, m AS (SELECT vec_id, x, y FROM px WHERE v > 0.08),
reach AS (WITH RECURSIVE walk AS (SELECT vec_id, x, y, y * 8 + x AS label FROM m UNION SELECT m.vec_id, m.x, m.y, w.label FROM walk w JOIN m ON m.vec_id = w.vec_id AND abs(m.x - w.x) <= 1 AND abs(m.y - w.y) <= 1) SELECT * FROM walk),
c AS (SELECT vec_id, x, y, min(label) AS label FROM reach GROUP BY vec_id, x, y)
SELECT vec_id, CAST(label // 8 AS BIGINT) * 2147483648 + label % 8 AS comp_id, count(*) AS pixels, min(x) AS l, min(y) AS t, max(x) + 1 AS r, max(y) + 1 AS b FROM c GROUP BY vec_id, label HAVING count(*) >= 2""")
def connected_components(spark, d):
    return P.components(pixels(spark, d), "vec_id", F.col("v") > 0.08, least=2)


@query(f"""WITH {PIXELS} SELECT a.vec_id, a.x, a.y, round(avg(b.v), 9) AS mean FROM px a JOIN px b ON a.vec_id = b.vec_id AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 GROUP BY a.vec_id, a.x, a.y""")
def box_mean(spark, d):
    return P.box_mean(pixels(spark, d), "vec_id", "v", 1).select("vec_id", "x", "y", F.round("mean", 9).alias("mean"))


@query(f"""WITH {PIXELS}, n AS (SELECT a.vec_id, a.x, a.y, any_value(a.a) AS a, max(CAST(b.a >= 200 AS INTEGER)) AS near FROM px a JOIN px b ON a.vec_id = b.vec_id AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 GROUP BY a.vec_id, a.x, a.y)
SELECT vec_id, x, y, CASE WHEN a > 0 AND a < 200 AND near = 0 THEN 0 ELSE a END AS a, a > 0 AND a < 200 AND near = 0 AS suppressed FROM n""")
def local_max_suppression(spark, d):
    return P.aura_suppressed(pixels(spark, d), "vec_id", "a", core=200, radius=1).select("vec_id", "x", "y", "a", "suppressed")


def _quarters(spark):
    spec = spark.createDataFrame([(1, 8, 8, 2, 2, 0, 0, 0)], "layout_id int, width int, height int, columns int, rows int, margin int, gutter int, safe int")
    return B.layout_slots(spec)


@query(f"""WITH {PIXELS}, n AS (SELECT vec_id, CAST(y // 4 * 2 + x // 4 + 1 AS INTEGER) AS idx, count(*) AS n FROM px WHERE v > 0.1 GROUP BY ALL), o AS (SELECT vec_id, list_sort(list(idx)) AS occupied FROM n WHERE n >= 4 GROUP BY vec_id)
SELECT vec_id, coalesce(occupied, []) AS occupied, coalesce(occupied, []) = [1, 2, 3, 4] AS matches FROM (SELECT DISTINCT vec_id FROM px) LEFT JOIN o USING (vec_id)""")
def slot_occupancy(spark, d):
    return P.slot_occupancy(pixels(spark, d), _quarters(spark), "vec_id", F.col("v") > 0.1, 4, share=0.25, floor=2)


@query(f"WITH {PIXELS} SELECT vec_id, count(*) FILTER (WHERE (x // 2 + y // 2) % 2 = CAST(v > 0 AS INTEGER)) AS agree FROM px GROUP BY vec_id")
def checker_agreement(spark, d):
    same = P.checker(F.col("x"), F.col("y"), 2) == (F.col("v") > 0).cast("int")
    return pixels(spark, d).groupBy("vec_id").agg(F.count_if(same).alias("agree"))


@query(f"""WITH {PIXELS}, s AS (SELECT vec_id, count(*) FILTER (WHERE a >= 16 AND g >= 90 AND g - r >= 35 AND g - b >= 35) AS green, count(*) FILTER (WHERE a >= 16) AS seen FROM px GROUP BY vec_id)
SELECT vec_id, green, green > 12 AND green > floor(seen * 0.002) AS reflects FROM s""")
def green_reflection(spark, d):
    return P.green_reflection(pixels(spark, d), "vec_id", F.col("a") >= 16)


_BANDS = """bx AS (SELECT vec_id, min(x) AS l, max(x) AS r0, min(y) AS t, max(y) AS b0 FROM px WHERE a >= 16 GROUP BY vec_id),
sz AS (SELECT *, r0 - l + 1 AS w, b0 - t + 1 AS h FROM bx), ct AS (SELECT *, CAST(round_even(w * 0.2, 0) AS INTEGER) AS cx, CAST(round_even(h * 0.2, 0) AS INTEGER) AS cy FROM sz),
pl AS (SELECT px.vec_id, x, y, a >= 16 AS seen, r / 255.0::DOUBLE * a / 255.0::DOUBLE AS pr, g / 255.0::DOUBLE * a / 255.0::DOUBLE AS pg, b / 255.0::DOUBLE * a / 255.0::DOUBLE AS pb, a / 255.0::DOUBLE AS pa, l, r0, t, b0, w, h, cx, cy FROM px JOIN ct USING (vec_id)),
ed AS (SELECT vec_id, seen, pr, pg, pb, pa, 'top' AS edge, x AS pos, y - t AS depth, h AS across FROM pl WHERE x BETWEEN l + cx AND r0 - cx UNION ALL SELECT vec_id, seen, pr, pg, pb, pa, 'bottom', x, b0 - y, h FROM pl WHERE x BETWEEN l + cx AND r0 - cx
  UNION ALL SELECT vec_id, seen, pr, pg, pb, pa, 'left', y, x - l, w FROM pl WHERE y BETWEEN t + cy AND b0 - cy UNION ALL SELECT vec_id, seen, pr, pg, pb, pa, 'right', y, r0 - x, w FROM pl WHERE y BETWEEN t + cy AND b0 - cy),
ol AS (SELECT vec_id, edge, pos, min(depth) FILTER (WHERE seen) AS d FROM ed GROUP BY ALL), om AS (SELECT *, median(d) OVER (PARTITION BY vec_id, edge) AS line FROM ol),
os AS (SELECT vec_id, edge, count(*) FILTER (WHERE d IS NULL) AS gaps, max(abs(d - line)) AS deviation FROM om GROUP BY ALL),
st AS (SELECT vec_id, edge, pos, greatest(abs(pr - lag(pr) OVER q), abs(pg - lag(pg) OVER q), abs(pb - lag(pb) OVER q), abs(pa - lag(pa) OVER q)) AS s FROM ed WHERE depth BETWEEN 0 AND least(6, across) - 1 WINDOW q AS (PARTITION BY vec_id, edge, depth ORDER BY pos)),
tg AS (SELECT vec_id, edge, pos, max(s) AS g FROM st WHERE s IS NOT NULL GROUP BY ALL), tb AS (SELECT vec_id, edge, median(g) AS baseline, mad(g) AS mad FROM tg GROUP BY ALL),
tt AS (SELECT vec_id, edge, baseline, count(*) FILTER (WHERE g > greatest(0.16, baseline + 6 * mad + 0.04)) AS high, max(g) AS steepest, count(*) AS n FROM tg JOIN tb USING (vec_id, edge) GROUP BY ALL),
bands AS (SELECT vec_id, edge, gaps, CAST(deviation AS DOUBLE) AS deviation, gaps = 0 AND deviation <= 4 AS silhouette_ok, baseline, steepest, high,
  coalesce(high <= greatest(1, CAST(round_even(n * CASE WHEN steepest <= 0.4 THEN 1.0::DOUBLE / 3 ELSE 0.25 END, 0) AS INTEGER)) AND baseline <= 0.16, false) AS texture_ok FROM os LEFT JOIN tt USING (vec_id, edge))"""


@query(f"WITH {PIXELS}, {_BANDS} SELECT *, coalesce(silhouette_ok AND texture_ok, false) AS ok FROM bands")
def stretch_bands(spark, d):
    return B2.stretch_bands(pixels(spark, d), "vec_id")


@query(f"WITH {PIXELS}, {_BANDS}, k AS (SELECT vec_id, edge, coalesce(silhouette_ok AND texture_ok, false) AS ok FROM bands) SELECT vec_id, 'fail' AS severity, 'panel-stretch-band-decoration' AS code, array_to_string(list_sort(list(edge)), ',') AS edges FROM k WHERE NOT ok GROUP BY vec_id")
def stretch_band_issues(spark, d):
    found = B2.stretch_issues(B2.stretch_bands(pixels(spark, d), "vec_id"), "vec_id", "Panel")
    return found.withColumn("edges", F.array_join("edges", ","))


@query()
def keyed_out_images(spark, d):
    # Kernels on packed images have no SQL form; tests hold them to invariants.
    return K.keyed_out(P.packed(pixels(spark, d), "vec_id", 8, 8), "vec_id", (120, 120, 120))


@query()
def resized_images(spark, d):
    images = P.packed(pixels(spark, d), "vec_id", 8, 8)
    return K.resized(images.withColumn("new_width", F.lit(5)).withColumn("new_height", F.lit(12)), "vec_id")
