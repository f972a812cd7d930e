"""Queries of what pixels imply and of screen rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from packloom.functions import constants as C
from packloom.functions import rules as R
from packloom.functions import scalars as S
from packloom.operators import inference as I
from packloom.operators import pipelines, tables
from packloom.operators import raster as P
from packloom.operators import screens as X

from . import raster_queries
from .registry import ORACLES, query, table
from .standins import BOXES, ISSUES, PIXELS, boxes, issues, pixels


@query(f"""SELECT vec_id, CAST(ord AS INTEGER) AS ord, severity, code FROM (SELECT vec_id, unnest([CASE WHEN confidence = 'medium' THEN 'variable-chroma-border' END, CASE WHEN NOT auto_apply THEN 'unsafe-adaptive-thresholds' END, CASE WHEN near_key_risk THEN 'near-key-subject-risk' END]) AS code, unnest(['warning', 'fail', 'fail']) AS severity, unnest([0, 1, 2]) AS ord
  FROM ({ORACLES['chroma_threshold_recommendation']})) WHERE code IS NOT NULL""")
def chroma_threshold_issues(spark, d):
    return I.threshold_issues(raster_queries.chroma_threshold_recommendation(spark, d), "vec_id")


#: Frames: the outer ring of each 8 x 8 image around a middle that is nearly flat.
_FRAMED = f"""{PIXELS}, fr AS (SELECT vec_id, x, y, CASE WHEN ring THEN r ELSE 100 + r % 3 END AS r, CASE WHEN ring THEN g ELSE 90 END AS g, CASE WHEN ring THEN b ELSE 80 END AS b, CASE WHEN ring THEN a ELSE 255 END AS a FROM (SELECT *, x < 1 + vec_id % 2 OR x > 6 - vec_id % 3 OR y < 1 OR y > 6 AS ring FROM px))"""


def _framed(spark, d):
    v = F.col("vec_id")
    ring = (F.col("x") < 1 + v % 2) | (F.col("x") > 6 - v % 3) | (F.col("y") < 1) | (F.col("y") > 6)
    flat = {"r": 100 + F.col("r") % 3, "g": F.lit(90), "b": F.lit(80), "a": F.lit(255)}
    return pixels(spark, d).select("vec_id", "x", "y", *(F.when(ring, F.col(c)).otherwise(x).cast("int").alias(c) for c, x in flat.items()))


def _axis(at: str, line: str) -> str:
    """SQL of one axis of 8 lines, as rows, without arrays."""
    return f"""(WITH s AS (SELECT vec_id, {at} AS p, {line} AS q, r / 255.0::DOUBLE * a / 255.0::DOUBLE AS pr, g / 255.0::DOUBLE * a / 255.0::DOUBLE AS pg, b / 255.0::DOUBLE * a / 255.0::DOUBLE AS pb, a / 255.0::DOUBLE AS pa FROM fr),
m AS (SELECT vec_id, q, median(pr) AS mr, median(pg) AS mg, median(pb) AS mb, median(pa) AS ma FROM s WHERE p BETWEEN 3 AND 5 GROUP BY ALL),
d AS (SELECT vec_id, p, avg((abs(pr - mr) + abs(pg - mg) + abs(pb - mb) + abs(pa - ma)) / 4) AS d FROM s JOIN m USING (vec_id, q) GROUP BY ALL),
t AS (SELECT vec_id, greatest(0.025, quantile_cont(d, 0.65) FILTER (WHERE p BETWEEN 2 AND 5) * 1.8 + 0.01) AS thr FROM d GROUP BY vec_id),
f AS (SELECT d.*, thr, d > thr AND p < 4 AS lo, d > thr AND p > 4 AS hi FROM d JOIN t USING (vec_id)),
n AS (SELECT *, count(*) FILTER (WHERE lo) OVER (PARTITION BY vec_id ORDER BY p DESC) AS nl, count(*) FILTER (WHERE hi) OVER (PARTITION BY vec_id ORDER BY p) AS nh FROM f),
e AS (SELECT vec_id, any_value(thr) AS thr, coalesce(max(p) FILTER (WHERE lo AND nl = 2) + 1, 0) AS st, coalesce(min(p) FILTER (WHERE hi AND nh = 2) - 1, 7) AS en FROM n GROUP BY vec_id),
u AS (SELECT e.*, avg(d) FILTER (WHERE p BETWEEN st AND en) AS inside, avg(d) FILTER (WHERE p < st OR p > en) AS outside FROM e JOIN d USING (vec_id) GROUP BY ALL),
v AS (SELECT *, st AS ld, 7 - en AS tr, st BETWEEN 1 AND 3 AND 7 - en BETWEEN 1 AND 3 AND en - st + 1 >= 4 AS valid FROM u)
SELECT vec_id, ld, tr, round(thr, 6) AS threshold, valid, round((0.30 * (1 - least(1.0, abs(ld - tr) / greatest(1.0, greatest(ld, tr)))) + 0.25 * (1 - least(1.0, inside / greatest(thr, 1e-6))) + 0.25 * CASE WHEN outside IS NULL THEN 0.0 ELSE least(1.0, outside / greatest(thr * 1.5, 1e-6)) END
  + 0.20 * least(1.0, (en - st + 1) / 3.6)) * CASE WHEN valid THEN 1.0 ELSE 0.35 END, 4) AS confidence FROM v)"""


@query(f"""WITH {_FRAMED} SELECT vec_id, CAST(ld AS INTEGER) AS "leading", CAST(tr AS INTEGER) AS "trailing", threshold, confidence, valid AS valid_geometry FROM {_axis('x', 'y')}""")
def stretch_axis_candidates(spark, d):
    return I.axis_candidates(_framed(spark, d), "vec_id", "x", 1).drop("length")


@query(f"""WITH {_FRAMED}, h AS {_axis('x', 'y')}, w AS {_axis('y', 'x')}, k AS (SELECT h.vec_id, least(h.confidence, w.confidence) AS confidence, h.valid AND w.valid AND least(h.confidence, w.confidence) >= 0.65 AS apply, h.ld AS hl, h.tr AS ht, w.ld AS wl, w.tr AS wt FROM h JOIN w USING (vec_id))
SELECT vec_id, apply, confidence, CAST(CASE WHEN apply THEN hl ELSE 0 END AS INTEGER) AS "left", CAST(CASE WHEN apply THEN wt ELSE 0 END AS INTEGER) AS bottom, CAST(CASE WHEN apply THEN ht ELSE 0 END AS INTEGER) AS "right", CAST(CASE WHEN apply THEN wl ELSE 0 END AS INTEGER) AS top,
  CASE WHEN NOT apply THEN 'nine-slice-low-confidence-manual-override-required' END AS issue FROM k""")
def nine_slice_inference(spark, d):
    return I.nine_slices(_framed(spark, d), "vec_id", 1)


#: Checkers of tiles of two pixels (of three where vec_id % 3 = 0), with the image's own colours where its values are large.
_CHECKED = f"""{PIXELS}, ck AS (SELECT vec_id, x, y, CASE WHEN v > 0.12 THEN r WHEN k THEN 200 ELSE 120 END AS r, CASE WHEN v > 0.12 THEN g WHEN k THEN 200 ELSE 120 END AS g, CASE WHEN v > 0.12 THEN b WHEN k THEN 200 ELSE 120 END AS b FROM (SELECT *, (x // (2 + CAST(vec_id % 3 = 0 AS INTEGER)) + y // (2 + CAST(vec_id % 3 = 0 AS INTEGER))) % 2 = 1 AS k FROM px))"""


def _checked(spark, d):
    px = pixels(spark, d)
    tile = F.when(F.col("vec_id") % 3 == 0, 3).otherwise(2)
    colour = F.when(P.checker(F.col("x"), F.col("y"), tile) == 1, 200).otherwise(120)
    return px.select("vec_id", "x", "y", *(F.when(F.col("v") > 0.12, F.col(c)).otherwise(colour).alias(c) for c in "rgb"))


def _far(name: str) -> str:
    return f"sqrt(pow(r - ({name} >> 16 & 255), 2) + pow(g - ({name} >> 8 & 255), 2) + pow(b - ({name} & 255), 2))"


@query(f"""WITH {_CHECKED}, q AS (SELECT vec_id, (r // 8 * 8) * 65536 + (g // 8 * 8) * 256 + b // 8 * 8 AS value, count(*) AS n FROM ck GROUP BY ALL), o AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, value DESC) AS k FROM q),
tp AS (SELECT vec_id, CAST(max(value) FILTER (WHERE k = 1) AS BIGINT) AS f, CAST(max(value) FILTER (WHERE k = 2) AS BIGINT) AS s FROM o GROUP BY vec_id HAVING max(value) FILTER (WHERE k = 2) IS NOT NULL),
t2 AS (SELECT * FROM tp WHERE sqrt(pow((f >> 16 & 255) - (s >> 16 & 255), 2) + pow((f >> 8 & 255) - (s >> 8 & 255), 2) + pow((f & 255) - (s & 255), 2)) >= 12),
p2 AS (SELECT ck.*, f, s, least({_far('f')}, {_far('s')}) <= 18 AS back, {_far('s')} < {_far('f')} AS label FROM ck JOIN t2 USING (vec_id)),
cv AS (SELECT vec_id, f, s, avg(CAST(back AS INTEGER)) AS coverage FROM p2 GROUP BY ALL HAVING avg(CAST(back AS INTEGER)) >= 0.45), bk AS (SELECT p2.* FROM p2 JOIN cv USING (vec_id) WHERE back),
ln AS (SELECT vec_id, 'x' AS axis, y AS line, x AS p, label FROM bk UNION ALL SELECT vec_id, 'y', x, y, label FROM bk), il AS (SELECT *, p - row_number() OVER (PARTITION BY vec_id, axis, line, label ORDER BY p) AS i FROM ln),
rn AS (SELECT vec_id, axis, line, min(p) AS st, count(*) AS len FROM il GROUP BY vec_id, axis, line, label, i), rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id, axis, line ORDER BY st) AS k, count(*) OVER (PARTITION BY vec_id, axis, line) AS n FROM rn),
tl AS (SELECT vec_id, CAST(round_even(median(len), 0) AS INTEGER) AS tile FROM rk WHERE (n <= 2 OR k > 1 AND k < n) AND len BETWEEN 2 AND 4 GROUP BY vec_id), bt AS (SELECT bk.*, tile FROM bk JOIN tl USING (vec_id)),
sh AS (SELECT z.vec_id, m, ax, avg(CAST(CASE WHEN m = 1 THEN z.label <> w.label ELSE z.label = w.label END AS INTEGER)) AS share FROM bt z, bt w, (VALUES (1, 'x'), (1, 'y'), (2, 'x'), (2, 'y')) AS c(m, ax)
  WHERE z.vec_id = w.vec_id AND z.x = w.x + CASE ax WHEN 'x' THEN m * w.tile ELSE 0 END AND z.y = w.y + CASE ax WHEN 'y' THEN m * w.tile ELSE 0 END GROUP BY ALL),
sc AS (SELECT vec_id, avg(share) AS score FROM sh GROUP BY vec_id HAVING avg(share) >= 0.82)
SELECT vec_id, format('#{{:02X}}{{:02X}}{{:02X}}', f >> 16 & 255, f >> 8 & 255, f & 255) AS first, format('#{{:02X}}{{:02X}}{{:02X}}', s >> 16 & 255, s >> 8 & 255, s & 255) AS second, tile, round(coverage, 6) AS coverage, round(score, 6) AS score FROM cv JOIN tl USING (vec_id) JOIN sc USING (vec_id)""")
def checkerboard_detection(spark, d):
    return I.checkerboards(_checked(spark, d), "vec_id")


#: Elements of a screen are an order's lineitems; views, viewports and contents follow from their numbers.
_ELEMENTS = """el AS (SELECT l_orderkey AS screen, l_linenumber AS id, any_value(['Image', 'ScrollView', 'ScrollViewport', 'Button'][l_linenumber % 4 + 1]) AS kind, min(CASE WHEN l_partkey % 5 > 0 AND l_linenumber > 1 THEN l_linenumber - 1 END) AS parent_id, min(l_partkey) AS part, min(l_suppkey) AS supp FROM lineitem GROUP BY ALL)"""


def _elements(spark, d):
    n = F.col("l_linenumber")
    # The kind follows from the number: taken after the grouping, which then keeps whole numbers alone.
    kind = F.element_at(F.array(*map(F.lit, ("Image", "ScrollView", "ScrollViewport", "Button"))), (F.col("id") % 4 + 1).cast("int"))
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("screen"), n.alias("id")).agg(F.min(F.when((F.col("l_partkey") % 5 > 0) & (n > 1), n - 1)).alias("parent_id"), F.min("l_partkey").alias("part"), F.min("l_suppkey").alias("supp"))
    return rows.select("screen", "id", kind.alias("kind"), "parent_id", "part", "supp")


@query(f"""WITH {_ELEMENTS}, sv AS (SELECT *, id + 1 + CASE WHEN supp % 6 = 0 THEN 1 ELSE 0 END AS vp, id + 2 AS ct, part % 3 = 0 AS h, part % 4 = 0 AS w FROM el WHERE kind = 'ScrollView'),
i AS (SELECT sv.screen, sv.id, unnest([CASE WHEN NOT coalesce(v.kind = 'ScrollViewport' AND v.parent_id = sv.id, false) THEN 'scroll-viewport-invalid' END, CASE WHEN NOT coalesce(c.parent_id = vp, false) THEN 'scroll-content-invalid' END, CASE WHEN NOT (h OR w) THEN 'scroll-axis-missing' END]) AS code, unnest([0, 1, 2]) AS ord
  FROM sv LEFT JOIN el v ON v.screen = sv.screen AND v.id = vp LEFT JOIN el c ON c.screen = sv.screen AND c.id = ct) SELECT screen, id, ord, 'fail' AS severity, code FROM i WHERE code IS NOT NULL""")
def scroll_chain_issues(spark, d):
    e = _elements(spark, d)
    rows = e.select("*", (F.col("id") + 1 + F.when(F.col("supp") % 6 == 0, 1).otherwise(0)).alias("viewport_id"), (F.col("id") + 2).alias("content_id"), (F.col("part") % 3 == 0).alias("horizontal"), (F.col("part") % 4 == 0).alias("vertical"))
    return X.scroll_issues(rows, "screen")


@query(f"""WITH {_ELEMENTS}, b AS (SELECT screen, id % 2 AS "group", id AS button, CASE WHEN supp % 9 = 0 THEN 99 WHEN supp % 7 = 0 THEN 1 ELSE id END AS target, CASE WHEN supp % 5 = 0 THEN 98 ELSE id END AS dflt FROM el WHERE part % 3 > 0),
g AS (SELECT b.screen, "group", count(*) FILTER (WHERE NOT coalesce(x.kind = 'Button', false)) AS n0, count(*) FILTER (WHERE t.kind IS NULL) AS n1, count(target) - count(DISTINCT target) AS n2, CAST(count(*) < 2 AS BIGINT) AS n3, CAST(NOT bool_or(target = dflt) AS BIGINT) AS n4
  FROM b LEFT JOIN el x ON x.screen = b.screen AND x.id = button LEFT JOIN el t ON t.screen = b.screen AND t.id = target GROUP BY ALL)
SELECT * FROM (SELECT screen, "group", unnest(['toggle-button-invalid', 'toggle-target-missing', 'toggle-target-repeated', 'toggle-too-few-bindings', 'toggle-default-invalid']) AS code, unnest([n0, n1, n2, n3, n4]) AS n FROM g) WHERE n > 0""")
def toggle_group_issues(spark, d):
    e, supp = _elements(spark, d), F.col("supp")
    target = F.when(supp % 9 == 0, 99).when(supp % 7 == 0, 1).otherwise(F.col("id"))
    bindings = e.where("part % 3 > 0").select("screen", (F.col("id") % 2).alias("group"), F.col("id").alias("button_id"), target.alias("target_id"), F.when(supp % 5 == 0, 98).otherwise(F.col("id")).alias("default_target_id"))
    return X.toggle_issues(bindings, e, "screen")


@query(f"""WITH {_ELEMENTS}, sc AS (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS ord, o_custkey FROM orders), x AS (SELECT el.screen, id, ord, CASE WHEN supp % 4 = 0 THEN 'PrefabInstance' ELSE 'Image' END AS kind, CASE WHEN supp % 4 = 0 OR supp % 17 = 0 THEN el.screen - part % 40 + 20 END AS prefab FROM el JOIN sc ON o_orderkey = el.screen),
i AS (SELECT x.screen, id, CASE WHEN kind = 'PrefabInstance' THEN CASE WHEN NOT coalesce(s.ord < x.ord, false) THEN 'prefab-screen-not-earlier' END WHEN prefab IS NOT NULL THEN 'prefab-screen-unexpected' END AS code FROM x LEFT JOIN sc s ON s.o_orderkey = prefab)
SELECT screen, id, CAST(CASE code WHEN 'prefab-screen-not-earlier' THEN 0 ELSE 1 END AS INTEGER) AS ord, 'fail' AS severity, code FROM i WHERE code IS NOT NULL""")
def prefab_screen_issues(spark, d):
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    screens = table(spark, d, "orders").select(F.col("o_orderkey").alias("screen"), place.alias("screen_ord"))
    supp, prefab = F.col("supp"), F.col("supp") % 4 == 0
    e = _elements(spark, d).select("screen", "id", F.when(prefab, "PrefabInstance").otherwise("Image").alias("kind"), F.when(prefab | (supp % 17 == 0), F.col("screen") - F.col("part") % 40 + 20).alias("prefab_screen"))
    return X.prefab_issues(e.join(screens, "screen"), screens, "screen")


@query(r"""WITH r AS (SELECT doc_id, source, CASE doc_id % 5 WHEN 0 THEN 'x' || CAST(doc_id AS VARCHAR) || '.png' WHEN 1 THEN 'canonical-' || CAST(doc_id AS VARCHAR) || '.png' ELSE 'supporting-' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') || '-' || CAST(doc_id AS VARCHAR) || '.png' END AS file, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'canonical' ELSE 'supporting' END AS role,
    CASE WHEN doc_id % 23 > 0 THEN n_chars END AS w, CASE WHEN doc_id % 23 > 0 THEN CAST(n_chars / 2 AS BIGINT) END AS h, CASE WHEN doc_id % 19 = 0 THEN 2 ELSE 1 END AS frames, sha256(coalesce(text, '')) AS sha FROM documents),
x AS (SELECT r.*, f.first_file, c.n AS canonicals, role IS NOT NULL AND w IS NOT NULL AS ok FROM r LEFT JOIN (SELECT source, sha, min(file) AS first_file FROM r WHERE role IS NOT NULL AND w IS NOT NULL GROUP BY ALL) f ON f.source IS NOT DISTINCT FROM r.source AND f.sha = r.sha AND f.source IS NOT NULL LEFT JOIN (SELECT source, count(*) AS n FROM r WHERE role = 'canonical' GROUP BY source) c ON c.source = r.source),
i AS (SELECT source, file, unnest([CASE WHEN role IS NULL THEN 'invalid-reference-name' END, CASE WHEN role IS NOT NULL AND w IS NULL THEN 'unreadable-reference-image' END, CASE WHEN ok AND frames <> 1 THEN 'animated-reference-image' END, CASE WHEN ok AND (w < 256 OR h < 256) THEN 'reference-too-small' END, CASE WHEN ok AND first_file <> file THEN 'duplicate-reference-content' END, CASE WHEN role = 'canonical' AND canonicals > 1 THEN 'multiple-canonical-references' END]) AS code, unnest([0, 1, 2, 3, 4, 5]) AS ord FROM x)
SELECT source, file, ord, 'fail' AS severity, code FROM i WHERE code IS NOT NULL""")
def reference_image_issues(spark, d):
    k, text = F.col("doc_id"), F.col("doc_id").cast("string")
    file = F.when(k % 5 == 0, F.concat(F.lit("x"), text, F.lit(".png"))).when(k % 5 == 1, F.concat(F.lit("canonical-"), text, F.lit(".png"))).otherwise(F.concat(F.lit("supporting-"), F.lpad((k % 100).cast("string"), 2, "0"), F.lit("-"), text, F.lit(".png")))
    good = k % 23 > 0
    rows = table(spark, d, "documents").select("source", file.alias("file"), F.when(good, F.col("n_chars")).alias("width"), F.when(good, F.rint(F.col("n_chars") / 2).cast("long")).alias("height"), F.when(k % 19 == 0, 2).otherwise(1).alias("frames"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    return X.reference_issues(rows.withColumn("role", R.reference_role(F.col("file"))), "source")


_CONNECTED = ORACLES["connected_components"].replace("HAVING count(*) >= 2", "")
_SHEETS = f"""cc AS ({_CONNECTED}), st AS (SELECT idx, cx, cy FROM (VALUES (1, 2, 2), (2, 6, 2), (3, 2, 6), (4, 6, 6)) AS v(idx, cx, cy)),
pd AS (SELECT cc.*, (SELECT arg_min(idx, (pow(cx - (l + r) / 2.0, 2) + pow(cy - (t + b) / 2.0, 2), idx)) FROM st) AS slot FROM cc),
sl AS (SELECT vec_id, CAST(slot AS INTEGER) AS slot, count(*) AS components, CAST(sum(pixels) AS BIGINT) AS pixels, list_sort(list(pixels), 'DESC') AS top, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b FROM pd GROUP BY ALL)"""


def _extracted(spark, d):
    return pipelines.extracted(pixels(spark, d), raster_queries._quarters(spark), "vec_id", F.col("v") > 0.08, 8, 8)


@query(f"WITH {_SHEETS} SELECT vec_id, slot, components, pixels, greatest(l - 1, 0) AS l, greatest(t - 1, 0) AS t, least(r + 1, 8) AS r, least(b + 1, 8) AS b FROM sl")
def extracted_assets(spark, d):
    return _extracted(spark, d)[0]


@query(f"""WITH {_SHEETS} SELECT vec_id, CAST(NULL AS INTEGER) AS slot, 'cross-slot-connected-component' AS code FROM cc WHERE (SELECT count(*) FROM st WHERE cx >= l AND cx < r AND cy >= t AND cy < b) > 1
UNION ALL SELECT e.vec_id, st.idx, 'empty-slot' FROM embeddings e, st WHERE (e.vec_id, st.idx) NOT IN (SELECT vec_id, slot FROM sl) UNION ALL SELECT vec_id, slot, 'multiple-major-components' FROM sl WHERE len(top) > 1 AND top[2] >= top[1] * 0.35""")
def extraction_issues(spark, d):
    return _extracted(spark, d)[1]


@query(f"""WITH {PIXELS}, rim AS (SELECT * FROM px WHERE y < 2 UNION ALL SELECT * FROM px WHERE y >= 6 UNION ALL SELECT * FROM px WHERE x < 2 UNION ALL SELECT * FROM px WHERE x >= 6), k AS (SELECT vec_id, median(r) AS kr, median(g) AS kg, median(b) AS kb FROM rim GROUP BY vec_id),
m AS (SELECT px.*, kr, kg, kb, (0.2126 * CAST(a AS DOUBLE) + 0.7152 * CAST(a AS DOUBLE) + 0.0722 * CAST(a AS DOUBLE)) / 255.0 AS al FROM px JOIN k USING (vec_id)), f AS (SELECT *, greatest(al, 1.0 / 255) AS s FROM m)
SELECT vec_id, x, y, CASE WHEN al <= 0 THEN 0 ELSE CAST(floor(greatest(0.0, least(255.0, (r - (1 - al) * kr) / s))) AS INTEGER) END AS r, CASE WHEN al <= 0 THEN 0 ELSE CAST(floor(greatest(0.0, least(255.0, (g - (1 - al) * kg) / s))) AS INTEGER) END AS g,
  CASE WHEN al <= 0 THEN 0 ELSE CAST(floor(greatest(0.0, least(255.0, (b - (1 - al) * kb) / s))) AS INTEGER) END AS b, CAST(floor(al * 255.0) AS INTEGER) AS a FROM f""")
def recovered_images(spark, d):
    px = pixels(spark, d)
    matte = px.select("vec_id", "x", "y", *(F.col("a").alias(c) for c in "rgb"))
    return P.recovered(px.select("vec_id", "x", "y", *"rgb"), matte, "vec_id", 8, 8)


@query("""WITH k AS (SELECT doc_id, lower(text) AS s, [NULL, 'auto', '#00ff00', '#FF00FF', '#123456'][doc_id % 5 + 1] AS requested FROM documents), f AS (SELECT *, regexp_matches(s, 'green|emerald|jade|lime|绿色|翠绿|翡翠|青绿') AS g, regexp_matches(s, 'magenta|fuchsia|purple|violet|品红|紫色|紫红|洋红') AS m, regexp_matches(s, 'cyan|aqua|turquoise|青色|蓝绿|湖蓝') AS c FROM k),
x AS (SELECT doc_id, upper(coalesce(requested, 'auto')) AS w, CASE WHEN NOT g THEN '#00FF00' WHEN NOT m THEN '#FF00FF' WHEN NOT c THEN '#00FFFF' END AS free, CASE upper(coalesce(requested, 'auto')) WHEN '#00FF00' THEN g WHEN '#FF00FF' THEN m ELSE false END AS clash FROM f)
SELECT doc_id, CASE WHEN w = 'AUTO' THEN free WHEN NOT clash THEN w END AS key, CASE WHEN w = 'AUTO' THEN 'auto-declared-palette' ELSE 'explicit' END AS mode, CASE WHEN w = 'AUTO' AND free IS NULL THEN 'no-chroma-key-without-conflict' WHEN w <> 'AUTO' AND clash THEN 'chroma-key-conflicts-with-subject' END AS issue FROM x WHERE w IS NOT NULL""")
def chroma_key_requests(spark, d):
    requested = F.get(F.array(F.lit(None), *map(F.lit, ("auto", "#00ff00", "#FF00FF", "#123456"))), (F.col("doc_id") % 5).cast("int"))
    rows = table(spark, d, "documents").select("doc_id", S.chroma_key_choice(requested, S.subject_colours(F.col("text"))).alias("x"))
    return rows.select("doc_id", "x.*")


@query("""WITH p AS (SELECT p_partkey, [NULL, 'adaptive-parallel', 'sequential', 'sequential-inputs'][p_partkey % 4 + 1] AS mode, CASE WHEN p_partkey % 3 > 0 THEN p_size % 9 - 2 END AS most, CASE WHEN p_partkey % 5 > 0 THEN p_size % 4 END AS risk FROM part),
l AS (SELECT *, coalesce(mode, 'adaptive-parallel') AS m, CASE WHEN mode = 'sequential-inputs' THEN 1 ELSE greatest(1, least(3, coalesce(most, CASE WHEN coalesce(mode, 'adaptive-parallel') = 'adaptive-parallel' THEN 3 ELSE 1 END))) END AS lim FROM p)
SELECT p_partkey, m AS mode, CAST(lim AS INTEGER) AS most, CAST(least(coalesce(risk, 2), lim) AS INTEGER) AS high_risk FROM l""")
def generation_policies(spark, d):
    k, size = F.col("p_partkey"), F.col("p_size")
    mode = F.get(F.array(F.lit(None), *map(F.lit, ("adaptive-parallel", "sequential", "sequential-inputs"))), (k % 4).cast("int"))
    policy = S.generation_policy(mode, F.when(k % 3 > 0, size % 9 - 2), F.when(k % 5 > 0, size % 4))
    return table(spark, d, "part").select("p_partkey", policy.alias("x")).select("p_partkey", "x.mode", F.col("x.most").cast("int").alias("most"), F.col("x.high_risk").cast("int").alias("high_risk"))


_PROOF = """pv AS (SELECT doc_id, CASE WHEN doc_id % 11 > 0 THEN 'p.json' END AS f, doc_id % 3 AS v, CASE WHEN doc_id % 5 > 0 THEN 'native-alpha' END AS mode, CASE WHEN doc_id % 7 > 0 THEN 'model-native' ELSE 'cutout' END AS origin, doc_id % 13 = 0 AS removed, source AS dp, CASE WHEN doc_id % 17 = 0 THEN lang ELSE source END AS sp,
  CASE WHEN doc_id % 19 > 0 THEN sha256(coalesce(text, '')) ELSE 'none' END AS dh, sha256(coalesce(text, '')) AS sh, CASE WHEN doc_id % 23 > 0 THEN lang ELSE ' ' END AS model FROM documents)"""


@query(f"""WITH {_PROOF}, i AS (SELECT doc_id, unnest([CASE WHEN f IS NULL THEN 'missing-native-alpha-provenance' END, CASE WHEN v <> 1 THEN 'unsupported-native-alpha-provenance-schema' END, CASE WHEN coalesce(mode, '') <> 'native-alpha' THEN 'invalid-transparency-mode' END, CASE WHEN origin <> 'model-native' THEN 'unproven-native-alpha-origin' END,
  CASE WHEN removed THEN 'background-removal-not-native-alpha' END, CASE WHEN dp IS DISTINCT FROM sp THEN 'provenance-source-path-mismatch' END, CASE WHEN dh <> sh THEN 'provenance-source-hash-mismatch' END, CASE WHEN trim(model) = '' THEN 'missing-generation-model' END, CASE WHEN NOT regexp_full_match(dh, '[0-9a-f]{{64}}') THEN 'invalid-hash' END]) AS code,
  unnest([0, 1, 2, 3, 4, 5, 6, 7, 9]) AS ord FROM pv) SELECT doc_id, CAST(ord AS INTEGER) AS ord, 'fail' AS severity, code FROM i WHERE code IS NOT NULL""")
def provenance_issues(spark, d):
    k, sha = F.col("doc_id"), F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = table(spark, d, "documents").select("doc_id", F.when(k % 11 > 0, "p.json").alias("provenance_file"), (k % 3).alias("schema_version"), F.when(k % 5 > 0, "native-alpha").alias("transparency_mode"), F.when(k % 7 > 0, "model-native").otherwise("cutout").alias("alpha_origin"), (k % 13 == 0).alias("background_removal"), F.col("source").alias("declared_path"), F.when(k % 17 == 0, F.col("lang")).otherwise(F.col("source")).alias("source_path"), F.when(k % 19 > 0, sha).otherwise("none").alias("declared_sha256"), sha.alias("source_sha256"), F.when(k % 23 > 0, F.col("lang")).otherwise(" ").alias("model"), F.lit("image-edit").alias("method"))
    return R.issues(rows, R.provenance_rules() | {"invalid-hash": ("fail", ~S.is_sha256(F.col("declared_sha256")))}, "doc_id")


@query(f"""WITH {BOXES} SELECT image_id, comp_id, greatest(l - 3, 0) AS l, greatest(t - 3, 0) AS t, least(r + 3, 60) AS r, least(b + 3, 60) AS b, l <= 1 OR t <= 1 OR r >= 59 OR b >= 59 AS touches, abs((r - l) - (b - t)) <= greatest(greatest(r - l, b - t) * 0.01, 0.01) AS square FROM boxes""")
def padded_boxes(spark, d):
    box = S.box(*(F.col(c) for c in "ltrb"))
    square = S.is_close((F.col("r") - F.col("l")).cast("double"), (F.col("b") - F.col("t")).cast("double"))
    rows = boxes(spark, d).select("image_id", "comp_id", S.padded(box, 3, F.lit(60), F.lit(60)).alias("x"), S.touches_boundary(box, F.lit(60), F.lit(60)).alias("touches"), square.alias("square"))
    return rows.select("image_id", "comp_id", "x.*", "touches", "square")


@query("""WITH r AS (SELECT *, [CASE WHEN p_size < 1 OR p_size % 7 = 0 THEN 'invalid-padding' END, CASE WHEN p_partkey % 5 = 0 THEN 'unsupported-category' END, CASE WHEN p_retailprice > 1500 THEN 'target-too-large' END] AS c FROM part)
SELECT p_partkey, array_to_string([x FOR x IN c IF x IS NOT NULL], ',') AS codes, [x FOR x IN c IF x IS NOT NULL][1] AS first_code FROM r""")
def request_validation(spark, d):
    size = F.col("p_size")
    category = F.when(F.col("p_partkey") % 5 == 0, "Other").otherwise("Panel")
    rules = {"invalid-padding": (size < 1) | (size % 7 == 0), "unsupported-category": ~category.isin(*(c[0] for c in C.CATEGORIES)), "target-too-large": F.col("p_retailprice") > 1500}
    return table(spark, d, "part").select("p_partkey", F.array_join(R.broken(rules), ",").alias("codes"), R.first_broken(rules).alias("first_code"))


@query("""WITH k AS (SELECT doc_id, sha256(coalesce(text, '')) AS fingerprint FROM documents), c AS (SELECT sha256(coalesce(text, '')) AS fingerprint, min(doc_id) AS gate_id FROM documents WHERE lang = 'en' GROUP BY 1) SELECT k.doc_id, gate_id FROM k LEFT JOIN c USING (fingerprint)""")
def memoised_gates(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("fingerprint"))
    cache = rows.where("lang = 'en'").groupBy("fingerprint").agg(F.min("doc_id").alias("gate_id"))
    known, new = tables.memoised(rows.select("doc_id", "fingerprint"), cache, "fingerprint")
    return known.select("doc_id", "gate_id").unionByName(new.select("doc_id", F.lit(None).cast("long").alias("gate_id")))


@query(f"""WITH {ISSUES}, u AS (SELECT 0 AS stage_ord, ord, code, asset_id FROM issues UNION ALL SELECT 1, doc_id, 'unlabelled', NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) SELECT *, row_number() OVER (ORDER BY stage_ord, ord) AS place FROM u""")
def issue_streams(spark, d):
    from pyspark.sql import Window

    docs = table(spark, d, "documents").select(F.col("doc_id").alias("ord"), F.lit("unlabelled").alias("code"))
    missing = docs.join(table(spark, d, "labels").select(F.col("doc_id").alias("ord")), "ord", "left_anti")
    rows = X.ordered_union(issues(spark, d).select("ord", "code", "asset_id"), missing, order=["ord"])
    # The place within a stage, after what earlier stages have: no window spans the stages.
    sizes = rows.groupBy("stage_ord").agg(F.count("*").alias("n"))
    before = sizes.alias("a").join(sizes.alias("b"), F.col("b.stage_ord") < F.col("a.stage_ord"), "left").groupBy(F.col("a.stage_ord").alias("stage_ord")).agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("stage_ord").orderBy("ord"))
    return rows.withColumn("k", within).join(F.broadcast(before), "stage_ord").select("stage_ord", "ord", "code", "asset_id", (F.col("before") + F.col("k")).alias("place"))
