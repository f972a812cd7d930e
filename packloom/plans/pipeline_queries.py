"""Queries of the composite operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from packloom.operators import pipelines as X
from packloom.operators import raster as P
from packloom.sources.files import report_lines

from .raster_queries import _quarters
from .registry import query, table
from .standins import ISSUES, PIXELS, boxes, issues, pixels
from .table_queries import _PLACED, _SLOTS, _placed, _slots

_RING = "(CAST(y = 0 AS INTEGER) + CAST(y = 7 AS INTEGER) + CAST(x = 0 AS INTEGER) + CAST(x = 7 AS INTEGER))"


@query(f"WITH {PIXELS} SELECT vec_id, CAST(sum(CASE WHEN a >= 128 THEN {_RING} ELSE 0 END) AS BIGINT) AS edge_pixels FROM px GROUP BY vec_id")
def edge_contacts(spark, d):
    return X.edge_contacts(pixels(spark, d), "vec_id", F.col("a") >= 128, 8, 8)


@query(f"""WITH {PIXELS}, s AS (SELECT vec_id, sum(CASE WHEN a >= 16 THEN {_RING} ELSE 0 END) AS e FROM px GROUP BY vec_id),
n AS (SELECT vec_id, y // 4 * 2 + x // 4 + 1 AS idx, count(*) AS n FROM px WHERE a >= 16 GROUP BY ALL), o AS (SELECT vec_id, list_sort(list(CAST(idx AS INTEGER))) AS occupied FROM n WHERE n >= 12 GROUP BY vec_id),
i AS (SELECT s.vec_id, unnest([CASE WHEN e > 0 THEN 'source-edge-contact' END, CASE WHEN coalesce(occupied, []) <> [1, 2, 3, 4] THEN 'source-slot-count-mismatch' END]) AS code, unnest([1, 2]) AS ord FROM s LEFT JOIN o USING (vec_id))
SELECT vec_id, ord, 'fail' AS severity, code FROM i WHERE code IS NOT NULL""")
def source_gate_issues(spark, d):
    return X.source_gate(pixels(spark, d), _quarters(spark), "vec_id", "native-alpha", 4, 8, 8, (16, 16), "Icon_Item", share=0.75, floor=2)


@query(f"""WITH {PIXELS}, l AS (SELECT vec_id, x, y, v > 0 AS s FROM px), g AS (SELECT vec_id, s, lag(s, 1) OVER h AS x1, lag(s, 1) OVER w AS y1, lag(s, 2) OVER h AS x2, lag(s, 2) OVER w AS y2 FROM l WINDOW h AS (PARTITION BY vec_id, y ORDER BY x), w AS (PARTITION BY vec_id, x ORDER BY y)),
c AS (SELECT vec_id, (avg(CAST(x1 <> s AS INTEGER)) + avg(CAST(y1 <> s AS INTEGER)) + avg(CAST(x2 = s AS INTEGER)) + avg(CAST(y2 = s AS INTEGER))) / 4 >= 0.55 AS is_checker FROM g GROUP BY vec_id),
rim AS (SELECT * FROM px WHERE y < 2 UNION ALL SELECT * FROM px WHERE y >= 6 UNION ALL SELECT * FROM px WHERE x < 2 UNION ALL SELECT * FROM px WHERE x >= 6),
k AS (SELECT vec_id, round_even(median(r), 0) AS kr, round_even(median(g), 0) AS kg, round_even(median(b), 0) AS kb FROM rim GROUP BY vec_id),
n AS (SELECT px.*, sqrt(pow(r - kr, 2) + pow(g - kg, 2) + pow(b - kb, 2)) <= 60 AS near FROM px JOIN k USING (vec_id)),
t AS (SELECT vec_id, min(CASE WHEN label % 3 = 0 THEN a ELSE 255 END) AS la, avg(CAST(near AS INTEGER)) AS coverage, sum(CASE WHEN near THEN {_RING} ELSE 0 END) / CAST(sum({_RING}) AS DOUBLE) AS border_coverage FROM n GROUP BY vec_id)
SELECT vec_id, CASE WHEN la < 255 THEN 'alpha-sheet' WHEN is_checker THEN 'checkerboard-presentation' WHEN border_coverage >= 0.85 AND coverage >= 0.20 THEN 'flat-background-sheet' ELSE 'opaque-mixed-image' END AS classification, coverage, border_coverage FROM t JOIN c USING (vec_id)""")
def sheet_classification(spark, d):
    px = pixels(spark, d)
    agreement = P.lag_agreement(px.withColumn("s", F.col("v") > 0), "vec_id", "s", 1)
    opaque = px.withColumn("a", F.when(F.col("label") % 3 == 0, F.col("a")).otherwise(255))
    return X.sheet_classes(opaque, "vec_id", 8, 8, agreement.withColumn("is_checker", F.col("score") >= 0.55), threshold=60.0)


_MANIFEST = """m AS (SELECT doc_id, n_chars AS declared, CASE WHEN doc_id % 13 = 0 THEN '02' ELSE '01' END AS prefix, CASE WHEN doc_id % 17 = 0 THEN 'bad name.png' ELSE '01_' || source || '_' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') || '.png' END AS name, sha256(text) AS digest, source FROM documents),
f AS (SELECT doc_id, length(text) + CASE WHEN doc_id % 29 = 0 THEN 1 ELSE 0 END AS actual FROM documents WHERE doc_id % 11 <> 0),
x AS (SELECT m.*, f.actual, f.doc_id IS NOT NULL AS present, min(m.doc_id) OVER (PARTITION BY digest) AS first_holder FROM m LEFT JOIN f USING (doc_id)),
i AS (SELECT doc_id, unnest([CASE WHEN NOT present THEN 'missing-file' END, CASE WHEN NOT regexp_matches(name, '^[0-9]{2}_[A-Za-z0-9_]+_[0-9]{3}\\.png$') THEN 'invalid-filename' END, CASE WHEN NOT starts_with(name, prefix) THEN 'category-prefix-mismatch' END,
  CASE WHEN present AND actual <> declared THEN 'dimension-mismatch' END, CASE WHEN present AND actual = 0 THEN 'empty-alpha' END, CASE WHEN doc_id <> first_holder THEN 'duplicate-output' END]) AS code, unnest([0, 1, 2, 3, 4, 5]) AS ord FROM x),
iss AS (SELECT doc_id, ord, CASE WHEN ord = 5 THEN 'warning' ELSE 'fail' END AS severity, code FROM i WHERE code IS NOT NULL)"""


def _pack(spark, d):
    docs, k = table(spark, d, "documents"), F.col("doc_id")
    name = F.when(k % 17 == 0, "bad name.png").otherwise(F.concat(F.lit("01_"), "source", F.lit("_"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(".png")))
    manifest = docs.select("doc_id", F.col("n_chars").alias("declared"), F.when(k % 13 == 0, "02").otherwise("01").alias("prefix"), name.alias("name"), F.sha2("text", 256).alias("digest"), "source")
    # Every eleventh file is missing and every 29th is one too long: what the checks are to find.
    files = docs.where("doc_id % 11 <> 0").select("doc_id", (F.length("text") + F.when(k % 29 == 0, 1).otherwise(0)).alias("actual"))
    return manifest, X.pack_issues(manifest, files, "doc_id")


@query(f"WITH {_MANIFEST} SELECT * FROM iss")
def pack_validation_issues(spark, d):
    return _pack(spark, d)[1]


@query(f"""WITH {_MANIFEST}, w AS (SELECT doc_id, bool_or(severity = 'fail') AS fails FROM iss GROUP BY doc_id)
SELECT source, count(*) AS entries, count(*) FILTER (WHERE fails IS NULL) AS clean, count(*) FILTER (WHERE NOT coalesce(fails, false)) AS passing FROM m LEFT JOIN w USING (doc_id) GROUP BY source""")
def pack_pass_counts(spark, d):
    manifest, found = _pack(spark, d)
    return X.pass_counts(manifest, found, "doc_id", "source")


_QUEUE = """j AS (SELECT o_custkey, o_orderkey, substr(o_orderpriority, 1, 1) AS prio, o_orderkey % 3 = 0 AS needs_matte FROM orders),
t AS (SELECT *, 'sheet' AS kind, 0 AS io FROM j UNION ALL SELECT *, 'matte', 1 FROM j WHERE needs_matte),
p AS (SELECT DISTINCT l_orderkey AS o_orderkey, CASE WHEN l_returnflag = 'R' THEN 'matte' ELSE 'sheet' END AS kind FROM lineitem)"""


@query(f"""WITH {_QUEUE} SELECT t.o_custkey, t.o_orderkey, t.kind, CAST(row_number() OVER (PARTITION BY t.o_custkey ORDER BY prio, t.o_orderkey, io) AS INTEGER) AS sequence, CASE WHEN t.kind = 'matte' THEN 'sheet' END AS depends_on,
  CASE WHEN p.kind IS NOT NULL THEN 'complete' WHEN t.kind = 'sheet' OR s.kind IS NOT NULL THEN 'ready' ELSE 'blocked' END AS status
FROM t LEFT JOIN p ON p.o_orderkey = t.o_orderkey AND p.kind = t.kind LEFT JOIN p s ON s.o_orderkey = t.o_orderkey AND s.kind = 'sheet'""")
def task_queue(spark, d):
    jobs = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("prio"), (F.col("o_orderkey") % 3 == 0).alias("needs_matte"))
    present = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_returnflag") == "R", "matte").otherwise("sheet").alias("kind"))
    return X.task_queue(jobs, present, "o_custkey", "o_orderkey", ["prio"])


@query(f"""WITH {_SLOTS}, {_PLACED}, c AS (SELECT p.layout_id, image_id, comp_id, idx, p.r - p.l AS w, p.b - p.t AS h, sl, st, sr, sb FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY comp_id) AS k FROM placed) p JOIN slots s ON s.layout_id = p.layout_id AND s.idx = p.k),
k AS (SELECT *, least(1.0, (sr - sl) / CAST(w AS DOUBLE), (sb - st) / CAST(h AS DOUBLE)) AS scale FROM c), z AS (SELECT *, greatest(1, CAST(round_even(w * scale, 0) AS INTEGER)) AS pw, greatest(1, CAST(round_even(h * scale, 0) AS INTEGER)) AS ph FROM k)
SELECT image_id, comp_id, idx, scale, pw, ph, CAST(sl + floor((sr - sl - pw) / 2.0) AS INTEGER) AS px, CAST(st + floor((sb - st - ph) / 2.0) AS INTEGER) AS py FROM z""")
def reflow_placements(spark, d):
    # An image's crops go to its layout's slots one by one; crops beyond the last slot have no place.
    place = F.row_number().over(Window.partitionBy("image_id").orderBy("comp_id"))
    crops = _placed(spark, d).select("layout_id", "image_id", "comp_id", (F.col("r") - F.col("l")).alias("w"), (F.col("b") - F.col("t")).alias("h"), place.alias("idx"))
    slots = _slots(spark, d).select("layout_id", "idx", "sl", "st", "sr", "sb")
    return X.placements(crops, slots, ["layout_id", "idx"]).select("image_id", "comp_id", "idx", "scale", "pw", "ph", "px", "py")


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) * 7 AS w, CAST(l_partkey % 190 + 5 AS INTEGER) AS h, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE 128 END AS t, CASE WHEN l_suppkey % 2 = 0 THEN 'center' ELSE 'bottom-center' END AS alignment FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem)),
c AS (SELECT *, coalesce(t, w + 8) AS cw, coalesce(t, h + 8) AS ch FROM b), s AS (SELECT *, least(1.0, (cw - 8) / CAST(w AS DOUBLE), (ch - 8) / CAST(h AS DOUBLE)) AS scale FROM c),
r AS (SELECT *, greatest(1, CAST(round_even(w * scale, 0) AS INTEGER)) AS rw, greatest(1, CAST(round_even(h * scale, 0) AS INTEGER)) AS rh FROM s)
SELECT l_orderkey, l_linenumber, l_partkey, scale, rw, rh, CAST(floor((cw - rw) / 2.0) AS INTEGER) AS x, CASE WHEN alignment = 'center' THEN CAST(floor((ch - rh) / 2.0) AS INTEGER) ELSE ch - 4 - rh END AS y FROM r""")
def normalised_positions(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").distinct()
    target = F.when(F.col("l_suppkey") % 3 != 0, 128)
    trims = rows.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity").cast("int") * 7).alias("w"), (F.col("l_partkey") % 190 + 5).cast("int").alias("h"), target.alias("tw"), target.alias("th"), F.when(F.col("l_suppkey") % 2 == 0, "center").otherwise("bottom-center").alias("alignment"))
    return X.normalised(trims, 4).select("l_orderkey", "l_linenumber", "l_partkey", "scale", "rw", "rh", "x", "y")


@query("""WITH s AS (SELECT p_partkey, CAST(p_size + 40 AS INTEGER) AS w, CAST(p_size * 2 + 30 AS INTEGER) AS h, 5 AS l, 6 AS b, 7 AS r, CAST(p_size % 9 + 1 AS INTEGER) AS t FROM part), f AS (SELECT s.*, factor FROM s, (VALUES (0.5), (1.5), (2.0)) AS v(factor)),
t AS (SELECT *, greatest(l + r + 1, CAST(round_even(CAST(w * factor AS DOUBLE), 0) AS INTEGER)) AS tw, greatest(t + b + 1, CAST(round_even(CAST(h * factor AS DOUBLE), 0) AS INTEGER)) AS th FROM f)
SELECT p_partkey, CAST(factor AS DOUBLE) AS factor, CAST(k AS INTEGER) AS patch, [0, l, w - r, w][k % 3 + 1] AS sl, [0, l, w - r, w][k % 3 + 2] AS sr, [0, t, h - b, h][k // 3 + 1] AS st, [0, t, h - b, h][k // 3 + 2] AS sb,
  [0, l, tw - r, tw][k % 3 + 1] AS tl, [0, l, tw - r, tw][k % 3 + 2] AS tr, [0, t, th - b, th][k // 3 + 1] AS tt, [0, t, th - b, th][k // 3 + 2] AS tb FROM t, range(9) AS p(k)""")
def nine_slice_patches(spark, d):
    size = F.col("p_size")
    sprites = table(spark, d, "part").select("p_partkey", (size + 40).alias("w"), (size * 2 + 30).alias("h"), F.lit(5).alias("left"), F.lit(6).alias("bottom"), F.lit(7).alias("right"), (size % 9 + 1).alias("top"))
    return X.nine_patches(sprites).select("p_partkey", "factor", "patch", "sl", "sr", "st", "sb", "tl", "tr", "tt", "tb")


@query()
def panel_reuse_fold(spark, d):
    # The fold has no set-based form; tests hold it against plain Python.
    e = table(spark, d, "events")
    rows = e.select(F.col("user_id"), F.dayofmonth("ts").alias("day"), F.col("event_id").alias("asset_ord"), F.concat_ws("|", "event_type", F.get_json_object("props", "$.k")).alias("key"), (F.get_json_object("props", "$.k").cast("int") % 8).cast("string").alias("frame"))
    first = rows.groupBy("user_id").agg(F.min("day").alias("first"))
    catalog = table(spark, d, "part").where("p_partkey % 10 = 0").select(F.concat(F.lit("view|"), F.col("p_partkey").cast("string")).alias("key"), F.concat(F.lit("listed-"), F.col("p_partkey").cast("string")).alias("id"))
    return X.panel_reuse(rows.join(first, "user_id").withColumn("screen_ord", F.col("day") - F.col("first")), catalog, "user_id")


@query("""SELECT p_partkey, category, coalesce(CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS DOUBLE) END, 12.0) AS merge_distance, CASE category WHEN 'Panel' THEN 0.06 WHEN 'Button' THEN 0.06 WHEN 'Icon_Skill' THEN 0.15 WHEN 'Icon_Effect' THEN 0.18 END::DOUBLE AS merge_distance_ratio,
  CASE category WHEN 'Panel' THEN 64.0 WHEN 'Button' THEN 48.0 WHEN 'Icon_Skill' THEN 96.0 WHEN 'Icon_Effect' THEN 128.0 END::DOUBLE AS merge_distance_max, CASE WHEN p_partkey % 5 = 0 THEN ['merge_gap'] ELSE [] END AS unknown_keys
FROM (SELECT *, ['Panel', 'Button', 'Icon_Skill', 'Icon_Effect'][p_partkey % 4 + 1] AS category FROM part)""")
def fragment_policies(spark, d):
    k = F.col("p_partkey")
    category = F.element_at(F.array(*map(F.lit, ("Panel", "Button", "Icon_Skill", "Icon_Effect"))), (k % 4 + 1).cast("int"))
    given = F.map_concat(F.when(k % 3 == 0, F.create_map(F.lit("merge_distance"), F.col("p_size").cast("string"))).otherwise(F.create_map().cast("map<string,string>")), F.when(k % 5 == 0, F.create_map(F.lit("merge_gap"), F.lit("1"))).otherwise(F.create_map().cast("map<string,string>")))
    rows = table(spark, d, "part").select("p_partkey", category.alias("category"), given.alias("given"))
    return X.policies(rows, "category", "given").drop("given")


@query(f"""WITH {ISSUES} SELECT job_id, string_agg('- ' || severity || ' ' || code, chr(10) ORDER BY ord) AS text FROM issues GROUP BY job_id""")
def job_reports(spark, d):
    return report_lines(issues(spark, d), "job_id", ["ord"], F.concat(F.lit("- "), "severity", F.lit(" "), "code"))


@query()
def component_classes_of_slots(spark, d):
    from packloom.operators.boxes import classified_components

    return classified_components(boxes(spark, d).withColumn("slot", F.col("comp_id") % 2), ["image_id", "slot"])
