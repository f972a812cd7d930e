"""Queries of pack validation: embeddings as the images of packs, a label each, with defects planted by vec_id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.functions import constants as C
from packloom.operators import raster as P
from packloom.operators import validation as V

from .registry import query, table
from .standins import PIXELS, pixels

_NAMES = [row[0] for row in C.CATEGORIES]


def _tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    ids = table(spark, d, "embeddings").select(F.col("label").alias("pack"), F.col("vec_id").alias("ord")).distinct()
    at = lambda n: F.col("ord") % n
    category = F.element_at(F.array(*map(F.lit, _NAMES)), (at(9) + 1).cast("int"))
    prefix = F.when(at(19) == 0, "07").otherwise(F.concat(F.lit("0"), (at(9) + 1).cast("string")))
    name = F.concat(prefix, F.lit("_"), category, F.when(at(23) == 0, "_A-").otherwise("_A"), F.col("ord").cast("string"), F.lit("_Default_"), F.lpad(at(1000).cast("string"), 3, "0"), F.lit(".png"))
    output = F.when(at(29) == 0, "final/twice.png").otherwise(F.concat(F.lit("final/"), category, F.lit("/"), name))
    mode = F.when(at(5) == 0, V.NATIVE).when(at(5) == 1, V.MATTE).otherwise("chroma-key")
    digest = lambda n: F.when(at(n) != 0, F.sha2(F.col("ord").cast("string"), 256))
    stem = F.concat(F.lit("side/"), F.col("ord").cast("string"))
    entries = ids.select(
        "pack",
        "ord",
        F.concat(F.lit("asset-"), F.col("ord").cast("string")).alias("id"),
        F.concat(F.lit("job-"), at(7).cast("string")).alias("job_id"),
        category.alias("category"),
        output.alias("output"),
        F.when(at(13) == 0, 9).otherwise(8).alias("width"),
        F.lit(8).alias("height"),
        (F.floor(F.col("ord") / 90) % 4).cast("int").alias("category_index"),
        F.when(at(4) == 1, "#787878").when(at(4) == 2, "#00FF00").alias("chroma_key"),
        mode.alias("transparency_mode"),
        F.when(at(3) != 0, F.when(at(5) == 0, "model-native").otherwise("gpt-image-2-matte-derived")).alias("alpha_origin"),
        digest(7).alias("source_sha256"),
        F.when(at(2) == 0, F.concat(stem, F.lit(".provenance.json"))).alias("alpha_provenance"),
        F.when(at(2) == 0, F.concat(stem, F.lit("-alpha-matte.png"))).alias("alpha_matte"),
        digest(6).alias("alpha_matte_sha256"),
    )
    packs = ids.groupBy("pack").agg((F.count("*") + F.col("pack") % 2).alias("expected")).select("pack", "expected", F.when(F.col("pack") % 2 == 0, "#FF00FF").alias("chroma_key"))
    bytes_of = P.packed(pixels(spark, d).select("vec_id", "x", "y", "r", "g", "b", "a"), "vec_id", 8, 8).withColumnRenamed("vec_id", "ord")
    held = entries.where(at(11) != 0).groupBy("pack", F.col("output").alias("file")).agg(F.min("ord").alias("ord"))
    images = held.join(bytes_of, "ord").select("pack", "file", "width", "height", F.when(at(17) == 0, 3).otherwise(4).alias("channels"), "rgba")
    sides = entries.where(at(8) != 0).select("pack", F.explode(F.array("alpha_provenance", "alpha_matte")).alias("file")).where("file is not null")
    extra = entries.where(at(97) == 0).select("pack", F.concat(F.lit("final/extra-"), F.col("ord").cast("string"), F.lit(".png")).alias("file"))
    files = images.select("pack", "file").unionByName(sides).unionByName(extra)
    return packs, entries, images, files


_CASE_NAMES = "[" + ", ".join(f"'{n}'" for n in _NAMES) + "]"
_PATTERN = "^(0[1-9])_(" + "|".join(_NAMES) + ")_[A-Za-z0-9]+_[A-Za-z0-9]+_[0-9]{3}[.]png$"
_KEY = "coalesce(chroma_key, pack_key)"
_SIDE = "CASE WHEN mode = 'native-alpha-required' THEN provenance WHEN mode = 'model-matte-derived' THEN matte END"

#: Entries with their figures, and all issues of them up to the first that stops.
CHECKED = f"""{PIXELS.strip()},
e0 AS (SELECT DISTINCT label AS pack, vec_id AS ord, {_CASE_NAMES}[vec_id % 9 + 1] AS category, 'job-' || vec_id % 7 AS job_id, 'asset-' || vec_id AS asset_id,
  CASE vec_id % 5 WHEN 0 THEN 'native-alpha-required' WHEN 1 THEN 'model-matte-derived' ELSE 'chroma-key' END AS mode FROM embeddings),
e1 AS (SELECT *, CASE WHEN ord % 29 = 0 THEN 'final/twice.png' ELSE 'final/' || category || '/' || CASE WHEN ord % 19 = 0 THEN '07' ELSE '0' || (ord % 9 + 1) END || '_' || category || CASE WHEN ord % 23 = 0 THEN '_A-' ELSE '_A' END || ord || '_Default_' || lpad(CAST(ord % 1000 AS VARCHAR), 3, '0') || '.png' END AS output,
  CASE ord % 4 WHEN 1 THEN '#787878' WHEN 2 THEN '#00FF00' END AS chroma_key, CASE WHEN pack % 2 = 0 THEN '#FF00FF' END AS pack_key, ord // 90 % 4 AS category_index, '0' || (ord % 9 + 1) || '_' || category || '_' AS start,
  CASE WHEN ord % 2 = 0 THEN 'side/' || ord || '.provenance.json' END AS provenance, CASE WHEN ord % 2 = 0 THEN 'side/' || ord || '-alpha-matte.png' END AS matte FROM e0),
e AS (SELECT *, row_number() OVER (PARTITION BY pack, output ORDER BY ord) AS copy, split_part(output, '/', -1) AS name, min(ord) FILTER (WHERE ord % 11 <> 0) OVER (PARTITION BY pack, output) AS holder FROM e1),
f AS (SELECT vec_id, count(*) FILTER (WHERE a > 0) AS opaque, count(*) FILTER (WHERE a = 0) AS transparent, count(*) FILTER (WHERE a = 0 AND (r <> 0 OR g <> 0 OR b <> 0)) AS hidden, count(*) FILTER (WHERE a > 0 AND a < 255) AS partial, count(DISTINCT a) AS levels,
  count(*) FILTER (WHERE a >= 16 AND pow(r - 120, 2) + pow(g - 120, 2) + pow(b - 120, 2) <= 144) AS gray, count(*) FILTER (WHERE a >= 16 AND pow(r, 2) + pow(g - 255, 2) + pow(b, 2) <= 144) AS green,
  count(*) FILTER (WHERE a >= 16 AND pow(r - 255, 2) + pow(g, 2) + pow(b - 255, 2) <= 144) AS magenta, count(*) FILTER (WHERE a >= 16 AND g - greatest(r, b) >= 40) AS green_spill, count(*) FILTER (WHERE a >= 16 AND least(r, b) - g >= 40) AS magenta_spill FROM px GROUP BY vec_id),
c AS (SELECT e.*, f.*, CASE {_KEY} WHEN '#787878' THEN gray WHEN '#00FF00' THEN green WHEN '#FF00FF' THEN magenta ELSE 0 END AS residue, CASE {_KEY} WHEN '#00FF00' THEN green_spill WHEN '#FF00FF' THEN magenta_spill ELSE 0 END AS spilt FROM e LEFT JOIN f ON f.vec_id = e.holder AND e.copy = 1),
i AS (SELECT pack, ord, output AS file, job_id, asset_id, category, CASE WHEN copy > 1 THEN ['duplicate-output'] ELSE list_filter([
    CASE WHEN NOT regexp_matches(name, '{_PATTERN}') THEN 'invalid-filename' END, CASE WHEN NOT starts_with(name, start) THEN 'category-prefix-mismatch' END, CASE WHEN holder IS NULL THEN 'missing-file' END,
    CASE WHEN holder % 17 = 0 THEN 'not-rgba' END, CASE WHEN opaque = 0 THEN 'empty-alpha' END] || CASE WHEN opaque > 0 THEN [CASE WHEN transparent = 0 THEN 'no-transparent-padding' END, CASE WHEN hidden > 0 THEN 'hidden-rgb-under-zero-alpha' END, CASE WHEN ord % 13 = 0 THEN 'dimension-mismatch' END,
    CASE WHEN residue > 0 THEN 'visible-chroma-residue' END, CASE WHEN spilt > 16 THEN 'visible-chroma-spill' END] ELSE [] END || CASE WHEN opaque > 0 AND mode = 'native-alpha-required' THEN [CASE WHEN ord % 3 = 0 THEN 'native-alpha-origin-missing' END, CASE WHEN ord % 7 = 0 THEN 'native-alpha-source-hash-missing' END,
    CASE WHEN ord % 2 = 1 THEN 'native-alpha-provenance-missing' END, CASE WHEN ord % 2 = 0 AND ord % 8 = 0 THEN 'native-alpha-provenance-file-missing' END, CASE WHEN partial = 0 OR levels < 8 THEN 'native-alpha-layering-lost' END] ELSE [] END || CASE WHEN opaque > 0 AND mode = 'model-matte-derived' THEN [CASE WHEN ord % 3 = 0 THEN 'model-matte-origin-missing' END,
    CASE WHEN ord % 7 = 0 THEN 'source-sha256-missing' END, CASE WHEN ord % 6 = 0 THEN 'alpha-matte-sha256-missing' END, CASE WHEN ord % 2 = 1 THEN 'alpha-matte-path-missing' END, CASE WHEN ord % 2 = 0 AND ord % 8 = 0 THEN 'alpha-matte-file-missing' END, CASE WHEN partial = 0 OR levels < 8 THEN 'model-matte-layering-lost' END] ELSE [] END,
    lambda x: x IS NOT NULL) END AS codes FROM c),
own AS (SELECT pack, 1 AS stage, ord, unnest(codes) AS code, file, job_id, asset_id, category FROM i),
n AS (SELECT pack, count(*) AS n FROM e GROUP BY pack),
x AS (SELECT pack, category, min(category_index) AS low, max(category_index) AS high, count(DISTINCT category_index) AS kinds, count(*) AS n FROM e WHERE copy = 1 AND category_index > 0 GROUP BY ALL),
stray AS (SELECT pack, list_sort(list('final/extra-' || ord || '.png')) AS files FROM e WHERE ord % 97 = 0 GROUP BY pack),
every AS (
  SELECT pack, stage, ord, CASE WHEN code = 'no-transparent-padding' THEN 'warning' ELSE 'fail' END AS severity, code, file, job_id, asset_id, category, CAST(NULL AS VARCHAR[]) AS files FROM own
  UNION ALL SELECT pack, 0, 0, 'fail', 'count-mismatch', NULL, NULL, NULL, NULL, NULL FROM n WHERE pack % 2 = 1
  UNION ALL SELECT pack, 2, 0, 'fail', 'non-continuous-category-indices', NULL, NULL, NULL, category, NULL FROM x WHERE low <> 1 OR high <> n OR kinds <> n
  UNION ALL SELECT pack, 3, 0, 'warning', 'unexpected-files', NULL, NULL, NULL, NULL, files FROM stray)"""


@query(f"WITH {CHECKED} SELECT pack, CAST(stage AS INTEGER) AS stage, CAST(ord AS BIGINT) AS ord, severity, code, file, job_id, asset_id, category, array_to_string(files, ',') AS files FROM every")
def whole_pack_issues(spark, d):
    return V.pack_issues(*_tables(spark, d)).withColumn("files", F.array_join("files", ","))


@query(f"""WITH {CHECKED}, p AS (SELECT pack, count(*) FILTER (WHERE severity = 'warning') AS w, count(*) FILTER (WHERE severity = 'fail') AS f, count(DISTINCT file) AS named, count(*) FILTER (WHERE code IN ('duplicate-output', 'missing-file', 'empty-alpha')) AS blocked FROM every GROUP BY pack)
SELECT n.pack, coalesce(f, 0) = 0 AND coalesce(blocked, 0) = 0 AS ok, n.n + n.pack % 2 AS expected_count, n.n AS manifest_count, n.n - coalesce(blocked, 0) AS valid_assets, greatest(0, n.n - coalesce(named, 0)) AS pass_count, coalesce(w, 0) AS warning_count, coalesce(f, 0) AS fail_count FROM n LEFT JOIN p USING (pack)""")
def whole_pack_reports(spark, d):
    packs, entries, images, files = _tables(spark, d)
    return V.pack_reports(packs, entries, V.pack_issues(packs, entries, images, files))
