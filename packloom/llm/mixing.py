"""Mixing sources to target weights by systematic sampling.

Targets share all words by the sources' weights, water-filled under a cap of `most` times a source's own words. A
source's documents stand in an order whose sizes rise and then fall: every other one of the sizes' order going up, the
others coming down. The prefix sum of their expected copies, target / words of the source each, plus one random offset
crosses integers, and each crossing emits the document once. So every document is taken with its expected copies on
average, and as neighbours are alike in size and both ends are small, a source's words miss its target by less than its
largest document.

Ranks come from a range sort and counts by partition, so no source, however large, meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY, cut, fresh, identified, sized, text_or_empty

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "packloom"


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _before(*order) -> Window:
    return Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """(no_source, source, source_size, target) from (no_source, source, size): one row a source.

    A cap is met first by the source with the least cap / weight; the level that the others share is the largest of
    the levels found after each source in that order.
    """
    zero = F.lit(0).cast("long")
    total = sizes.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy("no_source", "source")) - 1
    weighed = total.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long"))
    everything = Window.orderBy("no_source", "source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = F.col("source_size") * most
    order = _before((cap / F.col("weight")), "no_source", "source")
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(order), zero)) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), zero))
    levels = weighed.withColumn("level", level)
    return levels.withColumn("top", F.max("level").over(everything)).select("no_source", "source", "source_size", F.least(cap.cast("double"), F.col("top") * F.col("weight")).alias("target"))


def _sampled(docs: DataFrame, weights: tuple, most: int, seed: str, key: str | None) -> DataFrame:
    spark = docs.sparkSession
    known_by = F.col(key) if key else F.lit(None).cast(KEY)
    # Cut before the range sort, which would else count the words of all texts twice.
    measured = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), known_by.alias("key"), F.col("source").isNull().alias("no_source"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), words(text_or_empty()).alias("size"), F.xxhash64(text_or_empty()).alias("digest")))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Rows alike in all else are dealt by a salt, so that no range holds them all. Cut, as bounds may differ when computed again.
    salted = measured.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    ranged = cut(salted.repartitionByRange(parts, "no_source", "source", "size", "doc_id", "digest", "salt").withColumn("part", F.spark_partition_id()))
    sources = targets(ranged.select("no_source", "source", "size"), weights, most)
    counts = ranged.groupBy("no_source", "source", "part").agg(F.count("*").alias("rows"))
    source = Window.partitionBy("no_source", "source")
    before = source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("no_source", "source", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"), F.sum("rows").over(source).alias("rows"))
    # One row for each source and partition that holds it: no more than sources + partitions.
    facts = cut(counts.join(sources, ["no_source", "source"]))
    local = F.row_number().over(Window.partitionBy("part", "no_source", "source").orderBy("size", "doc_id", "digest", "salt"))
    offset = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col("no_source").cast("string"), F.col("source"))), 1, 8), 16, 10).cast("double") / 4294967296.0
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ranked = ranged.withColumn("local", local).join(sized(facts), ["part", "no_source", "source"]).withColumn("rank", F.col("local") + F.col("rows_before"))
    # Odd ranks by size go up, even ones come down after them.
    place = F.when(F.col("rank") % 2 == 1, (F.col("rank") + 1) / 2).otherwise(F.col("rows") + 1 - F.col("rank") / 2)
    at = lambda k: F.floor(F.col("offset") + F.col("each") * k)
    copies = F.least(at(F.col("place")) - at(F.col("place") - 1), F.lit(most)).cast("long")
    drawn = ranked.withColumn("place", place).withColumn("each", each).withColumn("offset", offset).withColumn("copies", copies)
    return drawn.select("doc_id", "key", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def sample(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """Copies of each document: doc_id, size, source_size, target, taken, copies.

    Null text has size 0; a null source is a source of its own, last. Sources without words have target 0 and are
    not taken. Repeated rows are sampled each on its own. No rows: none. Reruns give the same rows.
    """
    return _sampled(docs, weights, most, seed, None).drop("key")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The documents themselves, with all columns, each row as often as the mix takes it, whatever doc_ids rows share."""
    keyed, key = identified(docs)
    copies, copy = fresh(keyed, "copies"), fresh(keyed, "copy")
    taken = cut(_sampled(keyed, weights, most, seed, key).where("copies > 0").select("key.file", "key.at", F.col("copies").cast("int").alias(copies)))
    same = (keyed[key]["file"] == taken["file"]) & (keyed[key]["at"] == taken["at"])
    found = keyed.join(sized(taken), same).select(keyed["*"], taken[copies])
    return found.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM per
), levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS DOUBLE) AS level
  FROM weighed
  WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), max(level) OVER () * weight) AS target,
    CAST('0x' || substr(md5('packloom|' || CASE WHEN source IS NULL THEN 'true' ELSE 'false' END || '|' || coalesce(source, '')), 1, 8) AS BIGINT) / 4294967296.0 AS u
  FROM levels
), ranked AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.u, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS e,
    row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) AS r, count(*) OVER (PARTITION BY s.source) AS n
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), placed AS (
  SELECT *, CASE WHEN r % 2 = 1 THEN (r + 1) // 2 ELSE n + 1 - r // 2 END AS p FROM ranked
), taken AS (
  SELECT *, CAST(least(floor(u + e * p) - floor(u + e * (p - 1)), 3) AS BIGINT) AS copies FROM placed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, copies * size AS taken, copies FROM taken
"""
