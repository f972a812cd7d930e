"""Document fingerprints by SpotSigs.

A signature is a common word (an anchor) with the chain of the next content words after it. A document's fingerprint
is its set of signatures. Documents are compared by the Jaccard similarity of their sets; the join partitions sets by
length, so that only sets whose lengths allow the threshold meet, and prunes by the rarest signatures of each set.
Built from DataFrame functions alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_or_empty

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in a is that it for on with as was are this be by an or from at "
    "der die das und in den von zu ist mit für auf ein eine im dem nicht des sich als auch es an "
    "de la le les et des en un une du est que qui dans pour par sur au avec pas ce il "
    "el los las y del una por con para se su al lo como más o"
).split()
CHAIN, REACH = 2, 8
#: Text in a block of `followed`, and the most blocks, whose bounds are the driver's: beyond them blocks grow.
BLOCK_BYTES, MOST_BLOCKS = 64 << 20, 20_000


def with_fingerprint(df: DataFrame, text: str, name: str, anchors: list[str] = ANCHORS, chain: int = CHAIN, reach: int = REACH) -> DataFrame:
    """df with the sorted distinct signatures of a text column, array<int>.

    Texts without signatures have the chains of all their words instead, or the hash of the whole text; "" has none.
    """
    common = sorted(set(anchors))
    words, held, content = F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != ""), F.col("_words"), F.col("_content")
    places = lambda wanted: F.array_compact(F.transform(held, lambda w, i: F.when(wanted(w), i)))

    def spot(place: Column, earlier: Column) -> Column:
        """Content words before an anchor are its place less the anchors before it, so its chain starts at that one of them."""
        first = place - earlier
        parts = [F.get(held, F.get(content, first + k)) for k in range(chain)]
        return F.when(F.get(content, first + chain - 1) <= place + reach, F.hash(F.get(held, place), *parts))

    spots = F.array_compact(F.transform(places(lambda w: w.isin(common)), spot))
    plain = F.transform(held, lambda w, i: F.hash(w, *(F.get(held, i + k) for k in range(1, chain + 1))))
    whole = F.when(F.col(text) != "", F.array(F.hash(text))).otherwise(F.array().cast("array<int>"))
    found = F.when(F.size(held) == 0, whole).when(F.size("_spots") > 0, F.col("_spots")).otherwise(plain)
    marked = df.withColumn("_words", words).withColumn("_content", places(lambda w: ~w.isin(common))).withColumn("_spots", spots)
    return marked.withColumn(name, F.sort_array(F.array_distinct(found))).drop("_words", "_content", "_spots")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def near_pairs(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(a, b, similarity): pairs of fingerprints of at least the threshold, by the least doc_id that has each.

    Documents of equal fingerprints are one. A set meets others in the parts of lengths [n, n / threshold] alone, by
    the signatures that are rarest in the corpus: two similar sets share one of their first (1 - threshold) n + 1.
    Null and empty texts have no signatures and no pairs. No rows: none.
    """
    # Only "" has no signatures; a filter of the sets themselves would be pushed down to the words and evaluate them again.
    texts = docs.select("doc_id", text_or_empty().alias("text")).where("text <> ''")
    sets = cut(with_fingerprint(texts, "text", "fp").groupBy("fp").agg(F.min("doc_id").alias("id")))
    rarity = cut(sets.select(F.explode("fp").alias("sig")).groupBy("sig").count())
    # The length stands before the explosion, so that no row of it carries the whole set.
    ranked = sets.select("id", "fp", F.size("fp").alias("n")).select("id", "n", F.explode("fp").alias("sig")).join(rarity, "sig")
    order = Window.partitionBy("id").orderBy("count", "sig")
    first = ranked.withColumn("k", F.row_number().over(order)).where(F.col("k") <= F.floor((1 - threshold) * F.col("n") + 1e-9) + 1)
    part = lambda n: F.floor(F.log(n) / F.log(F.lit(1 / threshold))).cast("int")
    home = first.select("sig", F.col("id").alias("a"), F.col("n").alias("na"), part(F.col("n")).alias("part"))
    guest = first.select("sig", F.col("id").alias("b"), F.col("n").alias("nb"), F.explode(F.array(part(F.col("n")), part(F.col("n")) - 1)).alias("part"))
    shorter = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    pairs = home.join(guest, ["sig", "part"]).where(shorter & (F.col("na") >= threshold * F.col("nb"))).select("a", "b").distinct()
    side = lambda k: sets.select(F.col("id").alias(k), F.col("fp").alias(f"f{k}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", likeness(F.col("fa"), F.col("fb")).alias("similarity")).where(F.col("similarity") >= threshold)


def followed(docs: DataFrame) -> DataFrame:
    """key, text, fp of each row and its next row's text and fp, in descending order of key; after the last the first.

    Keys are cut into blocks of even counts at quantiles; a block is a window of its own, closed by a copy of the next
    block's first row. Texts are shuffled once, without their fingerprints, into as many tasks as there are blocks.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_BLOCKS, -(-size // BLOCK_BYTES)))
    # Quantiles of the keys: as many numbers as there are blocks.
    cuts = docs.agg(F.percentile_approx("key", [k / parts for k in range(1, parts)], 10 * parts)).first()[0] or []
    bounds = sorted(set(cuts))
    steps = max(1, len(bounds).bit_length())
    table = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<bigint>")
    # Number of bounds up to the key, by binary search.
    seek = lambda lo, step: F.when(F.coalesce(F.get(table, lo + step - 1) <= F.col("key"), F.lit(False)), lo + step).otherwise(lo)
    block = F.aggregate(F.array(*(F.lit(1 << k) for k in range(steps - 1, -1, -1))), F.lit(0), seek)
    blocked = docs.withColumn("block", block)
    tie = F.xxhash64("text")
    tops = cut(blocked.groupBy("block").agg(F.max("key").alias("top")).select("top"))
    firsts = blocked.join(F.broadcast(tops), F.col("key") == F.col("top"), "left_semi")
    firsts = firsts.withColumn("k", F.row_number().over(Window.partitionBy("block").orderBy(tie))).where("k = 1")
    firsts = cut(firsts.select("block", "key", "text"))
    # As many rows as blocks: each block is closed by the first row of the next lower one, the lowest by the highest's.
    order = Window.orderBy(F.desc("block"))
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    least = F.when(F.col("block") == 0, F.lit(-(1 << 63))).otherwise(F.get(table, F.col("block") - 1))
    closing = firsts.select(F.lit(None).cast("long").alias("doc_id"), least.alias("key"), F.coalesce(F.lead("text").over(order), F.first("text").over(every)).alias("text"), F.lit(1).alias("closes"))
    rows = docs.select("doc_id", "key", "text").withColumn("closes", F.lit(0)).unionByName(closing).withColumn("block", block)
    rows = with_fingerprint(rows.repartition(parts, "block"), "text", "fp")
    w = Window.partitionBy("block").orderBy("closes", F.desc("key"), tie)
    return rows.withColumn("next_text", F.lead("text").over(w)).withColumn("next_fp", F.lead("fp").over(w)).where("closes = 0")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each document.

    Null text: empty, with the empty fingerprint. A null doc_id comes after all others; repeated doc_ids follow each
    other in an order of their texts. A single row is its own next. No rows: none. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"), text_or_empty().alias("text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    pairs = followed(rows).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    out = with_fingerprint(pairs.select("doc_id", n.alias("n_chars"), "fp", "next_fp", "edited"), "edited", "edited_fp")
    return out.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
