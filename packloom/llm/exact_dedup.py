"""Exact dedup by content-defined chunk recipes.

A text without white space is cut where a hash of its last eight bytes says so; each chunk is known by a 64-bit
digest. Chunk contents are moved once, deduplicated on the way: a digest that stands for a single content is
verified, and is then an identifier. Documents are compared by their ordered lists of identifiers alone. Where a
digest stands for several contents, the documents that hold it carry those chunks' bytes beside the list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, KEY, cut, identified, text_or_empty, without

MEAN_BITS, LEAST, MOST = 10, 256, 8192
#: More disputed digests than this are not sent to the tasks; every document then carries its bytes.
DISPUTED_MOST = 1_000_000
_DROP = BLANKS.encode()


def chunk_ends(data: bytes, mean_bits: int = MEAN_BITS, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of data: content-defined, at least `least` bytes after the last and at most `most`."""
    n, ends, last = len(data), [], 0
    if n > least:
        words = np.ndarray((n - 7,), "<u8", data, strides=(1,))
        marks = np.flatnonzero(words * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - mean_bits) == 0) + 8
        for end in marks.tolist():
            while end - last > most:
                last += most
                ends.append(last)
            if least <= end - last and end < n:
                ends.append(last := end)
    while n - last > most:
        last += most
        ends.append(last)
    if n:
        ends.append(n)
    return ends


def _chunks(text: str, bits: int) -> tuple[bytes, list[tuple[int, bytes]]]:
    data, last, found = text.encode().translate(None, _DROP), 0, []
    for end in chunk_ends(data):
        part = data[last:end]
        digest = xxhash.xxh3_64_intdigest(part) >> 64 - bits
        found.append((digest - (1 << 64) if digest >> 63 else digest, part))
        last = end
    return data, found


_RECIPES = f"doc_id long, key {KEY}, chars long, text_sha256 string, recipe array<long>, disputed array<binary>"


def _recipes(bits: int, disputed: frozenset[int] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars, digests, recipes, beside = [], [], [], []
            for text in batch.column(1):
                data, found = _chunks(t := text.as_py(), bits)
                chars.append(len(t))
                digests.append(hashlib.sha256(data).hexdigest())
                recipes.append([d for d, _ in found])
                beside.append([part for d, part in found if disputed is None or d in disputed])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(chars, pa.int64()), pa.array(digests, pa.string()), pa.array(recipes, pa.list_(pa.int64())), pa.array(beside, pa.list_(pa.binary()))],
                ["doc_id", "key", "chars", "text_sha256", "recipe", "disputed"],
            )

    return run


def _contents(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = [x for text in batch.column(1).slice(at, 256) for x in _chunks(text.as_py(), bits)[1]]
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), pa.array([part for _, part in found], pa.binary())], ["digest", "content"])

    return run


#: DuckDB's form of the query.
ORACLE = r"""
WITH normal AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM normal WINDOW w AS (PARTITION BY t ORDER BY chars DESC, doc_id)
"""


def _judged(docs: DataFrame, digest_bits: int, key: str | None) -> DataFrame:
    known_by = F.col(key) if key else F.lit(None).cast(KEY)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), known_by.alias("key"))
    # A digest with more than one content is no identifier. Contents meet by (digest, content), once each and task.
    clashes = rows.mapInArrow(_contents(digest_bits), "digest long, content binary").distinct().groupBy("digest").count().where("count > 1").select("digest")
    found = clashes.limit(DISPUTED_MOST + 1).collect()
    disputed = None if len(found) > DISPUTED_MOST else frozenset(r[0] for r in found)
    recipes = cut(rows.mapInArrow(_recipes(digest_bits, disputed), _RECIPES).withColumn("row", F.monotonically_increasing_id()))
    first = F.struct("chars", F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("low"), (-F.col("row")).alias("early"))
    groups = recipes.groupBy("recipe", "disputed").agg(F.count("*").alias("n"), F.max_by(F.struct("doc_id", "row"), first).alias("keep"))
    # Cut, so that the join below reads both sides from plain exchanges, whose large partitions Spark can split.
    groups = cut(groups.where("n > 1"))
    alone = F.col("n").isNull()
    return recipes.join(groups, ["recipe", "disputed"], "left").select(
        "doc_id",
        "key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("keep.row") == F.col("row"))).alias("kept"),
        "text_sha256",
    )


def dedup(docs: DataFrame, digest_bits: int = 64) -> DataFrame:
    """One row for each document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space. The longest original text (code points), then the smallest
    doc_id stays. Null and empty texts are one group; a null doc_id comes after all others. Of repeated rows with
    one doc_id, one stays. No rows: none. Other columns of docs are ignored.
    """
    return _judged(docs, digest_bits, None).drop("key")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs that `dedup` keeps, with all their columns: one of each group, whatever doc_ids its rows share."""
    keyed, key = identified(docs)
    gone = _judged(keyed, 64, key).where("not kept").select("key.file", "key.at")
    return without(keyed, key, gone).select(*docs.columns)
