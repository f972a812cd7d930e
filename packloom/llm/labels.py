"""Labelled rows that a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut


def held_out(modulus: int, remainder: int) -> Column:
    """crc32 of doc_id as text has this remainder; a null doc_id hasn't."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def fit_rows(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, most: int) -> DataFrame:
    """(text, y) of at most `most` labelled rows outside the fold, in the order of a hash of doc_id.

    `most` is small enough for a broadcast of their ids.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(modulus, remainder))
    known = known.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("y")).dropDuplicates(["_id"])
    chosen = cut(known.orderBy(F.xxhash64("_id"), "_id").limit(most))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(chosen), "_id").select("text", "y")
