"""Token counts through an exact histogram of encoded lengths.

Documents are counted by encoded length; suffix sums over the histogram then answer, for every context limit that is
a length in the corpus, how many documents and tokens fit, are cut, or lie beyond it. A limit between two lengths
has the figures of the next lower one for counts, and `tokens_kept + (limit - length) * docs_longer` for tokens.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_or_empty
from .tokens import encoder

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Lengths are summed in blocks of so many, then across blocks, so that no window spans all lengths.
BLOCK = 512


def _lengths(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, counts = encoder(vocabulary).ids, Counter()
        for batch in batches:
            counts.update(len(ids_of(text.as_py())) // 4 for text in batch.column(0))
        yield pa.RecordBatch.from_pydict({"tokens": pa.array(counts.keys(), pa.int64()), "n_docs": pa.array(counts.values(), pa.int64())})

    return run


def histogram(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(tokens, n_docs): documents by encoded length. Null and empty texts have length 0; each task sends a row a length."""
    rows = docs.select(text_or_empty().alias("text"))
    return rows.mapInArrow(_lengths(vocabulary), "tokens long, n_docs long").groupBy("tokens").agg(F.sum("n_docs").alias("n_docs"))


def context_limits(hist: DataFrame, block: int = BLOCK) -> DataFrame:
    """Totals, quantile and truncated totals at each length of a histogram (see the module)."""
    hist = hist.withColumn("block", F.floor(F.col("tokens") / block))
    sums = hist.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("tokens")).alias("t"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    sums = sums.select("block", zero(F.sum("d").over(later)).alias("d_later"), zero(F.sum("t").over(later)).alias("t_later"), F.sum("d").over(all_rows).alias("docs"), F.sum("t").over(all_rows).alias("all_tokens"))
    longer = Window.partitionBy("block").orderBy(F.desc("tokens")).rowsBetween(Window.unboundedPreceding, -1)
    d = zero(F.sum("n_docs").over(longer)) + F.col("d_later")
    t = zero(F.sum(F.col("n_docs") * F.col("tokens")).over(longer)) + F.col("t_later")
    out = hist.join(sums, "block").select("tokens", "n_docs", d.alias("docs_longer"), t.alias("tokens_longer"), "docs", "all_tokens")
    lost = F.col("tokens_longer") - F.col("docs_longer") * F.col("tokens")
    return out.select(
        F.col("tokens").alias("context_limit"),
        "n_docs",
        (F.col("docs") - F.col("docs_longer")).alias("docs_fitting"),
        "docs_longer",
        (F.col("all_tokens") - F.col("tokens_longer")).alias("tokens_in_fitting"),
        (F.col("all_tokens") - lost).alias("tokens_kept"),
        lost.alias("tokens_lost"),
        ((F.col("docs") - F.col("docs_longer")) / F.col("docs")).alias("quantile"),
    )


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, block: int = BLOCK) -> DataFrame:
    """One row for each encoded length. Null and empty texts: length 0. No rows: none. Repeated rows count each."""
    return context_limits(cut(histogram(docs, vocabulary)), block)
