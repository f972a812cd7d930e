"""Packing token ids into training sequences by minimum bin slack.

Each document is encoded and closed with an end id. Its whole windows of `capacity` ids each fill a sequence;
what is left, its tail, is packed with other tails. Only the histogram of tail lengths (fewer than `capacity`
rows, whatever the input) reaches the planner. The planner takes the longest length left as a seed, runs a bitset
subset-sum over the other lengths and their counts, backtracks the counts of the sum that comes closest to filling the
sequence, and repeats that multiset as often as the counts allow. Slack that remains is filled with pieces cut from a
few tails: those of the multisets with most slack are laid end to end until they cover the slack of all others. What
is then over is cut at the capacity, and the very last sequences are powers of two, so that none needs padding.

Every executor-side step is by row or by (task, length); no group of documents meets in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written
from .tokens import encoder

CAPACITY = 1024
VOCABULARY = "byte_bpe_50k.tiktoken"

_ENCODED = (
    "task int, doc_id long, doc_tokens long, first_window long, window_crcs array<long>, "
    "tail_length int, tail_crc long, task_rank long, tail_ids binary"
)
_SCHEMA = pa.schema(
    [
        ("task", pa.int32()),
        ("doc_id", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("first_window", pa.int64()),
        ("window_crcs", pa.list_(pa.int64())),
        ("tail_length", pa.int32()),
        ("tail_crc", pa.int64()),
        ("task_rank", pa.int64()),
        ("tail_ids", pa.binary()),
    ]
)
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def closest(have: dict[int, int], seed: int, capacity: int) -> tuple[dict[int, int], int]:
    """(uses of each length, slack) of the multiset of tails, the seed among them, that leaves a sequence least slack."""
    goal = capacity - seed
    mask, reach, steps = (1 << goal + 1) - 1, 1, []
    for length in sorted((x for x in have if x <= goal), key=lambda x: (-have[x] * x, x)):
        if reach >> goal & 1:
            break
        before, part = reach, 1
        rest = min(have[length] - (length == seed), goal // length)
        while rest > 0:
            step = min(part, rest)
            reach |= reach << step * length & mask
            rest, part = rest - step, part * 2
        steps.append((length, before))
    most = reach.bit_length() - 1
    uses, sum_left = {seed: 1}, most
    for length, before in reversed(steps):
        while not before >> sum_left & 1:
            uses[length] = uses.get(length, 0) + 1
            sum_left -= length
    return uses, goal - most


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, dict[int, int], int]], dict[int, int]]:
    """Minimum-bin-slack plan for `counts` tails of each length.

    Returns ([(times, {length: uses}, slack)], cut): each multiset fills a sequence but for its slack and is used that
    many times; `cut` holds the lengths and counts whose ids, laid end to end, fill all that slack and sequences of
    their own.
    """
    have = {length: n for length, n in counts.items() if n > 0}
    chosen: list[tuple[int, dict[int, int], int]] = []
    while have:
        uses, slack = closest(have, max(have), capacity)
        times = min(have[x] // n for x, n in uses.items())
        chosen.append((times, uses, slack))
        for x, n in uses.items():
            have[x] -= n * times
            if not have[x]:
                del have[x]
    # From the most slack down, sequences are given up until their ids cover the slack of the rest.
    chosen.sort(key=lambda x: -x[2])
    need, kept, cut = sum(times * slack for times, _, slack in chosen), [], {}
    for times, uses, slack in chosen:
        # Giving up one sequence brings its ids and takes its slack away: `capacity` together.
        given = min(times, -(-need // capacity)) if need > 0 and slack else 0
        need -= given * capacity
        for x, n in uses.items():
            if given:
                cut[x] = cut.get(x, 0) + n * given
        if times > given:
            kept.append((times - given, uses, slack))
    return kept, cut


def segments(fills: list[tuple[int, int, int, int]], first: int, total: int, capacity: int) -> np.ndarray:
    """How `total` ids laid end to end are cut: rows of (from, piece size, first sequence, offset there), by `from`.

    fills: (times, slack, first sequence, offset) that take their pieces first. What is over makes sequences of
    `capacity` from `first` on, and the last ones are powers of two, largest first. There are no more rows than
    multisets and bits of the capacity, whatever the input.
    """
    out, at = [], 0
    for times, slack, sequence, offset in fills:
        out.append((at, slack, sequence, offset))
        at += times * slack
    whole = max(0, total - at) // capacity
    if whole:
        out.append((at, capacity, first, 0))
        at, first = at + whole * capacity, first + whole
    while at < total:
        size = 1 << (total - at).bit_length() - 1
        out.append((at, size, first, 0))
        at, first = at + size, first + 1
    return np.array(out, dtype=np.int64).reshape(-1, 4)


def _encode(vocabulary: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, windows, ranks, ids_of = TaskContext.get().partitionId(), 0, [0] * capacity, encoder(vocabulary).ids
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, rows = batch.slice(at, 512), []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    ids = ids_of(text.as_py()) + b"\0\0\0\0"
                    n = len(ids) // 4
                    whole, rest = divmod(n, capacity)
                    crcs = [zlib.crc32(ids[k * capacity * 4 : (k + 1) * capacity * 4]) for k in range(whole)]
                    tail = ids[whole * capacity * 4 :]
                    short = np.frombuffer(tail, "<u4")
                    kept = short.astype("<u2").tobytes() if not rest or short.max() < 65536 else tail
                    rows.append((task, doc_id, n, windows, crcs, rest, zlib.crc32(tail), ranks[rest], kept))
                    windows += whole
                    ranks[rest] += 1
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    return run


def _cut_tails(cuts: np.ndarray):
    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for doc_id, base, n, at, length, ids in zip(frame.doc_id, frame.base, frame.doc_tokens, frame["laid"], frame.tail_length, frame.tail_ids, strict=True):
                whole = ids if len(ids) == 4 * length else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                done = 0
                while done < length:
                    k = int(np.searchsorted(cuts[:, 0], at + done, "right")) - 1
                    start, piece, sequence, offset = (int(x) for x in cuts[k])
                    nth, inside = divmod(at + done - start, piece)
                    size = min(length - done, piece - inside)
                    rows.append((doc_id, base + done, size, zlib.crc32(whole[done * 4 : (done + size) * 4]), n, sequence + nth, offset + inside))
                    done += size
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            yield out.astype({c: "int64" for c in out.columns[1:]}).astype({"doc_id": "Int64"})

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of all documents' ids, each with its sequence and its place there.

    Null or empty text: one id, the end id. Null doc_id: kept, null. Repeated rows (and repeated doc_ids) are packed
    each on its own. No rows: no pieces. Very long texts: cut into windows. Other columns of docs are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    encoded = written(rows.mapInArrow(_encode(vocabulary, capacity), _ENCODED), "packing")

    # Bounded: fewer than `capacity` lengths, whatever the input.
    counts = {r[0]: r[1] for r in encoded.where("tail_length > 0").groupBy("tail_length").count().collect()}
    windows = encoded.agg(F.coalesce(F.sum(F.size("window_crcs")), F.lit(0))).first()[0]
    chosen, left = plan(counts, capacity)

    # Rank of each tail among all of its length: rank in its task + tails of that length in earlier tasks.
    by_task = encoded.groupBy("task", "tail_length").agg((F.max("task_rank") + 1).alias("n"))
    earlier = Window.partitionBy("tail_length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranks = by_task.select("task", "tail_length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("tails_before"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = encoded.groupBy("task").agg(F.sum(F.size("window_crcs")).alias("n")).select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("windows_before"))

    whole = (
        encoded.where(F.size("window_crcs") > 0)
        .select("task", "doc_id", "doc_tokens", "first_window", "window_crcs")
        .join(firsts, "task")
        .select("doc_id", "doc_tokens", (F.col("windows_before") + F.col("first_window")).alias("at"), F.posexplode("window_crcs").alias("k", "crc"))
        .select("doc_id", (F.col("k").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"), F.col("crc").alias("ids_crc32"), "doc_tokens", (F.col("at") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    )

    # Runs of ranks of one length that the same multiset takes; its size follows the number of lengths, not the input.
    runs, fills, taken, sequence = [], [], dict.fromkeys(counts, 0), windows
    for times, uses, slack in chosen:
        offset = 0
        for length, n in sorted(uses.items(), reverse=True):
            runs.append((length, taken[length], taken[length] + n * times, sequence, n, offset))
            taken[length] += n * times
            offset += n * length
        if slack:
            fills.append((times, slack, sequence, offset))
        sequence += times
    laid, total = [], 0
    for length, n in sorted(left.items(), reverse=True):
        laid.append((length, taken[length], total))
        total += n * length
    # The base of a tail is the number of its document's ids before it.
    tails = encoded.where("tail_length > 0").withColumn("base", F.col("doc_tokens") - F.col("tail_length"))
    ranked = lambda *more: tails.select("task", "doc_id", "doc_tokens", "base", "tail_length", "task_rank", *more).join(ranks, ["task", "tail_length"]).withColumn("rank", F.col("task_rank") + F.col("tails_before"))
    placed = spark.createDataFrame(runs, "tail_length int, rank_from long, rank_to long, sequence_from long, uses long, offset_from long")
    k = F.col("rank") - F.col("rank_from")
    kept = (
        ranked("tail_crc")
        .join(F.broadcast(placed), "tail_length")
        .where("rank >= rank_from and rank < rank_to")
        .select("doc_id", F.col("base").alias("start"), F.col("tail_length").cast("long").alias("length"), F.col("tail_crc").alias("ids_crc32"), "doc_tokens", (F.col("sequence_from") + F.floor(k / F.col("uses"))).alias("sequence_id"), (F.col("offset_from") + k % F.col("uses") * F.col("tail_length")).alias("offset"))
    )
    cuts = segments(fills, sequence, total, capacity)
    ends = spark.createDataFrame(laid, "tail_length int, rank_from long, laid_from long")
    pieces = (
        ranked("tail_ids")
        .join(F.broadcast(ends), "tail_length")
        .where("rank >= rank_from")
        .select("doc_id", "base", "doc_tokens", (F.col("laid_from") + (F.col("rank") - F.col("rank_from")) * F.col("tail_length")).alias("laid"), "tail_length", "tail_ids")
        .mapInPandas(_cut_tails(cuts), PIECES)
    )
    return whole.unionByName(kept).unionByName(pieces)
