"""Periodic runs of words by block convolution.

A run is a stretch of words with smallest period q, of at least max(24, 3 * q) words, that no neighbour extends. At
each dyadic scale L (8, 16, 32, ...) a text is cut into blocks of L words. Of a run with period q, L <= q < 2 * L (or
q < 16 at the scale 8), some block and its copy q words further lie within the run, since 2 * L - 1 + q words are at
most its length. The sums of squared differences of word numbers between a block and all places of the window that
follows are a constant, a prefix sum and a correlation, which comes from a number-theoretic transform modulo a prime,
so it is exact; where the sum is zero, the block occurs again. The distance is a candidate for a period: from there
the stretch is extended both ways word by word. Blocks with a word that doesn't return within the window cannot occur
there and are not transformed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

LEAST_WORDS, LEAST_PERIODS, FIRST_SCALE = 24, 3, 8
#: A prime 119 * 2**23 + 1 and a primitive root of it.
PRIME, ROOT = 998_244_353, 3
#: Values transformed at once.
_AT_ONCE = 1 << 17
_powers: dict[int, np.ndarray] = {}


def _power(root: int, n: int) -> np.ndarray:
    """root**0 ... root**(n-1), by doubling."""
    if root not in _powers or len(_powers[root]) < n:
        out = np.ones(1, np.int64)
        while len(out) < n:
            out = np.concatenate([out, out * pow(root, len(out), PRIME) % PRIME])
        _powers[root] = out
    return _powers[root][:n]


def transform(x: np.ndarray, root: int) -> np.ndarray:
    """Number-theoretic transform of each row; root has the order of the row's length, a power of two."""
    rows, n = x.shape
    x = x.reshape(rows, n, 1)
    while n > 1:
        n //= 2
        low, high = x[:, :n], x[:, n:]
        twisted = (low - high) * _power(root, n)[:, None] % PRIME
        x = np.stack([(low + high) % PRIME, twisted], axis=2).reshape(rows, n, -1)
        root = root * root % PRIME
    return x.reshape(rows, -1)


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Modulo the prime: sum of (block[i] - window[place + i])**2, for each row and each place that the window holds whole."""
    length, width = blocks.shape[1], windows.shape[1]
    places, n = width - length + 1, 1 << (width - 1).bit_length()
    root = pow(ROOT, (PRIME - 1) // n, PRIME)
    x, y = np.zeros((len(blocks), n), np.int64), np.zeros((len(blocks), n), np.int64)
    x[:, :length] = blocks[:, ::-1]
    y[:, :width] = windows
    product = transform(transform(x, root) * transform(y, root) % PRIME, pow(root, -1, PRIME)) * pow(n, -1, PRIME) % PRIME
    cross = product[:, length - 1 : length - 1 + places]
    sums = np.cumsum(np.pad(windows * windows % PRIME, ((0, 0), (1, 0))), axis=1)
    return ((blocks * blocks % PRIME).sum(axis=1)[:, None] + sums[:, length : length + places] - sums[:, :places] - 2 * cross) % PRIME


def _scale(numbers: np.ndarray, returns: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of a block, distance to an occurrence of it) at one scale.

    returns: distance from each word to its next occurrence. Sums below the prime are exact; beyond (texts of over
    2,000 different words) a zero may be one modulo the prime alone, which the extension finds out.
    """
    n = len(numbers)
    low, high = (1 if length == FIRST_SCALE else length), 2 * length  # distances low ... high - 1
    high = min(high, n // LEAST_PERIODS + 1)
    starts = np.arange(0, n - length - low + 1, length)
    if low >= high or not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = starts[np.maximum.reduceat(returns[: starts[-1] + length], starts) < high]
    padded = np.concatenate([numbers, np.zeros(high + length, np.int64)])
    found: list[np.ndarray] = []
    step = max(1, _AT_ONCE // (high + length))
    for k in range(0, len(starts), step):
        at = starts[k : k + step]
        blocks = padded[at[:, None] + np.arange(length)]
        windows = padded[at[:, None] + np.arange(low, high + length - 1)]
        row, place = np.nonzero(squared_differences(blocks, windows) == 0)
        hit = np.stack([at[row], place + low])
        found.append(hit[:, hit[0] + hit[1] + length <= n])
    places, distances = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return places, distances


def _matching(left: np.ndarray, right: np.ndarray) -> int:
    """Length of the common beginning, looked for in growing steps."""
    most, at, step = min(len(left), len(right)), 0, 64
    while at < most:
        end = min(at + step, most)
        differs = np.flatnonzero(left[at:end] != right[at:end])
        if len(differs):
            return at + int(differs[0])
        at, step = end, 2 * step
    return most


def runs(numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period, of a text given as numbers of its words."""
    n = len(numbers)
    if n < LEAST_WORDS:
        return []
    order = np.argsort(numbers, kind="stable")
    returns = np.full(n, n, np.int64)
    same = numbers[order[1:]] == numbers[order[:-1]]
    returns[order[:-1][same]] = np.diff(order)[same]
    known: dict[tuple[int, int], int] = {}
    stretches: list[tuple[int, int, int]] = []
    length = FIRST_SCALE
    while length == FIRST_SCALE or LEAST_PERIODS * length <= n:
        places, distances = _scale(numbers, returns, length)
        by = np.lexsort((places, distances))
        places, distances = places[by], distances[by]

        def inside(start: int, end: int, period: int) -> np.ndarray:
            """Candidates of the scale that lie in a stretch of a period that divides theirs: they lead to it again."""
            return (distances % period == 0) & (places >= start) & (places + length + distances <= end)  # noqa: B023

        for stretch in stretches:
            left = ~inside(*stretch)
            places, distances = places[left], distances[left]
        while len(places):
            at, d = int(places[0]), int(distances[0])
            before = _matching(numbers[at + d - 1 :: -1] if at + d else numbers[:0], numbers[at - 1 :: -1] if at else numbers[:0])
            after = _matching(numbers[at:], numbers[at + d :])
            if after < length:  # zero modulo the prime alone
                places, distances = places[1:], distances[1:]
                continue
            start, end = at - before, at + after + d
            stretches.append((start, end, d))
            if end - start >= max(LEAST_WORDS, LEAST_PERIODS * d):
                known[start, end] = min(d, known.get((start, end), d))
            left = ~inside(start, end, d)
            places, distances = places[left], distances[left]
        length *= 2
    return sorted((s, e - s, q) for (s, e), q in known.items())


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, without those that a run holds after its first period."""
    if not found:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in found:
        kept[start + period : start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(kept)])


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_FOUND = f"doc_id long, n_words long, runs {_RUNS}, collapsed string"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            rows = batch.slice(k, 256)
            counts, lists, texts = [], [], []
            for text in rows.column(1):
                words = text.as_buffer().to_pybytes().split()  # bytes split at [\x20\x09-\x0D]
                numbering: dict[bytes, int] = {}
                numbers = np.array([numbering.setdefault(w, len(numbering)) for w in words], np.int64)
                found = runs(numbers)
                counts.append(len(words))
                lists.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                texts.append(collapsed(words, found))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(counts, pa.int64()), pa.array(lists, kind), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])


def find(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start, then period) and collapsed text of each document.

    text: what is searched, by default the column text. Null, empty and blank texts have no words and no runs, and an
    empty collapsed text. Rows with null or repeated doc_ids are searched like others. Other columns are ignored.
    """
    text = text_or_empty() if text is None else F.coalesce(text, F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text")).mapInArrow(_search, _FOUND)


def strongest(found: str = "runs") -> Column:
    """The run of the greatest exact length / period, the first of equal ones; null without runs."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(found, none, lambda best, r: F.when(better(best, r), r).otherwise(best))


def planted() -> Column:
    """The contract's text: where crc32 of the doc_id ends in 0, words from a place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text_or_empty(), F.lit(r"([^\x20\x09-\x0D]+)"))

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int")))), " ")

    # The list is bound once, as the only element that a lambda goes over.
    text = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit(""))), 1)
    return F.when(h % 10 == 0, text).otherwise(text_or_empty())


def digests(docs: DataFrame) -> DataFrame:
    """The contract's columns over the contract's texts."""
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    found = find(docs, planted()).select("doc_id", "runs", strongest().alias("best"), "collapsed")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
