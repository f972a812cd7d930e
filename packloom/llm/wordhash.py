"""Hashes of the words of many texts at once, by prefix sums over their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .common import BLANKS

#: Bytes hashed at once; longer texts go in several pieces, cut at blanks.
PIECE = 250_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.Generator(np.random.PCG64(20_240))
_BYTES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_BLANK = np.isin(np.arange(256), list(BLANKS.encode()))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift, twice)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
        for k, step in enumerate((_STEP, inverse)):
            table = np.full(n, step, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0], _powers[1]


def piece_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start of each word in data, its hash); words are what blanks separate."""
    raw = np.frombuffer(data, np.uint8)
    blank = np.concatenate(([True], _IS_BLANK[raw], [True]))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _power(max(len(raw), PIECE) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=sums[1:], dtype=np.uint64)
    return starts, mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _pieces(data: bytes) -> Iterator[bytes]:
    at = 0
    while len(data) - at > PIECE:
        end = max(data.rfind(b" ", at, at + PIECE), data.rfind(b"\n", at, at + PIECE))
        end = end if end > at else next((k for k in range(at + PIECE, len(data)) if _IS_BLANK[data[k]]), len(data))
        yield data[at:end]
        at = end
    yield data[at:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(number of words of each text, hashes of all words, text after text)."""
    counts, hashes, k = np.zeros(len(texts), np.int64), [], 0
    while k < len(texts):
        size, end = 0, k
        while end < len(texts) and (end == k or size + len(texts[end]) < PIECE):
            size += len(texts[end]) + 1
            end += 1
        if end == k + 1:
            found = [piece_hashes(p)[1] for p in _pieces(texts[k])]
            counts[k] = sum(map(len, found))
            hashes += found
        else:
            starts, found = piece_hashes(b" ".join(texts[k:end]))
            bounds = np.cumsum([0, *(len(t) + 1 for t in texts[k:end])])
            counts[k:end] = np.diff(np.searchsorted(starts, bounds))
            hashes.append(found)
        k = end
    return counts, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)


def parts(batches: Iterator, rows: int = 512) -> Iterator:
    """Arrow batches in parts of at most `rows` rows, so that few texts are Python strings at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def slices(texts: list[str], rows: int = 512, size: int = 250_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `rows` rows and about `size` characters."""
    start = total = 0
    for k, t in enumerate(texts):
        if k > start and (k - start >= rows or total + len(t) > size):
            yield start, k
            start, total = k, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)
