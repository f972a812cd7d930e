"""Near-duplicate documents by BagMinHash over multisets of five-word shingles.

A shingle of weight w owns the unit steps 1..w. Steps are dealt into blocks (0, 1], (1, 2], (2, 4], (4, 8], ... and
each block of each shingle is a Poisson process whose points, in order of time, carry one of the signature's
components and a step, found by halving the block along the bits of the point's hash; points beyond w don't count.
A component's value is the time of its first point, so two documents agree in it with the probability of their
weighted Jaccard similarity. Points are drawn in rising time, and a shingle stops once it is later than every
component of its document.

Signatures are cut into bands. Documents with equal multisets are one node. Within a band's bucket the most central
node is compared with all others; where a bucket still holds several components, its minor ones are compared with
every node of another component. Left out are pairs that cannot reach the threshold with the shingles that each shares
with any node at all (an exact bound), and pairs whose signatures exclude it by six standard errors (about one pair in
10**9 at the threshold, less than banding misses; errors=None verifies these too); all others are verified by the exact
overlap of their multisets. Components of the verified links are the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY, forget, identified, sized, text_or_empty, without, written
from .components import components
from .wordhash import mixed, parts, slices, word_hashes

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 42, 6
#: Bits kept of each component for estimates, and longs that hold them.
NIBBLES = 16
#: A pair is left unverified where its estimate is so many standard errors below the threshold; None: none is.
ERRORS = 6
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_ODD = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93)]


def shingles(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight), sorted by text, then shingle. A text of fewer words has one shingle, of all of them."""
    counts, words = word_hashes(texts)
    first = np.cumsum(counts) - counts
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(texts)), n)
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    length = np.minimum(counts, size)[text]
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        has = k < length
        total[has] += words[at[has] + k] * _ODD[k % len(_ODD)]
    found = mixed(total + length.astype(np.uint64) * _GOLDEN)
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    new = np.ones(len(order), bool)
    new[1:] = (text[1:] != text[:-1]) | (found[1:] != found[:-1])
    start = np.flatnonzero(new)
    return text[start], found[start], np.diff(np.append(start, len(order)))


def bag_signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, size: int) -> np.ndarray:
    """n x size times of first points (infinite for texts without shingles)."""
    signature = np.full(n * size, np.inf)
    owners, keys, widths, covers = [], [], [], []
    low, width, block = 0, 1, 0
    while True:
        here = weight > low
        if not here.any():
            break
        owners.append(text[here])
        keys.append(mixed(shingle[here] + np.uint64((block + 1) * int(_ODD[0]) % (1 << 64))))
        widths.append(np.full(here.sum(), width))
        covers.append(np.minimum(weight[here] - low, width))
        low, width, block = low + width, max(1, low + width), block + 1
    owner, key, width, cover = map(np.concatenate, (owners, keys, widths, covers)) if owners else [np.zeros(0, int)] * 4
    time, drawn = np.zeros(len(owner)), 0
    while len(owner):
        # Several points at once where few shingles are left.
        k = int(np.clip(60_000 // len(owner), 1, 64))
        x = mixed(key[:, None].astype(np.uint64) + (np.arange(drawn + 1, drawn + k + 1, dtype=np.uint64) * _GOLDEN)[None, :])
        y = mixed(x ^ _ODD[1])
        # Times are added one by one from the first, so that a value has the same bits however many are drawn at once.
        gaps = -np.log1p((x >> np.uint64(11)) * -(2.0**-53)) / (size * width[:, None])
        times = np.cumsum(np.concatenate([time[:, None], gaps], axis=1), axis=1)[:, 1:]
        component = ((y >> np.uint64(40)) * np.uint64(size) >> np.uint64(24)).astype(np.int64)
        step = (y & np.uint64(0xFFFFFFFF)).astype(np.int64) & (width[:, None] - 1)
        counts = step < cover[:, None]
        np.minimum.at(signature, (owner[:, None] * size + component)[counts], times[counts])
        time, drawn = times[:, -1], drawn + k
        live = time < signature.reshape(n, size).max(axis=1)[owner]
        owner, key, width, cover, time = owner[live], key[live], width[live], cover[live], time[live]
    return signature.reshape(n, size)


_SIGNED = f"doc_id long, key {KEY}, n long, a long, b long, bands array<long>, sketch array<long>"


def _sign(bands: int, rows: int):
    size = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            ids, keys, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            for start, end in slices(texts):
                n = end - start
                text, shingle, weight = shingles([t.encode() for t in texts[start:end]])
                values = bag_signatures(text, shingle, weight, n, size).view(np.uint64)
                total = np.bincount(text, weight, n).astype(np.int64)
                digests = [np.zeros(n, np.uint64) for _ in range(2)]
                for k, d in enumerate(digests):
                    np.add.at(d, text, mixed(shingle * _ODD[2 + k] + weight.astype(np.uint64) * _GOLDEN))
                band = np.zeros((n, bands), np.uint64)
                for r in range(rows):
                    band = mixed(band * _ODD[0] + values[:, r::rows] + np.arange(bands, dtype=np.uint64) * _GOLDEN)
                nibble = np.zeros((n, NIBBLES * 16), np.uint64)
                nibble[:, :size] = mixed(values) >> np.uint64(60)
                sketch = np.bitwise_or.reduce(nibble.reshape(n, NIBBLES, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4)), axis=2)
                lists = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.ravel().view(np.int64)), x.shape[1]).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, n), keys.slice(start, n), pa.array(total), *(pa.array(d.view(np.int64)) for d in digests), lists(band), lists(sketch)],
                    ["doc_id", "key", "n", "a", "b", "bands", "sketch"],
                )

    return run


def _multisets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles and weights of each text as bytes, with the digest that its node has."""
    for batch in parts(batches):
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        for start, end in slices(texts):
            n = end - start
            text, shingle, weight = shingles([t.encode() for t in texts[start:end]])
            digests = [np.zeros(n, np.uint64) for _ in range(2)]
            for k, d in enumerate(digests):
                np.add.at(d, text, mixed(shingle * _ODD[2 + k] + weight.astype(np.uint64) * _GOLDEN))
            at = np.searchsorted(text, np.arange(n + 1))
            spans = list(zip(at[:-1], at[1:], strict=True))
            # Weights are left empty where all are 1.
            weights = [weight[i:j].astype(np.uint32).tobytes() if (weight[i:j] > 1).any() else b"" for i, j in spans]
            cells = [pa.array([shingle[i:j].tobytes() for i, j in spans], pa.binary()), pa.array(weights, pa.binary())]
            yield pa.RecordBatch.from_arrays([ids.slice(start, n), *(pa.array(d.view(np.int64)) for d in digests), *cells], ["doc_id", "a", "b", "shingles", "weights"])


def _read(shingles: pa.Scalar, weights: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.frombuffer(shingles.as_buffer(), np.uint64), np.frombuffer(weights.as_buffer(), np.uint32)
    return keys, counts if len(counts) else np.ones(len(keys), np.uint32)


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            rows = batch.slice(start, 256)
            found = [_read(s, w) for s, w in zip(rows.column(1), rows.column(2), strict=True)]
            owner = np.repeat(rows.column(0).to_numpy(), [len(x) for x, _ in found])
            keys, weights = (np.concatenate([x[k] for x in found]).astype(np.int64) for k in range(2))
            yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(keys), pa.array(weights)], ["owner", "shingle", "weight"])


def overlap(s1: np.ndarray, w1: np.ndarray, s2: np.ndarray, w2: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted multisets."""
    _, i, j = np.intersect1d(s1, s2, assume_unique=True, return_indices=True)
    both = np.minimum(w1[i], w2[j]).sum(dtype=np.int64)
    return float(both / max(1, w1.sum(dtype=np.int64) + w2.sum(dtype=np.int64) - both))


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y, s1, w1, s2, w2 = (batch.column(k) for k in range(6))
        sims = [overlap(*_read(s1[i], w1[i]), *_read(s2[i], w2[i])) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([x, y, pa.array(sims, pa.float64())], ["x", "y", "similarity"])


def _estimate(s: Column, t: Column, size: int) -> Column:
    """Similarity estimated from the two sketches, natively: the share of equal nibbles, less what chance equals."""
    ones, unequal = F.lit(0x1111111111111111), F.lit(0)
    for k in range(NIBBLES):
        x = s[k].bitwiseXOR(t[k])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(ones)
        unequal = unequal + F.bit_count(x)
    return 1 - unequal / (size * 15 / 16)


def link(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, key: str | None = None, errors: float | None = ERRORS) -> tuple[DataFrame, DataFrame]:
    """(documents with their node, verified links between nodes).

    Documents: doc_id, key (the column of that name of docs, else null), n, a, b, row, node; nodes are the least rows
    of equal multisets. Links: x, y, similarity; not all links of a class are listed, but enough of them to connect it.
    """
    size = bands * rows
    known_by = F.col(key) if key else F.lit(None).cast(KEY)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), known_by.alias("key"), text_or_empty().alias("text"))
    signed = written(texts.mapInArrow(_sign(bands, rows), _SIGNED).withColumn("row", F.monotonically_increasing_id()), "signed")
    wordy = signed.where("n > 0")
    nodes = written(wordy.groupBy("n", "a", "b").agg(F.min("row").alias("node")), "nodes")
    first = signed.join(nodes.select("node"), F.col("row") == F.col("node"), "left_semi")
    exploded = first.select("row", F.explode("bands").alias("bucket"))
    shared = exploded.groupBy("bucket").agg(F.count("*").alias("in_bucket")).where("in_bucket > 1")
    met = written(exploded.join(shared, "bucket"), "members")
    central = met.groupBy("row").agg(F.sum("in_bucket").alias("degree"))
    whole = written(first.join(central, "row").select("row", "doc_id", "n", "a", "b", "degree", "sketch"), "facts")

    # Multisets of these nodes alone, read again from their texts.
    wanted = written(whole.select(F.col("doc_id").alias("_id")).distinct(), "wanted")
    some = texts.join(sized(wanted), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("doc_id", "text")
    bags = some.mapInArrow(_multisets, "doc_id long, a long, b long, shingles binary, weights binary").withColumnRenamed("doc_id", "_id")
    keys = whole.select("row", F.col("a").alias("fa"), F.col("b").alias("fb"), F.col("doc_id").alias("fid"))
    bags = written(bags.join(sized(keys), (F.col("a") == F.col("fa")) & (F.col("b") == F.col("fb")) & F.col("_id").eqNullSafe(F.col("fid"))).select("row", "shingles", "weights").dropDuplicates(["row"]), "multisets")

    # Weight that a node shares with any other: an exact bound on its similarities, which settles most outliers.
    only = (F.min("owner").alias("owner"), F.min("weight").alias("weight"), F.count("*").alias("times"))
    alone = bags.mapInArrow(_exploded, "owner long, shingle long, weight long").groupBy("shingle").agg(*only).where("times = 1").groupBy("owner").agg(F.sum("weight").alias("alone"))
    shared_weight = F.col("n") - F.coalesce("alone", F.lit(0))
    facts = written(whole.join(alone, F.col("row") == F.col("owner"), "left").select("row", "n", shared_weight.alias("common"), "degree", "sketch").where(F.col("common") >= threshold * F.col("n")), "facts")
    members = written(met.select("bucket", "row").join(facts, "row"), "members")

    error = (threshold * (1 - threshold) / size) ** 0.5

    def likely(t: str) -> Column:
        """A member and the node in struct t may be similar: by what they can share, then by their sketches."""
        both = F.least(F.col("common"), F.col(f"{t}.common"))
        possible = both >= threshold * (F.col("n") + F.col(f"{t}.n") - both)
        return possible if errors is None else possible & (_estimate(F.col("sketch"), F.col(f"{t}.sketch"), size) >= threshold - errors * error)

    lows = lambda df: df.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()

    def verified(pairs: DataFrame) -> DataFrame:
        side = lambda k: bags.select(F.col("row").alias(k), F.col("shingles").alias(f"s{k}"), F.col("weights").alias(f"w{k}"))
        found = pairs.join(side("x"), "x").join(side("y"), "y").select("x", "y", "sx", "wx", "sy", "wy")
        return found.mapInArrow(_overlaps, "x long, y long, similarity double").where(F.col("similarity") >= threshold)

    facing = F.struct("row", "n", "common", "sketch")
    hubs = written(members.groupBy("bucket").agg(F.max_by(facing, F.struct("degree", (-F.col("row")).alias("low"))).alias("hub")), "hubs")
    tried = written(lows(members.join(hubs, "bucket").where((F.col("row") != F.col("hub.row")) & likely("hub")).select(F.col("hub.row").alias("x"), F.col("row").alias("y"))), "tried")
    links = written(verified(tried), "links")

    # Buckets that hold several components yet: their minor ones against the nodes of all others.
    roots = components(links.select(F.col("x").alias("a"), F.col("y").alias("b"))).select(F.col("node").alias("row"), "root")
    placed = written(members.join(roots, "row", "left").withColumn("root", F.coalesce("root", "row")), "rooted")
    main = placed.groupBy("bucket", "root").count().groupBy("bucket").agg(F.max_by("root", F.struct("count", "root")).alias("main"), F.count("*").alias("n")).where("n > 1")
    open_buckets = written(main.select("bucket", "main"), "open")
    # With all their buckets, so that a pair is met only in the least one that its nodes share.
    rooted = written(placed.join(open_buckets, "bucket").join(first.select("row", "bands"), "row"), "rooted")
    minor = rooted.where("root <> main").select("bucket", F.struct("row", "n", "common", "sketch", "bands").alias("x"), F.col("root").alias("minor"), F.col("main").alias("other"))
    # Of two minor components the pair is met once.
    across = (F.col("root") != F.col("minor")) & ((F.col("root") == F.col("other")) | (F.col("row") > F.col("x.row")))
    once = F.array_min(F.array_intersect("bands", F.col("x.bands"))) == F.col("bucket")
    rest = lows(rooted.join(minor, "bucket").where(across & likely("x") & once).select("x.row", F.col("row").alias("y")).withColumnRenamed("row", "x"))
    again = written(rest.join(tried, ["x", "y"], "left_anti"), "tried")
    more = written(verified(again), "links")
    forget(met, whole, wanted, facts, members, hubs, tried, placed, open_buckets, rooted, again, bags)
    # The node columns are copied onto every document; groups of copies of any size are split by the join.
    known = signed.select("doc_id", "key", "n", "a", "b", "row").join(nodes, ["n", "a", "b"], "left")
    return known, links.unionByName(more)


def _judged(docs: DataFrame, threshold: float, bands: int, rows: int, key: str | None, errors: float | None) -> DataFrame:
    known, links = link(docs, threshold, bands, rows, key, errors)
    roots = components(links.select(F.col("x").alias("a"), F.col("y").alias("b"))).select("node", "root")
    placed = written(known.join(roots, "node", "left").withColumn("class", F.coalesce("root", "node", "row")).select("doc_id", "key", "n", "row", "class"), "placed")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row"))
    sizes = written(placed.groupBy("class").agg(F.count("*").alias("class_size"), best.alias("best")).where("class_size > 1"), "classes")
    alone = F.col("class_size").isNull()
    return placed.join(sizes, "class", "left").select(
        "doc_id",
        "key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        F.col("n").alias("shingles"),
        (alone | (F.col("best.row") == F.col("row"))).alias("kept"),
    )


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, errors: float | None = ERRORS) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class), class_size, shingles, kept of each document.

    Texts of fewer than five words are one shingle. Texts without words (null, empty, blank) are each alone. Of each
    class the row of the least doc_id is kept; null doc_ids come last, and a class of them has a null id. Repeated rows
    are copies of each other. No rows: none. Other columns of docs are ignored.
    """
    return _judged(docs, threshold, bands, rows, None, errors).drop("key")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, errors: float | None = ERRORS) -> DataFrame:
    """The rows of docs that `classes` keeps, with all their columns: one of each class, whatever doc_ids its rows share."""
    keyed, key = identified(docs)
    gone = _judged(keyed, threshold, BANDS, ROWS, key, errors).where("not kept").select("key.file", "key.at")
    return without(keyed, key, gone).select(*docs.columns)
