"""Exact Jaccard join of shingle sets by R-trees over count vectors.

The shingles of a document are hashed into groups; how many fall into each group is its point. Two sets share at most
the sum of the smaller of each coordinate, so an R-tree whose nodes keep the largest coordinates of what is below them
prunes every pair, or whole node, that cannot reach the threshold. Of pairs that the trees leave, those go whose sets
must differ in too many shingles: each set has parities of finer groups, and no two sets differ in more parities than in
shingles. What is left is verified by the sets themselves.

Which documents share a tree: shingles have one order for all, rare ones first (by counts of all documents in cells of
a sketch of fixed size, an error of which costs time only), and of two similar sets the first floor(n / 5) + 1 shingles
in this order (for a threshold of 80 %) have one in common. A document therefore enters the tree of each of these; of k
further ones it enters, similar sets share k more, so a document that shares too few with any others leaves all trees.
Equal sets are one node. In a tree the node that meets others most often is compared first with all. Where several
components are left, each is one entry with the largest coordinates of its sets; entries that the bound can't tell
apart are near, and only their sets are searched against each other. Large trees and components are cut into leaves
that meet in pairs, so no task holds one whole. Components of the verified links are exact: every pair of
similar sets lies in one tree and is either verified or connected already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, forget, identified, sized, text_or_empty, written
from .components import components
from .near_dedup import shingles
from .wordhash import mixed, parts, slices

SHINGLE, PERCENT = 5, 80
GROUPS = 64
#: Groups whose parities are kept, a bit each; sets of up to about twice as many shingles are told apart by them.
PARITIES = 1024
#: Cells of the sketch that orders shingles, and cells that are summed as one row.
CELLS, RUN_OF_CELLS = 1 << 20, 1 << 10
#: One further shingle is looked at for so many of a set.
SPARE = 40
#: Members of a leaf of a large tree; those of a node within a task.
LEAF, FAN_OUT = 128, 8
#: Entries of a tree whose pairs are listed rather than searched.
FEW = 16
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def needed(m, n, percent: int = PERCENT):
    """The least overlap of similar sets of m and n shingles."""
    return -(-percent * (m + n) // (100 + percent))


def possible(shared, low, high, least, most, percent: int = PERCENT):
    """Whether a set of low to high shingles and one of least to most may be similar if they share so many at most."""
    at_least = lambda size: (percent * size + 99) // 100
    fits = (percent * least <= 100 * high) & (100 * most >= percent * low)
    return fits & (shared >= needed(np.maximum(low, at_least(least)), np.maximum(least, at_least(low)), percent))


def differing(every, some, theirs, any_of_theirs):
    """The least number of shingles in which sets differ, by their parities. every: bits that all sets of an entry have;
    some: bits that any of them has. Those of one set are the same."""
    # Without a sign, as the bits of the absolute value would be counted else.
    ones = lambda x: np.bitwise_count(x.view(np.uint64)).sum(axis=1, dtype=np.int64)
    return ones(every & ~any_of_theirs) + ones(theirs & ~some)


def allowed(high, most, percent: int = PERCENT):
    """The most shingles in which similar sets of at most so many shingles differ."""
    both = np.minimum(high, 100 * most // percent) + np.minimum(most, 100 * high // percent)
    return (100 - percent) * both // (100 + percent)


def spare(n):
    """How many of its first shingles, above one, a set of n shares with similar sets that aren't smaller."""
    return n // SPARE


def first_shingles(n, percent: int = PERCENT):
    """How many shingles of a set of n, in the common order, are looked at: 1 + spare(n) of them are in any similar set
    that isn't smaller, and 1 + spare of the smaller set's size in any other. None where all similar sets are equal."""
    return np.where(n * (100 - percent) >= percent, n - (percent * n + 99) // 100 + 1 + spare(n), 0)


def _sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    text, found, _ = shingles([t.lower() for t in texts], size)  # bytes lower A-Z alone
    return text, found


# ---------------------------------------------------------------- the order of shingles


def _cell(found: np.ndarray, cells: int) -> np.ndarray:
    return (found & np.uint64(cells - 1)).astype(np.int64)


def _counted(size: int, cells: int):
    """Documents that have a shingle of each cell, counted over the task, in rows of RUN_OF_CELLS cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for part in parts([batch]):
                texts = part.column(2).to_pylist()
                for start, end in slices(texts):
                    total += np.bincount(_cell(_sets(texts[start:end], size)[1], cells), minlength=cells)
        run_of = min(cells, RUN_OF_CELLS)
        rows = [x.tobytes() for x in total.reshape(-1, run_of)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.binary())], ["run", "counts"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks of the cells of each run: eighths of the logarithm of its count, one byte each."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts = np.frombuffer(counts.as_buffer(), np.int64)
            total[k] = total[k] + counts if k in total else counts
    ranks = [np.minimum(8 * np.log2(1 + x), 255).astype(np.uint8).tobytes() for x in total.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(ranks, pa.binary())], ["run", "ranks"])


def cell_ranks(texts: DataFrame, size: int = SHINGLE, cells: int = CELLS) -> np.ndarray:
    """One byte for each cell; the driver holds CELLS of them, whatever the size of the table."""
    counts = texts.mapInArrow(_counted(size, cells), "run int, counts binary").repartition("run")
    rows = counts.mapInArrow(_summed, "run int, ranks binary").collect()
    return np.frombuffer(b"".join(bytes(r.ranks) for r in sorted(rows, key=lambda r: r.run)), np.uint8)


# ---------------------------------------------------------------- points, sets


_SIGNED = f"doc_id long, key {KEY}, n long, a long, b long, keys array<long>, point array<int>, bits array<long>"


def _digests(text: np.ndarray, found: np.ndarray, n: int) -> list[np.ndarray]:
    out = [np.zeros(n, np.uint64) for _ in range(2)]
    for k, d in enumerate(out):
        np.add.at(d, text, mixed(found * _ODD[k] + np.uint64(k + 1)))
    return [d.view(np.int64) for d in out]


def _sign(ranks, size: int, percent: int):
    """Size, digests, first shingles and point of each set. ranks: a broadcast of `cell_ranks`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of = ranks.value
        for batch in parts(batches):
            ids, rows, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            for start, end in slices(texts):
                n = end - start
                text, found = _sets(texts[start:end], size)
                total = np.bincount(text, minlength=n)
                place = rank_of[_cell(found, len(rank_of))].astype(np.uint64) << np.uint64(56) | mixed(found ^ _ODD[2]) >> np.uint64(8)
                by = np.lexsort((place, text))
                first = np.cumsum(total) - total
                wanted = first_shingles(total, percent)
                chosen = by[np.repeat(first, wanted) + np.arange(wanted.sum()) - np.repeat(np.cumsum(wanted) - wanted, wanted)]
                keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(wanted)]).astype(np.int32)), pa.array(place[chosen].view(np.int64)))
                group = (mixed(found + _ODD[0]) % np.uint64(GROUPS)).astype(np.int64)
                points = np.bincount(text * GROUPS + group, minlength=n * GROUPS).astype(np.int32)
                point = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * GROUPS), pa.array(points))
                fine = (mixed(found ^ _ODD[0]) % np.uint64(PARITIES)).astype(np.int64)
                odd = np.bincount(text * PARITIES + fine, minlength=n * PARITIES).astype(np.uint8) & 1
                bits = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * (PARITIES // 64)), pa.array(np.packbits(odd).view(np.int64)))
                cells = [ids.slice(start, n), rows.slice(start, n), pa.array(total), *map(pa.array, _digests(text, found, n)), keys, point, bits]
                yield pa.RecordBatch.from_arrays(cells, ["doc_id", "key", "n", "a", "b", "keys", "point", "bits"])

    return run


def _shingle_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            rows, texts = batch.column(0), batch.column(1).to_pylist()
            for start, end in slices(texts):
                text, found = _sets(texts[start:end], size)
                at = np.searchsorted(text, np.arange(end - start + 1))
                cells = pa.array([found[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.slice(start, end - start), cells], ["node", "shingles"])

    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, s, t = (batch.column(k) for k in range(4))
            keep = []
            for i in range(batch.num_rows):
                left, right = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (s, t))
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in (x, y)], ["x", "y"])

    return run


# ---------------------------------------------------------------- the tree


class CountTree:
    """R-tree over count vectors: nodes hold the largest coordinates and the range of sizes of what is below them.

    An entry is a set (its low and high size are equal) or a node of sets that were joined before.
    """

    def __init__(self, points: np.ndarray, low: np.ndarray, high: np.ndarray, fan_out: int = FAN_OUT):
        self.order = self._packed(points, low, fan_out)
        self.levels = [(points[self.order], low[self.order], high[self.order])]
        self.fan_out = fan_out
        while len(self.levels[-1][0]) > fan_out:
            upper, low, high = self.levels[-1]
            at = np.arange(0, len(upper), fan_out)
            self.levels.append((np.maximum.reduceat(upper, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))

    @staticmethod
    def _packed(points: np.ndarray, sizes: np.ndarray, fan_out: int) -> np.ndarray:
        """Points in the order of the leaves: halved along the coordinate (or size) of the greatest range, again and again."""
        axes, done, open_ = np.concatenate([points, sizes[:, None]], axis=1).astype(np.int64), [], [np.arange(len(points))]
        while open_:
            rows = open_.pop()
            if len(rows) <= fan_out:
                done.append(rows)
                continue
            axis = np.ptp(axes[rows], axis=0).argmax()
            # Whole nodes on the left, so that runs of fan_out are the leaves.
            middle = (len(rows) // 2 + fan_out - 1) // fan_out * fan_out
            rows = rows[np.argsort(axes[rows, axis], kind="stable")]
            open_ += [rows[middle:], rows[:middle]]
        return np.concatenate(done) if done else np.zeros(0, np.int64)

    def search(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
        """(query, entry) of all pairs that the bound leaves: of which some sets may share what similar ones need."""
        top = len(self.levels[-1][0])
        query, node = np.repeat(np.arange(len(queries)), top), np.tile(np.arange(top), len(queries))
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, least, most = self.levels[depth]
            # By sizes alone first: the bound is summed for what they leave.
            left = possible(np.inf, low[query], high[query], least[node], most[node], percent)
            query, node = query[left], node[left]
            shared = np.concatenate([np.minimum(queries[query[k : k + 20_000]], upper[node[k : k + 20_000]]).sum(axis=1) for k in range(0, len(query), 20_000)] or [np.zeros(0)])
            left = possible(shared, low[query], high[query], least[node], most[node], percent)
            query, node = query[left], node[left]
            if depth:
                children = node[:, None] * self.fan_out + np.arange(self.fan_out)
                there = children < len(self.levels[depth - 1][0])
                query, node = np.broadcast_to(query[:, None], children.shape)[there], children[there]
        return query, self.order[node]


_MEMBER = "struct<node:bigint,root:bigint,low:bigint,high:bigint,point:array<int>,every:array<bigint>,some:array<bigint>>"
#: What the bounds need of an entry.
_BOUNDS = ("low", "high", "point", "every", "some")


def _leaf(value: pa.StructArray) -> tuple[np.ndarray, ...]:
    lists = (value.field(k).flatten().to_numpy().reshape(-1, wide) for k, wide in (("point", GROUPS), ("every", PARITIES // 64), ("some", PARITIES // 64)))
    return *(value.field(k).to_numpy() for k in ("node", "root", "low", "high")), *lists


def _close(x: np.ndarray, y: np.ndarray, ours: tuple, theirs: tuple, percent: int) -> np.ndarray:
    """Of pairs of places (x, y) in entries (high, every, some), whether parities let them be similar."""
    found = [np.zeros(0, bool)]
    for k in range(0, len(x), 20_000):
        (high, every, some), (most, their_every, their_some) = ([c[at[k : k + 20_000]] for c in side] for at, side in ((x, ours), (y, theirs)))
        found.append(differing(every, some, their_every, their_some) <= allowed(high, most, percent))
    return np.concatenate(found)


def _searched(percent: int):
    """Pairs of nodes of two leaves that lie in different components and that the bound leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = [], []
            for left, right in zip(batch.column(0), batch.column(1), strict=True):
                node, root, low, high, points, *bits = _leaf(left.values)
                others, roots, least, most, theirs, *their_bits = _leaf(right.values)
                query, hit = CountTree(theirs, least, most).search(points, low, high, percent)
                apart = root[query] != roots[hit]
                query, hit = query[apart], hit[apart]
                close = _close(query, hit, (high, *bits), (most, *their_bits), percent)
                xs.append(node[query[close]])
                ys.append(others[hit[close]])
            x, y = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (xs, ys))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["x", "y"])

    return run


def _bounded(percent: int):
    """Of pairs of entries (x, y, then _BOUNDS of both) those that the bounds leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, a, b, c, d = (batch.column(k).to_numpy() for k in range(6))
            p, q = (batch.column(k).flatten().to_numpy().reshape(-1, GROUPS) for k in (6, 7))
            every, theirs, some, any_of_theirs = (batch.column(k).flatten().to_numpy().reshape(-1, PARITIES // 64) for k in range(8, 12))
            left = possible(np.minimum(p, q).sum(axis=1), a, c, b, d, percent) & (differing(every, some, theirs, any_of_theirs) <= allowed(c, d, percent))
            yield pa.RecordBatch.from_arrays([pa.array(x[left]), pa.array(y[left])], ["x", "y"])

    return run


# ---------------------------------------------------------------- the join


def link(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, cells: int = CELLS) -> tuple[DataFrame, DataFrame]:
    """(documents with their node, verified links between nodes).

    Documents: doc_id, n, row, node (null without words); nodes are the least rows of equal sets. Links: x, y; enough
    of the links of a component to connect it.
    """
    keyed, key = identified(docs)
    texts = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(key).alias("key"), text_or_empty().cast("binary").alias("text"))
    ranks = docs.sparkSession.sparkContext.broadcast(cell_ranks(texts, size, cells))
    signed = written(texts.mapInArrow(_sign(ranks, size, percent), _SIGNED).withColumn("row", F.monotonically_increasing_id()), "signed")
    nodes = written(signed.where("n > 0").groupBy("n", "a", "b").agg(F.min("row").alias("node")), "nodes")
    first = signed.join(nodes.select("node"), F.col("row") == F.col("node"), "left_semi").withColumnRenamed("row", "node")

    exploded = first.select("node", F.explode("keys").alias("shingle"))
    shared = exploded.groupBy("shingle").agg(F.count("*").alias("in_tree")).where("in_tree > 1")
    met = written(exploded.join(shared, "shingle"), "members")
    degrees = met.groupBy("node").agg(F.sum("in_tree").alias("degree"), F.count("*").alias("shared"))
    least = 1 + F.floor(F.ceil(percent * F.col("n") / 100) / SPARE)  # what the smallest similar set shares
    facts = written(first.select("node", "key", "n", "point", "bits").join(degrees, "node").where(F.col("shared") >= least).drop("shared"), "facts")

    def sets(of: DataFrame) -> DataFrame:
        """(node, shingles) of nodes, from their texts read again."""
        wanted = written(of.join(facts, "node").select("node", F.col("key.file").alias("file"), F.col("key.at").alias("at")), "wanted")
        some = texts.join(sized(wanted), (F.col("key.file") == F.col("file")) & (F.col("key.at") == F.col("at"))).select("node", "text")
        out = written(some.mapInArrow(_shingle_sets(size), "node long, shingles binary"), "sets")
        forget(wanted)
        return out

    def both(pairs: DataFrame, of: DataFrame, *columns: str) -> DataFrame:
        """x, y and the columns of x's, then of y's row in `of`."""
        side = lambda k: of.select(F.col("node").alias(k), *(F.col(c).alias(c + k) for c in columns))
        return pairs.join(side("x"), "x").join(side("y"), "y").select("x", "y", *(c + k for c in columns for k in "xy"))

    ends = lambda pairs: pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    lows = lambda df, a, b: df.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).distinct()

    # The node of each tree that meets others most often against all others.
    ranked = written(met.join(facts.select("node", "n", "degree"), "node").select("shingle", "node", "n", "degree"), "ranked")
    hubs = ranked.groupBy("shingle").agg(F.max_by(F.struct("node", "n"), F.struct("degree", (-F.col("node")).alias("low"))).alias("hub"))
    alike = (100 * F.least("n", "hub.n") >= percent * F.greatest("n", "hub.n")) & (F.col("node") != F.col("hub.node"))
    tried = written(lows(ranked.join(hubs, "shingle").where(alike), "node", "hub.node"), "tried")
    single = (F.col("n").alias("low"), F.col("n").alias("high"), "point", F.col("bits").alias("every"), F.col("bits").alias("some"))
    left = written(both(tried, facts.select("node", *single), *_BOUNDS).mapInArrow(_bounded(percent), "x long, y long"), "left")
    known = sets(ends(left))
    links = written(both(left, known, "shingles").mapInArrow(_verified(percent), "x long, y long"), "links")

    # Trees that hold several components yet: those outside the largest meet all others. A component is one entry, with
    # the largest coordinates of its sets: in trees of few entries pairs are listed, in others they are searched in
    # leaves. The sets of components that may be near are searched in leaves of their own.
    roots = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
    rooted = F.coalesce("root", "node").alias("root")
    members = written(facts.join(roots, "node", "left").select("node", rooted, "n", "point", "bits"), "rooted")
    each = lambda f, column, wide: F.array(*(f(F.get(column, F.lit(k))) for k in range(wide)))
    entries = members.groupBy("root").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("sets"), each(F.max, "point", GROUPS).alias("point"), each(F.bit_and, "bits", PARITIES // 64).alias("every"), each(F.bit_or, "bits", PARITIES // 64).alias("some"))
    entries = written(entries.withColumn("node", F.col("root")), "entries")
    counts = written(ranked.select("shingle", "node").join(roots, "node", "left").groupBy("shingle", rooted).agg(F.count("*").alias("members")), "counts")
    trees = counts.groupBy("shingle").agg(F.max_by("root", F.struct("members", "root")).alias("main"), F.sum("members").alias("all"), F.count("*").alias("roots")).where("roots > 1 AND all > 2")
    placed = written(counts.join(trees, "shingle").select("shingle", "root", (F.col("root") != F.col("main")).alias("minor"), "roots"), "trees")
    listed = F.collect_list(F.struct("node", "root", *_BOUNDS)).cast(f"array<{_MEMBER}>").alias("members")

    few = placed.where(F.col("roots") <= FEW).select("shingle", "root", "minor")
    others = few.select("shingle", F.col("root").alias("other"), F.col("minor").alias("also"))
    pairs = few.where("minor").join(others, "shingle").where("root <> other AND (NOT also OR other > root)").select(F.least("root", "other").alias("x"), F.greatest("root", "other").alias("y"))
    many = placed.where(F.col("roots") > FEW).select("shingle", "root", F.pmod(F.xxhash64("root"), F.ceil(F.col("roots") / LEAF)).alias("leaf"))
    packed = written(many.join(entries, "root").groupBy("shingle", "leaf").agg(listed), "leaves")
    facing = packed.select("shingle", F.col("leaf").alias("at"), F.col("members").alias("ours")).join(packed, "shingle").where("leaf >= at")
    close = written(pairs.unionByName(facing.select("ours", "members").mapInArrow(_searched(percent), "x long, y long")).distinct(), "close")
    near = written(both(close, entries, *_BOUNDS).mapInArrow(_bounded(percent), "x long, y long"), "near")
    wanted = ends(near).withColumnRenamed("node", "root").join(entries.select("root", "sets"), "root")
    own = members.join(wanted, "root").select("root", F.pmod(F.xxhash64("node"), F.ceil(F.col("sets") / LEAF)).alias("leaf"), "node", *single)
    # Dealt by both columns: a grouping after the join by root alone would leave a large component to one task.
    chunks = written(own.repartition("root", "leaf").groupBy("root", "leaf").agg(listed), "chunks")
    side = lambda k, name: chunks.select(F.col("root").alias(k), F.col("members").alias(name))
    meeting = near.join(side("x", "ours"), "x").join(side("y", "members"), "y").select("ours", "members")
    again = written(meeting.mapInArrow(_searched(percent), "x long, y long").distinct().join(tried, ["x", "y"], "left_anti"), "left")
    scratch = [members, entries, counts, placed, packed, close, near, chunks]
    asked = written(ends(again), "asked")
    known_too = sets(asked.join(known.select("node"), "node", "left_anti"))
    # Sets that no pair asks for stay where they are.
    known_asked = known.join(sized(asked), "node", "left_semi")
    more = written(both(again, known_asked.unionByName(known_too), "shingles").mapInArrow(_verified(percent), "x long, y long"), "links")
    forget(met, ranked, facts, tried, left, known, again, asked, known_too, *scratch)
    documents = signed.select("doc_id", "n", "a", "b", "row").join(nodes, ["n", "a", "b"], "left").select("doc_id", "n", "row", "node")
    return documents, links.unionByName(more)


def join(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, cells: int = CELLS) -> DataFrame:
    """doc_id, n_shingles (size of its set) and component_id (the least doc_id that links reach) of each document.

    Words are what `[\\x20\\x09-\\x0D]` parts, A-Z lower-cased; a text of fewer words than `size` has one shingle of all
    of them. Null, empty and blank texts have no shingles and are linked with nothing: their component_id is their own
    doc_id. Rows of equal texts, also with equal doc_ids, are linked. Null doc_ids count as no id: a component of them
    alone has a null id. No rows: none. Other columns are ignored.
    """
    documents, links = link(docs, percent, size, cells)
    roots = components(links.select(F.col("x").alias("a"), F.col("y").alias("b"))).withColumnRenamed("root", "component")
    placed = written(documents.join(roots, "node", "left").select("doc_id", "n", F.coalesce("component", "node").alias("component")), "placed")
    least = written(placed.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")).where("rows > 1").select("component", "least"), "components")
    found = placed.join(least.withColumn("found", F.lit(True)), "component", "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("found"), F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


#: DuckDB: shingles as strings, overlaps by an equality join, reachability by recursion.
ORACLE = """WITH RECURSIVE w AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS MATERIALIZED (SELECT DISTINCT r, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM w)),
    n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
    l AS MATERIALIZED (SELECT p.x, p.y FROM (SELECT a.r AS x, b.r AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY ALL) p
        JOIN n m ON m.r = p.x JOIN n k ON k.r = p.y WHERE 100 * o >= 80 * (m.n + k.n - o)),
    c AS (SELECT r AS x, r AS y FROM n UNION SELECT c.x, l.y FROM c JOIN l ON l.x = c.y)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.least, w.doc_id) AS component_id FROM w LEFT JOIN n ON n.r = w.r
    LEFT JOIN (SELECT c.x, min(d.doc_id) AS least FROM c JOIN w d ON d.r = c.y GROUP BY c.x) m ON m.x = w.r"""
