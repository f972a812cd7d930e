"""Exact k-means over integer vectors by Shallot search.

A vector carries its nearest and its second nearest centroid, an upper bound of its distance to the one and a lower
bound of its distances to all others. Moves of the centroids loosen the bounds; while the upper one lies below the
lower one, or below half the way to the next centroid, the vector stays without any distance. Else both remembered
centroids are measured, and the search starts from the closer: its neighbours are tried in order of their distance
from it, within a ball whose radius is the distance to the start and that to the second nearest so far, so it shrinks
as closer centroids are found. What is left is compared in integers, ties going to the smaller number.

A round is one pass over a table of vectors and bounds, which replaces that of the round before; each task also adds
up the vectors of its clusters. The driver holds k centroids and collects k * dims sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written

CLUSTERS, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, "3"
#: Components are below this in magnitude, so that squared distances are exact longs.
MOST = 1 << 25
#: Distances as floats are widened or narrowed by this share, far more than their rounding.
_SLACK = 1e-12

_STATE = "vec_id long, v binary, near int, second int, upper double, lower double, total array<long>, members long"
_FINAL = "vec_id long, cluster int, distance long"


def _up(x: np.ndarray) -> np.ndarray:
    return x * (1 + _SLACK)


def _down(x: np.ndarray) -> np.ndarray:
    return x * (1 - _SLACK)


class Centroids:
    """Centroids of one round, with what a search needs of them and how far each has come from the round before."""

    def __init__(self, at: np.ndarray, before: np.ndarray | None = None):
        self.at, k = at, len(at)
        apart = at[:, None, :] - at[None, :, :]
        self.gaps = np.sqrt((apart * apart).sum(axis=2).astype(np.float64))
        np.fill_diagonal(self.gaps, -1.0)
        self.order = np.argsort(self.gaps, axis=1, kind="stable")  # itself comes first
        self.half = _down(self.gaps[np.arange(k), self.order[:, 1]]) / 2 if k > 1 else np.full(k, np.inf)
        moved = np.zeros_like(at) if before is None else at - before
        self.drift = _up(np.sqrt((moved * moved).sum(axis=1).astype(np.float64)))
        far = np.argsort(self.drift)[::-1]
        #: The largest move of the centroids other than each.
        self.others = np.full(k, self.drift[far[0]])
        self.others[far[0]] = self.drift[far[1]] if k > 1 else 0.0

    def distance(self, x: np.ndarray, to: np.ndarray) -> np.ndarray:
        apart = x - self.at[to]
        return np.einsum("ij,ij->i", apart, apart)

    def search(self, x: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> None:
        """Brings the four arrays, which are of the round before, up to this round's centroids."""
        upper += self.drift[near]
        upper *= 1 + _SLACK
        lower -= self.others[near]
        if len(self.at) == 1:
            lower[:] = np.inf
        todo = np.flatnonzero(~(upper < np.maximum(lower, self.half[near])))
        first = self.distance(x[todo], near[todo])
        upper[todo] = _up(np.sqrt(first.astype(np.float64)))
        open_ = ~(upper[todo] < np.maximum(lower[todo], self.half[near[todo]]))
        todo, first = todo[open_], first[open_]
        if not len(todo) or len(self.at) == 1:
            return
        x, a, b, da = x[todo], near[todo], second[todo], first
        db = self.distance(x, b)
        closer = (db < da) | ((db == da) & (b < a))
        a, b, da, db = np.where(closer, b, a), np.where(closer, a, b), np.where(closer, db, da), np.where(closer, da, db)
        start, known, reach = a.copy(), b.copy(), _up(np.sqrt(da.astype(np.float64)))
        alive = np.arange(len(todo))
        for rank in range(1, len(self.at)):
            # The ball around the start: nothing beyond it can be nearer than the second nearest so far.
            radius = _up(reach[alive] + np.sqrt(db[alive].astype(np.float64)))
            alive = alive[self.gaps[start[alive], self.order[start[alive], rank]] <= radius]
            if not len(alive):
                break
            j = self.order[start[alive], rank]
            new = j != known[alive]
            rows, j = alive[new], j[new]
            dj = self.distance(x[rows], j)
            first = (dj < da[rows]) | ((dj == da[rows]) & (j < a[rows]))
            next_ = ~first & ((dj < db[rows]) | ((dj == db[rows]) & (j < b[rows])))
            b[rows] = np.where(first, a[rows], np.where(next_, j, b[rows]))
            db[rows] = np.where(first, da[rows], np.where(next_, dj, db[rows]))
            a[rows], da[rows] = np.where(first, j, a[rows]), np.where(first, dj, da[rows])
        near[todo], second[todo] = a, b
        upper[todo], lower[todo] = _up(np.sqrt(da.astype(np.float64))), _down(np.sqrt(db.astype(np.float64)))


def _state(ids: pa.Array, v: pa.Array, near, second, upper, lower) -> pa.RecordBatch:
    n = len(ids)
    cells = [ids, v, *(pa.array(x.astype(np.int32)) for x in (near, second)), pa.array(upper), pa.array(lower), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64())]
    return pa.RecordBatch.from_arrays(cells, ["vec_id", "v", "near", "second", "upper", "lower", "total", "members"])


def _packed(dims: int, clusters: int):
    """Integer vectors as bytes, with bounds that say nothing yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, dims)
            if n and np.abs(x).max() >= MOST:
                raise ValueError(f"a scaled component reaches {MOST}; squared distances would not be exact")
            v = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * dims), n, [None, pa.py_buffer(np.ascontiguousarray(x, np.int32))]).cast(pa.binary())
            yield _state(batch.column(0), v, np.zeros(n), np.full(n, min(1, clusters - 1)), np.full(n, np.inf), np.zeros(n))

    return run


def _read(batch: pa.RecordBatch, dims: int):
    n, by = batch.num_rows, batch.schema.get_field_index
    v = batch.column(by("v"))
    x = np.frombuffer(b"".join(v.to_pylist()), np.int32).reshape(n, dims).astype(np.int64)
    near, second = (batch.column(by(c)).to_numpy().astype(np.int64) for c in ("near", "second"))
    upper, lower = (batch.column(by(c)).to_numpy().copy() for c in ("upper", "lower"))
    return batch.column(by("vec_id")), v, x, near, second, upper, lower


def _assign(centroids: Centroids):
    """The state after a search, and after the vectors one row for each cluster with the sum of the task's members."""
    k, dims = centroids.at.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, members = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            ids, v, x, near, second, upper, lower = _read(batch, dims)
            centroids.search(x, near, second, upper, lower)
            for j in range(k):
                total[j] += x[near == j].sum(axis=0)
            members += np.bincount(near, minlength=k)
            yield _state(ids, v, near, second, upper, lower)
        full = np.flatnonzero(members)
        nothing = [pa.nulls(len(full), t) for t in (pa.int64(), pa.binary(), pa.int32(), pa.float64(), pa.float64())]
        sums = pa.array(total[full].tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([nothing[0], nothing[1], pa.array(full.astype(np.int32)), *nothing[2:], sums, pa.array(members[full])], ["vec_id", "v", "near", "second", "upper", "lower", "total", "members"])

    return run


def _finished(centroids: Centroids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, _, x, near, second, upper, lower = _read(batch, centroids.at.shape[1])
            centroids.search(x, near, second, upper, lower)
            yield pa.RecordBatch.from_arrays([ids, pa.array(near.astype(np.int32)), pa.array(centroids.distance(x, near))], ["vec_id", "cluster", "distance"])

    return run


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of each cluster that has members; the others stay."""
    sums = state.where("members IS NOT NULL").select("near", "members", F.posexplode("total").alias("dim", "x"))
    rows = sums.groupBy("near", "dim").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("members").alias("n")).collect()
    out = centroids.copy()
    for r in rows:
        out[r.near, r.dim] = int(r.x) // r.n
    return out


def whole(vectors: DataFrame, dims: int = DIMS, scale: float = SCALE) -> DataFrame:
    """(vec_id, v array<long>): floor(scale * x) of the vectors with exactly dims components, none null or non-finite."""
    usable = (F.size("embedding") == dims) & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    integers = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    return vectors.where(F.col("embedding").isNotNull() & usable).select(F.col("vec_id").cast("long").alias("vec_id"), integers.alias("v"))


def assigned(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of each vector of `whole`, final centroids).

    Centroids start as the vectors with the least sha256 of seed:vec_id (null vec_ids last, ties by the components);
    fewer vectors than clusters make fewer clusters. Rounds after which nothing moves change nothing and are skipped.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(digest.asc_nulls_last(), "v").limit(clusters).collect()
    if not first:
        return vectors.sparkSession.createDataFrame([], _FINAL), np.zeros((0, 0), np.int64)
    at = np.array([r.v for r in first], np.int64)
    if np.abs(at).max() >= MOST:
        raise ValueError(f"a scaled component reaches {MOST}; squared distances would not be exact")
    state, centroids, scratch = vectors.mapInArrow(_packed(at.shape[1], len(at)), _STATE), Centroids(at), None
    for _ in range(rounds):
        state = written(state.where("members IS NULL").mapInArrow(_assign(centroids), _STATE), "bounds")
        if scratch is not None:
            forget(scratch)
        scratch = state
        centroids = Centroids(_means(state, centroids.at), centroids.at)
        if not centroids.drift.any():
            break
    out = written(state.where("members IS NULL").mapInArrow(_finished(centroids), _FINAL), "assigned")
    if scratch is not None:
        forget(scratch)
    return out, centroids.at


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: float = SCALE, seed: str = SEED) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of each usable vector.

    Vectors of another length, null ones and those with null or non-finite components are left out; rows with a null
    or repeated vec_id are vectors like others. Equal vectors share a cluster. No vectors: no rows. Other columns are
    ignored.
    """
    rows, centroids = assigned(whole(vectors, dims, scale), clusters, rounds, seed)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    sums = {r.cluster: r.d for r in rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    by_number = lambda values, kind: F.element_at(F.array(*(F.lit(x).cast(kind) for x in values)), F.col("cluster") + 1) if values else F.lit(None).cast(kind)
    return rows.select(
        "vec_id",
        "cluster",
        "distance",
        by_number([sums.get(k, 0) for k in range(len(digests))], "long").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        by_number(digests, "string").alias("centroid_sha256"),
    )


def _oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: str = SEED) -> str:
    """DuckDB SQL for `cluster`: one assignment and one update for each round."""
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 AS j, v AS c FROM v ORDER BY j LIMIT {clusters})""",
    ]
    square = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for k in range(rounds + 1):
        parts.append(f"""a{k} AS MATERIALIZED (SELECT r, vec_id, v, j, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, j) AS place
        FROM (SELECT r, vec_id, v, j, CAST({square} AS BIGINT) AS d FROM v CROSS JOIN c{k})) WHERE place = 1)""")
        if k < rounds:
            parts.append(f"""c{k + 1} AS MATERIALIZED (SELECT c{k}.j, coalesce(m.c, c{k}.c) AS c FROM c{k} LEFT JOIN (SELECT j, list(x ORDER BY i) AS c
        FROM (SELECT j, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x FROM (SELECT j, unnest(v) AS x, unnest(range({dims})) AS i FROM a{k}) GROUP BY j, i) GROUP BY j) m ON m.j = c{k}.j)""")
    return f"""WITH {", ".join(parts)} SELECT vec_id, CAST(a.j AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
        CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON a.j = c.j"""


ORACLE = _oracle()
