"""Periodic runs and Shallot search against brute force, and on awkward rows."""

import hashlib
import math
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from packloom.llm import clustering, periodic_runs
from packloom.llm.common import table
from packloom.llm.queries import op11_periodic_runs, op12_shallot

from ..conftest import SF

# ---------------------------------------------------------------- periodic runs


def all_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(24, 3 * q):
                found.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def left_of(words, found):
    kept = [True] * len(words)
    for s, n, q in found:
        kept[s + q : s + n] = [False] * (n - q)
    return [w for w, k in zip(words, kept, strict=True) if k]


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 9)), max_size=6), st.lists(st.integers(0, 3), max_size=30))
@settings(max_examples=300, deadline=None)
def test_runs_equal_brute_force(repeated, tail):
    words = [w for part, times in repeated for w in part * times] + tail
    assert periodic_runs.runs(np.array(words, np.int64)) == all_runs(words)


@pytest.mark.parametrize("length", [1, 5, 16, 100])
def test_transform_gives_squared_differences(length):
    rng = np.random.default_rng(length)
    blocks, windows = rng.integers(0, 1000, (3, length)), rng.integers(0, 1000, (3, 2 * length + 7))
    want = [[((b - w[k : k + length]) ** 2).sum() for k in range(length + 8)] for b, w in zip(blocks, windows, strict=True)]
    assert (periodic_runs.squared_differences(blocks, windows) == want).all()


def test_zeros_modulo_the_prime_alone_are_no_runs():
    """1**2 + root**2 is 0 modulo the prime: a block and its copy differ in two words, which the sum doesn't show."""
    root = pow(periodic_runs.ROOT, (periodic_runs.PRIME - 1) // 4, periodic_runs.PRIME)
    block = np.array([[5, root + 5, 7, 8]])
    other = np.array([[6, 5, 7, 8]])
    assert (periodic_runs.squared_differences(block, other) == 0).all()
    words = np.array([5, root + 5, *range(10, 16), 6, 5, *range(10, 16)] * 2 + [1] * 40)
    assert periodic_runs.runs(words) == all_runs(words.tolist())


def test_long_texts_stay_quick():
    for q in (1, 7, 66_666):
        assert periodic_runs.runs(np.arange(200_000) % q) == [(0, 200_000, q)]


def contract(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = all_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(left_of(words, found)).encode()).hexdigest())


def test_query_of_runs_equals_brute_force(spark):
    small = table(spark, SF, "documents").where("n_chars < 6000")
    want = [contract(r.doc_id, r.text) for r in small.collect()]
    rows = periodic_runs.digests(small).collect()
    assert sorted(map(tuple, rows)) == sorted(want) and any(r.n_runs for r in rows)
    assert op11_periodic_runs(spark, SF).count() == table(spark, SF, "documents").count()


def test_runs_of_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(50_000)) + " x y z" * 30
    rows = [(None, "a b c " * 12, 1), (1, None, 1), (2, "", 1), (3, " \t\n", 1), (4, "a b \x1c " * 30, 1), (4, "a b \x1c " * 30, 1), (5, long, 1), (6, "only", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, RUNS int")
    got = {(r.doc_id, r.n_words): r for r in periodic_runs.find(docs).collect()}
    assert [tuple(x) for x in got[None, 36].runs] == [(0, 36, 3)] and got[None, 36].collapsed == "a b c"
    assert [tuple(x) for x in got[5, 50_090].runs] == [(50_000, 90, 3)]
    assert [tuple(x) for x in got[4, 60].runs] == [(0, 60, 2)] and got[4, 60].collapsed == "a b \x1c"
    assert all(got[k, 0].runs == [] and got[k, 0].collapsed == "" for k in (1, 2, 3))
    assert len(got) == 7 and periodic_runs.find(docs).count() == 8
    assert sorted(map(tuple, periodic_runs.digests(docs.where("doc_id < 4 OR doc_id = 6")).collect())) == sorted(contract(d, t) for d, t, _ in rows if d in (1, 2, 3, 6))
    assert periodic_runs.digests(docs.where("doc_id < 0")).collect() == []


# ---------------------------------------------------------------- Shallot search


def plain_kmeans(vectors, k, rounds, dims, scale, seed="3"):
    """(vec_id, vector) pairs: rows of the contract, all distances in plain integers."""
    kept = [(d, [math.floor(scale * float(x)) for x in v]) for d, v in vectors if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    at = [v for _, v in first]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [min((square(v, c), j) for j, c in enumerate(at))[::-1] for _, v in kept]
    for _ in range(rounds):
        found = assign()
        for j in range(len(at)):
            if own := [v for (_, v), (c, _) in zip(kept, found, strict=True) if c == j]:
                at[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = assign()
    inertia = [sum(d for c, d in found if c == j) for j in range(len(at))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (c, d) in zip(kept, found, strict=True)), key=repr)


@pytest.mark.parametrize(("k", "dims", "values"), [(8, 3, 4), (5, 2, 2), (12, 4, 50), (1, 3, 9)])
def test_clusters_equal_plain_integers(spark, k, dims, values):
    """Small grids: ties and coinciding centroids abound."""
    rng = np.random.default_rng(k)
    rows = [(int(i), [float(x) / 8 for x in rng.integers(-values, values + 1, dims)]) for i in range(300)]
    got = clustering.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), clusters=k, rounds=6, dims=dims, scale=8)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_kmeans(rows, k, 6, dims, 8)


def test_bounds_spare_distances():
    rng = np.random.default_rng(1)
    middles = rng.integers(-4000, 4000, (40, 8))
    x = middles[rng.integers(0, 40, 5000)] + rng.integers(-100, 100, (5000, 8))
    near, second, upper, lower = np.zeros(5000, int), np.ones(5000, int), np.full(5000, np.inf), np.zeros(5000)
    measured = []
    now, before = middles, None
    for step in range(4):
        centroids = clustering.Centroids(now, before)
        plain, count = centroids.distance, []
        centroids.distance = lambda rows, to, plain=plain, count=count: count.append(len(rows)) or plain(rows, to)
        centroids.search(x, near, second, upper, lower)
        exact = ((x[:, None, :] - now[None, :, :]) ** 2).sum(axis=2)
        assert (near == exact.argmin(axis=1)).all()
        assert (upper**2 >= exact[np.arange(5000), near]).all() and (lower**2 <= np.partition(exact, 1, axis=1)[:, 1] * (1 + 1e-9)).all()
        measured.append(sum(count))
        before, now = now, now + rng.integers(-3 + step, 4 - step, now.shape)
    assert measured[0] <= 5000 * 42 and max(measured[1:]) < 0.1 * 5000 * 40


def test_clusters_of_odd_rows(spark):
    good = [(int(i), [float((i * 7 + j) % 5) for j in range(4)]) for i in range(20)]
    rows = [*good, (3, good[3][1]), (None, [1.0, 2.0, 3.0, 4.0]), (30, None), (31, [1.0] * 3), (32, [1.0, None, 1.0, 1.0]), (33, [1.0, float("nan"), 1.0, 1.0]), (34, [float("-inf")] * 4), (35, [])]
    vectors = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, near int, V int")
    got = sorted(map(tuple, clustering.cluster(vectors, dims=4, rounds=3).collect()), key=repr)
    assert got == plain_kmeans(rows, 8, 3, 4, 1024) and len(got) == 22
    assert clustering.cluster(vectors.where("vec_id < 0"), dims=4).collect() == []
    few = clustering.cluster(vectors.where("vec_id < 3"), dims=4, rounds=2).collect()
    assert sorted(map(tuple, few), key=repr) == plain_kmeans(rows[:3], 8, 2, 4, 1024)
    with pytest.raises(Exception, match="squared distances would not be exact"):
        clustering.cluster(spark.createDataFrame([(1, [1e9] * 4)], "vec_id long, embedding array<float>"), dims=4).collect()


def test_query_of_clusters_equals_plain_integers(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    assert sorted(map(tuple, op12_shallot(spark, SF).collect()), key=repr) == plain_kmeans(rows, 8, 10, 64, 1024)
