"""The exact Jaccard join against brute force, and on awkward rows."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from packloom.llm import jaccard_join
from packloom.llm.common import table
from packloom.llm.queries import op13_jaccard_join

from ..conftest import SF


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))}


def brute(rows, percent=80):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows, all pairs compared."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("percent", [80, 50, 93])
def test_prefixes_of_similar_sets_meet(percent):
    """In any common order, the first shingles of two similar sets have one in common."""
    rng = np.random.default_rng(percent)
    for _ in range(2000):
        n, cut, more = rng.integers(1, 60), rng.integers(0, 8), rng.integers(0, 8)
        order = rng.permutation(200)
        x, y = set(order[:n]), set(order[min(cut, n - 1) : n]) | set(order[100 : 100 + more])
        both = len(x & y)
        assert (both >= jaccard_join.needed(len(x), len(y), percent)) == (100 * both >= percent * len(x | y))
        if x != y and 100 * both >= percent * len(x | y):
            front = [set(sorted(s)[: int(jaccard_join.first_shingles(np.array(len(s)), percent))]) for s in (x, y)]
            assert len(front[0] & front[1]) > jaccard_join.spare(min(len(x), len(y)))


@given(st.integers(0, 70), st.integers(0, 2**31), st.integers(2, 9))
@settings(max_examples=100, deadline=None)
def test_tree_leaves_all_pairs_within_the_bound(n, seed, fan_out):
    rng = np.random.default_rng(seed)
    points = rng.poisson(rng.choice([0.2, 1, 6]), (n, 6)).astype(np.uint32)
    points[: n // 2] += rng.poisson(5, 6).astype(np.uint32)
    sizes = points.sum(axis=1).astype(np.int64)
    query, hit = jaccard_join.CountTree(points, sizes, sizes, fan_out).search(points, sizes, sizes) if n else (np.zeros(0, int),) * 2
    bound = np.minimum(points[:, None], points[None]).sum(axis=2)
    m, k = sizes[:, None], sizes[None]
    want = (bound >= jaccard_join.needed(m, k)) & (100 * np.minimum(m, k) >= 80 * np.maximum(m, k))
    assert set(zip(query.tolist(), hit.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(want)), strict=True))


def test_tree_visits_few_nodes_of_clustered_points():
    rng = np.random.default_rng(0)
    middles = rng.poisson(6, (50, jaccard_join.GROUPS))
    points = (middles[np.arange(2000) % 50] + rng.integers(0, 2, (2000, jaccard_join.GROUPS))).astype(np.uint32)
    sizes = points.sum(axis=1).astype(np.int64)
    tree = jaccard_join.CountTree(points, sizes, sizes)
    assert len(tree.levels) == 4 and sorted(tree.order.tolist()) == list(range(2000))
    query, hit = tree.search(points[:50], sizes[:50], sizes[:50])
    assert (query % 50 == hit % 50).all() and len(query) == 50 * 40


def test_bounds_of_joined_entries_hold_for_their_sets():
    rng = np.random.default_rng(2)
    points = rng.poisson(0.5, (60, 24)) + rng.poisson(8, (12, 24)).repeat(5, axis=0)
    sizes = points.sum(axis=1)
    groups = points.reshape(12, 5, 24)
    upper, low, high = groups.max(axis=1), sizes.reshape(12, 5).min(axis=1), sizes.reshape(12, 5).max(axis=1)
    query, hit = jaccard_join.CountTree(upper, low, high, 2).search(upper, low, high)
    left = set(zip(query.tolist(), hit.tolist(), strict=True))
    assert len(left) < 144
    query, hit = jaccard_join.CountTree(points, sizes, sizes).search(points, sizes, sizes)
    assert {(q // 5, h // 5) for q, h in zip(query.tolist(), hit.tolist(), strict=True)} <= left


def words_of(rng, n, names="w"):
    return [f"{names}{x}" for x in rng.integers(0, 10**6, n)]


def test_join_equals_brute_force_on_made_up_groups(spark):
    """Near copies in a chain and around a middle, passages that many share, sizes at the threshold."""
    rng = np.random.default_rng(7)
    rows, passage = [], words_of(rng, 60, "p")
    chain = words_of(rng, 90)
    for k in range(12):
        rows.append((500 - k, " ".join(chain)))
        chain = [*chain[4:], *words_of(rng, 4)]
    middle = words_of(rng, 120)
    for k in range(60):
        other = list(middle)
        for at in rng.integers(0, 120, 1 + k % 2):
            other[at] = f"x{k}"
        rows.append((1000 + k, " ".join(other)))
    for k in range(150):
        own = words_of(rng, int(rng.integers(4, 90)), f"o{k % 40}_" if k % 3 else "o")
        rows.append((2000 + k, " ".join([*own, *passage])))
    small = "a b c d e f g h i"
    rows += [(3000, small), (3001, small.upper()), (3002, small[:-2]), (3003, small[2:]), (3004, "a b c d e f g h"), (3005, "A\tb c\nD e"), (3006, "a b c d")]
    want = brute(rows)
    assert len({r[2] for r in want}) < len(rows) - 60
    assert found(jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))) == want
    # A sketch of a single cell orders shingles by chance alone; results stay.
    assert found(jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"), cells=1)) == want


def test_small_leaves_meet_in_pairs(spark, monkeypatch):
    rng = np.random.default_rng(3)
    line = words_of(rng, 30, "l")
    rows = [(k, " ".join([*line, *words_of(rng, 5, f"d{k // 2}_")[: 3 + k % 2]])) for k in range(60)]
    monkeypatch.setattr(jaccard_join, "LEAF", 4)
    monkeypatch.setattr(jaccard_join, "FEW", 3)
    assert found(jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"), percent=90)) == brute(rows, 90)


def test_join_of_odd_rows(spark):
    long = " ".join(f"w{k % 977}x{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (3, " \t\n"), (None, "one two three"), (5, "ONE two three"), (5, "one two three"), (6, long), (7, long + " tail"), (None, "lonely text"), (None, "Lonely text"), (9, "ünïcödé Ünïcödé"), (10, "ünïcödé ünïcödé"), (11, "a b c"), (12, "a b c")]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, node long, KEY int, n int")
    assert found(jaccard_join.join(docs)) == brute(rows)
    assert jaccard_join.join(docs.where("doc_id < 0")).collect() == []
    assert found(jaccard_join.join(docs.where("doc_id = 1"))) == [(1, 0, 1)]


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert found(op13_jaccard_join(spark, SF)) == brute(rows)


@pytest.mark.parametrize("percent", [80, 50, 93])
def test_parities_leave_all_similar_sets(percent):
    """Of sets and of entries of several, made of few or many shingles."""
    rng = np.random.default_rng(percent)
    sets, bits = [], []
    for k in range(120):
        new = set(rng.integers(0, 10**9, rng.integers(1, 2500)).tolist())
        base = sets[rng.integers(0, k)] if k else new
        cut = set(rng.permutation(sorted(base))[: rng.integers(0, len(base) // 4 + 1)].tolist())
        sets.append(new if k % 4 == 0 else (base - cut) | set(sorted(new)[: len(base) // 12]))
        odd = np.bincount(np.array(sorted(sets[-1])) % jaccard_join.PARITIES, minlength=jaccard_join.PARITIES).astype(np.uint8) & 1
        bits.append(np.packbits(odd).view(np.int64))
    bits, n = np.array(bits), np.array([len(s) for s in sets])
    x, y = np.triu_indices(len(sets), 1)
    both = np.array([len(sets[i] & sets[j]) for i, j in zip(x, y, strict=True)])
    similar = 100 * both >= percent * (n[x] + n[y] - both)
    left = jaccard_join.differing(bits[x], bits[x], bits[y], bits[y]) <= jaccard_join.allowed(n[x], n[y], percent)
    assert similar.any() and left[similar].all() and left.sum() < len(x)
    flipped = np.unpackbits((bits[:1] ^ bits[1:2]).view(np.uint8)).sum()
    assert jaccard_join.differing(bits[:1], bits[:1], bits[1:2], bits[1:2])[0] == flipped
    of = np.arange(len(sets)) // 3
    every, some, high = np.bitwise_and.reduceat(bits, np.arange(0, 120, 3)), np.bitwise_or.reduceat(bits, np.arange(0, 120, 3)), np.maximum.reduceat(n, np.arange(0, 120, 3))
    p, q = of[x], of[y]
    assert (jaccard_join.differing(every[p], some[p], every[q], some[q]) <= jaccard_join.allowed(high[p], high[q], percent))[similar].all()


def test_unlike_sets_of_a_common_passage_are_not_verified(spark, monkeypatch):
    """Large sets fill all groups alike, so that counts alone leave every pair of them."""
    rng = np.random.default_rng(11)
    passage, rows, pairs = words_of(rng, 300, "p"), [], []
    for k in range(60):
        rows.append((k, " ".join([*passage, *words_of(rng, 900, f"d{k}_")])))
    rows += [(100 + k, rows[k][1] + " one more") for k in range(0, 60, 7)]
    keep = jaccard_join.written

    def counted(df, name):
        out = keep(df, name)
        if name == "left":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "written", counted)
    assert found(jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert sum(pairs) <= 9
