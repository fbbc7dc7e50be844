"""Cover trees and hard negatives: invariants, brute force, SQL over the whole table."""

import numpy as np
import pytest

import __spark_entry__ as contract
from siftline.llm import negatives
from siftline.llm.covertree import LEAST, MOST, Best, CoverTree
from tests.oracle import connect, spark_rows, sql_rows


def clustered(n, dim, seed=1, spread=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 60, (25, dim))
    return np.round(centres[rng.integers(0, 25, n)] + rng.normal(0, spread, (n, dim))).astype(np.int64)


def tree_of(x, labels=None):
    return CoverTree.built(x, np.arange(len(x)), np.zeros(len(x), np.int64) if labels is None else labels)


@pytest.mark.parametrize("n, dim", [(1, 3), (40, 2), (500, 8), (300, 64)])
def test_every_point_is_covered(n, dim):
    tree = tree_of(clustered(n, dim))
    assert sorted(tree.ids.tolist()) == list(range(n))
    length = np.sqrt((tree.x**2).sum(1).max())
    y = np.hstack((tree.x, np.sqrt(np.maximum(length**2 - (tree.x**2).sum(1), 0))[:, None])) / length
    for i in range(len(tree.centre)):
        a, b = tree.start[i], tree.stop[i]
        assert a <= tree.centre[i] < b
        angles = np.arccos(np.clip(y[a:b] @ y[tree.centre[i]], -1, 1))
        assert angles.max() <= tree.radius[i]
        children = range(tree.first[i], tree.last[i])
        if children:
            assert [tree.start[c] for c in children] + [b] == [a] + [tree.stop[c] for c in children]
            assert max(tree.radius[c] for c in children) < tree.radius[i]


@pytest.mark.parametrize("spread", [1, 6, 40])
def test_windows_equal_brute_force(spread):
    x = clustered(1500, 24, spread=spread)
    tree = tree_of(x)
    for q in range(0, 1500, 100):
        scores = x @ x[q]
        best = int(np.sort(scores)[-2])
        windows = [(LEAST, MOST), (best // 3, best * 9 // 10), (best, best - 1), (0, 50)]
        found = Best(*map(list, zip(*windows, strict=True)), 5)
        tree.search(x[q], found, lambda i, l, own=q: i != own)
        for (low, high), (s, i) in zip(windows, found.found, strict=True):
            expected = sorted((-int(v), j) for j, v in enumerate(scores) if j != q and low <= v <= high)[:5]
            assert list(zip((-s).tolist(), i.tolist(), strict=True)) == expected


def test_windows_skip_what_lies_outside():
    x = clustered(2000, 24)
    tree = tree_of(x)
    for q in range(0, 2000, 50):
        best = int((x @ x[q]).max())
        tree.search(x[q], Best([best * 3 // 10], [best * 9 // 10], 10), lambda i, l: i >= 0)
    assert tree.compared < 0.4 * 40 * 2000


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_matches_sql(spark, sf):
    df = contract.queries()["op13_hard_negatives"](spark, f"/root/testdata/sf{sf}")
    names, expected = sql_rows(connect(f"/root/testdata/sf{sf}"), contract.oracle_sql()["op13_hard_negatives"])
    assert sorted(df.columns) == names and spark_rows(df) == expected


def brute(rows, is_anchor, positives=5, k=10):
    out, asked = [], {}
    for i, label, v in sorted(rows):
        if is_anchor(i):
            asked.setdefault(i, (label, v))
    for a, (label, v) in asked.items():
        products = [(max(min(sum(p * q for p, q in zip(v, w, strict=False)), MOST), LEAST), i, l) for i, l, w in rows]
        scored = [(-s, i, l) for s, i, l in products]
        near = sorted((s, i) for s, i, l in scored if l == label and i != a)[:positives]
        for s, p in near:
            inside = sorted((t, i) for t, i, l in scored if l != label and 30 * -s <= 100 * -t <= 90 * -s)[:k]
            out += [(a, p, r, i, -s, -t) for r, (t, i) in enumerate(inside, 1)]
    return sorted(out)


def test_many_trees_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TREE_ROWS", 40)
    monkeypatch.setattr(negatives, "BLOCK", 7)
    monkeypatch.setattr(negatives, "PASS", 2)
    x = clustered(600, 6, spread=20).tolist()
    rows = [(i, i * i % 7 if i % 3 else 1, v) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, label long, v array<long>")
    found = negatives.mine(df, negatives.F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda i: i % 20 == 0)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 0, 5), (1, [1.0, 1.0], 0, 5), (2, [0.5, 0.0], 1, 5), (3, [0.5, 0.0], 1, 5), (3, [0.5, 0.0], 1, 5), (4, [0.25], 2, 5),
        (5, None, 0, 5), (6, [nan, 0.0], 0, 5), (7, [inf], 0, 5), (8, [None, 1.0], 0, 5), (9, [1.0, 0.0], None, 5), (None, [1.0, 0.0], 1, 5),
        (100, [-0.5, 0.25], 0, 5), (100, [2.0, 0.0], 1, 5), (200, [], 1, 5), (300, [1.0, 1.0], 9, 5), (10, [1e30, 0.0], 3, 5),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, rank int")
    vectors = negatives.quantized(df, "vec_id", "embedding", negatives.F.col("label"))
    plain = [(r.vec_id, r.label, r.v) for r in vectors.collect()]
    assert len(plain) == 11
    found = negatives.mine(vectors, negatives.F.col("vec_id") % 100 == 0)
    expected = brute(plain, lambda i: i % 100 == 0)
    assert sorted(map(tuple, found.collect())) == expected and expected
    none = negatives.quantized(df.limit(0), "vec_id", "embedding", negatives.F.col("label"))
    assert negatives.mine(none, negatives.F.col("vec_id") % 100 == 0).count() == 0
    assert negatives.mine(vectors, negatives.F.lit(False)).count() == 0


def test_products_beyond_64_bits_are_held(spark):
    rows = [(0, 0, [2**62, 2**62]), (1, 0, [2**61, 2**61]), (2, 1, [2**62, 0]), (3, 1, [0, 1]), (4, 1, [1, 1])]
    df = spark.createDataFrame(rows, "vec_id long, label long, v array<long>")
    found = negatives.mine(df, negatives.F.col("vec_id") == 0).collect()
    # The positive's score is held at 2**63 - 1; windows are those of held scores.
    assert [(r.positive_score, r.negative_id, r.negative_score) for r in found] == [(2**63 - 1, 3, 2**62)]
