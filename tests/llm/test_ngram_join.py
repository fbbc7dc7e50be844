"""N-gram join: SQL over the whole table, links of near groups pair by pair, components."""

from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as contract
from siftline.llm import ngram_join
from siftline.llm.graph import components
from tests.oracle import connect, spark_rows, sql_rows


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_matches_sql(spark, sf):
    df = contract.queries()["op1_ngram_join"](spark, f"/root/testdata/sf{sf}")
    names, expected = sql_rows(connect(f"/root/testdata/sf{sf}"), contract.oracle_sql()["op1_ngram_join"])
    assert sorted(df.columns) == names and spark_rows(df) == expected


def test_banding_reaches_its_recall():
    bands, rows = ngram_join.banding(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= ngram_join.MAX_PERMUTATIONS
    with pytest.raises(ValueError):
        ngram_join.banding(0.1, 0.9999, 8)


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    sets = {}
    for doc, text in texts.items():
        sets.setdefault(frozenset(shingles(text)), []).append(doc)
    keys = [k for k in sets if k]
    near = {k: [o for o in keys if o != k and 10 * len(k & o) >= 8 * len(k | o)] for k in keys}
    out = {}
    for k in keys:
        seen, todo = {k}, [k]
        while todo:
            for o in near[todo.pop()]:
                if o not in seen:
                    seen.add(o)
                    todo.append(o)
        first = min(d for s in seen for d in sets[s])
        out |= {d: (first, min(sets[k]), len(near[k])) for d in sets[k]}
    return {d: out.get(d, (d, d, 0)) for d in texts}


def test_large_near_group_in_blocks(spark):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(150):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 5)):
            words[at] = f"x{rng.integers(0, 9)}"
        texts[i] = " ".join(words)
    texts |= {1000 + i: f"alone {i} with words that nobody else has {i * 7}" for i in range(20)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for block in (16, 512):
        rows = {r.doc_id: (r.class_id, r.copy_of, r.n_links) for r in ngram_join.join(docs, block_nodes=block).collect()}
        assert rows == brute(texts)


def test_sides_count_only_across():
    sets = [np.arange(10, dtype=np.uint64), np.arange(9, dtype=np.uint64), np.arange(10, dtype=np.uint64) + np.uint64(50)]
    bands = np.zeros((3, 2), np.int64)
    assert ngram_join.links_between([1, 2, 3], bands, sets, [0, 0, 0], Fraction(4, 5))[0].tolist() == [1, 1, 0]
    assert ngram_join.links_between([1, 2, 3], bands, sets, [1, 1, 2], Fraction(4, 5))[0].tolist() == [0, 0, 0]
    assert ngram_join.links_between([1, 2], bands[:2], sets[:2], [1, 1], Fraction(4, 5))[0].tolist() == [0, 0]
    assert ngram_join.links_between([1, 2, 3], bands, sets, [1, 2, 2], Fraction(4, 5))[1] == [(1, 2)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 50), (50, 100), (7, 7), (60, 50), (200, 201), (203, 202), (201, 203)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {i: 1 for i in range(1, 31)} | {50: 50, 60: 50, 100: 50} | {i: 200 for i in range(200, 204)}
    assert components(df.limit(0)).count() == 0


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (3, " \n", 0), (4, "one two", 0), (5, "one  two", 0), (6, long, 0), (7, long + " end", 0), (7, long + " end", 0),
         (None, long, 0), (9, "two one", 0)],
        "doc_id long, text string, class_id int",
    )
    rows = sorted((-1 if r.doc_id is None else r.doc_id, r.class_id, r.copy_of, r.n_links) for r in ngram_join.join(docs).collect())
    assert rows == [
        (-1, 6, 6, 1), (1, 1, 1, 0), (2, 2, 2, 0), (3, 3, 3, 0), (4, 4, 4, 0), (5, 4, 4, 0), (6, 6, 6, 1), (7, 6, 7, 1), (7, 6, 7, 1), (9, 9, 9, 0),
    ]
    stay = ngram_join.one_of_each(docs)
    assert stay.columns == docs.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in stay.collect()) == [-1, 1, 2, 3, 4, 6, 9]
    assert ngram_join.join(docs.limit(0)).count() == 0


def test_one_id_on_two_texts_loses_no_class(spark):
    one, two = (" ".join(f"{w}{i}" for i in range(60)) for w in "ab")
    docs = spark.createDataFrame(
        [(1, one), (5, one + " end"), (5, two), (5, two), (5, ""), (6, two), (7, "x y"), (7, "x  y")],
        "doc_id long, text string",
    )
    stay = sorted((r.doc_id, r.text.split()) for r in ngram_join.one_of_each(docs).collect())
    assert stay == [(1, one.split()), (5, []), (5, two.split()), (7, ["x", "y"])]
