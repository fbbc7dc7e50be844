"""Sharding against the schedule dealt one group at a time through a heap."""

import heapq
import zlib
from collections import Counter, defaultdict

from hypothesis import given
from hypothesis import strategies as st

import __spark_entry__ as contract
from siftline.llm import sharding

SF_DIR = "/root/testdata/sf0.001"


def heap_loads(sizes, shards):
    heap = [(0, s) for s in range(shards)]
    for size in sorted(sizes, reverse=True):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
    return dict((s, load) for load, s in heap)


@given(st.lists(st.integers(1, 12), max_size=60), st.integers(1, 5))
def test_runs_give_the_loads_of_the_heap(sizes, shards):
    loads = [0] * shards
    for size, groups in sorted(Counter(sizes).items(), reverse=True):
        counts = sharding.deal_run(loads, size, groups)
        assert sum(counts) == groups and min(counts) >= 0
    assert dict(enumerate(loads)) == heap_loads(sizes, shards)


def check(rows, docs):
    assert Counter(r.doc_id for r in rows) == Counter(d.doc_id for d in docs)
    slots, groups, loads = defaultdict(list), defaultdict(set), Counter()
    text = {d.doc_id: (d.text or "") for d in docs}
    for r in rows:
        data = text[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        slots[r.shard].append(r.slot)
        groups[data].add(r.shard)
        loads[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in groups.values())
    sizes = Counter()
    for d in docs:
        sizes[(d.text or "").encode()] += len((d.text or "").encode()) + 1
    expected = heap_loads(sizes.values(), sharding.SHARDS)
    assert sorted(loads.values()) == sorted(v for v in expected.values() if v)


def test_query_equals_the_heap(spark):
    rows = contract.queries()["op6_sharding"](spark, SF_DIR).collect()
    check(rows, spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    assert {r.shard for r in rows} == set(range(8))


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (3, "hot", 1), (4, "hot", 1), (4, "hot", 1), (None, "é", 1), (7, "x" * 500, 1)],
        "doc_id long, text string, shard int",
    )
    check(sharding.assign(docs).collect(), docs.collect())
    assert sharding.assign(docs.limit(0)).count() == 0
