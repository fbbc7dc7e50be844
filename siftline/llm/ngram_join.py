"""Similarity join on word n-grams: MinHash banding finds candidates, full n-gram sets decide.

1. Every text becomes the set of hashes of its five-word shingles. Texts with equal sets
   form a class and are one node from here on, however many copies there are.
2. Bands of a MinHash signature are shuffled by their hash. Nodes that share a band with
   another are tied to the smallest node of that band: a star, never all pairs.
3. Components of these stars are packed into blocks of bounded size; a component larger
   than a block becomes several, and each pair of its blocks is a task of its own.
4. A task reads the full sets of one block, or of two, compares every pair that shares a
   band, and returns how many links each node has and a forest of the links. Pairs are
   counted where they are found and are never rows.
"""

from __future__ import annotations

import math
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import per_batch, texts, written
from siftline.llm.graph import components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
TARGET_RECALL = 0.9999
MAX_PERMUTATIONS = 128
BLOCK_NODES = 512
CACHE_WORDS = 300_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def banding(similarity: float, recall: float, most: int = MAX_PERMUTATIONS) -> tuple[int, int]:
    """Bands and rows per band: the most rows whose bands reach ``recall`` at ``similarity`` within ``most`` hashes."""
    best = None
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands * rows <= most:
            best = bands, rows
    if best is None:
        raise ValueError(f"no banding of {most} hashes reaches recall {recall} at similarity {similarity}")
    return best


class Shingles:
    """Sets of shingle hashes of texts; hashes of words are remembered."""

    def __init__(self, words: int = SHINGLE_WORDS):
        self._words, self._known = words, {}

    def of(self, text: str) -> np.ndarray:
        """Sorted distinct hashes. A text with fewer words than a shingle is one shingle; without words it has none."""
        words = _WORD.findall(text)
        if len(self._known) > CACHE_WORDS:
            self._known.clear()
        known = self._known
        hashes = [known.get(w) or known.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in words]
        h = np.array(hashes, np.uint64)
        n = min(self._words, len(h))
        out = np.full(max(0, len(h) - n + 1) if n else 0, n, np.uint64)
        for i in range(n):
            out = (out ^ (out >> np.uint64(29))) * _MULTIPLIER + h[i : len(h) - n + 1 + i]
        out = (out ^ (out >> np.uint64(32))) * _MULTIPLIER
        return np.unique(out ^ (out >> np.uint64(29)))


class Bands:
    """Band hashes of shingle sets."""

    def __init__(self, bands: int, rows: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        draw = rng.integers(0, 1 << 62, (2, bands * rows), dtype=np.int64).astype(np.uint64)
        self._factors, self._shifts = draw[0] * np.uint64(2) + np.uint64(1), draw[1]
        self._bands, self._rows = bands, rows

    def of(self, shingles: np.ndarray) -> list[int]:
        least = np.full(len(self._factors), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 1024):
            part = shingles[at : at + 1024, None] * self._factors
            part += self._shifts
            np.minimum(least, part.min(0), out=least)
        data, width = least.tobytes(), 8 * self._rows
        signed = np.array([xxhash.xxh3_64_intdigest(data[i * width : (i + 1) * width], seed=i) for i in range(self._bands)], np.uint64)
        return signed.view(np.int64).tolist()


def _key(shingles: np.ndarray) -> int:
    """The node of a set: a 64-bit hash of it, as a signed number."""
    return int(np.array(xxhash.xxh3_64_intdigest(shingles.tobytes()), np.uint64).view(np.int64))


def signatures(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_key, node, bands): node and bands are null for a text without words."""

    def make():
        shingles, banded = Shingles(), Bands(bands, rows)

        def run(batch: pa.RecordBatch) -> dict:
            sets = [shingles.of(t) for t in texts(batch)]
            return {
                "doc_id": batch.column(0),
                "text_key": batch.column(1),
                "node": pa.array([_key(s) if len(s) else None for s in sets], pa.int64()),
                "bands": pa.array([banded.of(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
            }

        return run

    rows_in = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return per_batch(rows_in, "doc_id long, text_key long, node long, bands array<long>", make)


def _stars(signed: DataFrame) -> DataFrame:
    """(a, b): nodes that share a band with another, and the smallest node of it."""
    banded = signed.where("node is not null").select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    return banded.join(shared, "band").where("node > least").select(F.col("node").alias("a"), F.col("least").alias("b"))


def _tasks(nodes: DataFrame, block_nodes: int) -> DataFrame:
    """(node, task, side): the blocks a node is in. Side 0 is a block by itself; two blocks of a large component meet as 1 and 2."""
    sizes = nodes.groupBy("component").agg(F.count("*").alias("size"))
    members = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shared = max(1, math.ceil(members / block_nodes))
    placed = nodes.join(sizes, "component")
    chunks = F.ceil(F.col("size") / block_nodes).cast("long")
    placed = placed.select(
        "node", "component", chunks.alias("chunks"), F.pmod(F.xxhash64("node", F.lit(7)), chunks).alias("chunk")
    )
    small = placed.where("chunks = 1").select("node", F.xxhash64(F.lit("shared"), F.pmod(F.xxhash64("component"), F.lit(shared))).alias("task"), F.lit(0).alias("side"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other")
    large = placed.where("chunks > 1").select("node", "component", "chunk", other).select(
        "node",
        F.xxhash64("component", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("task"),
        F.when(F.col("chunk") == F.col("other"), 0).when(F.col("chunk") < F.col("other"), 1).otherwise(2).alias("side"),
    )
    return small.union(large)


def links_between(nodes, bands, sets, sides, limit: Fraction):
    """(links of each node, edges of a spanning forest) among the pairs that share a band and reach ``limit``.

    With two sides only pairs across them count, as those inside a side belong to another task.
    """
    n = len(nodes)
    sizes = np.array([len(s) for s in sets], np.int64)
    two = any(sides)
    rows = [i for i in range(n) if sides[i] < 2]
    columns = [i for i in range(n) if not two or sides[i] == 2]
    counts, parent = np.zeros(n, np.int64), list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    columns_at = np.array(columns, np.int64)
    for i in rows:
        later = columns_at if two else columns_at[columns_at > i]
        # No set so much larger or smaller can reach the limit.
        fits = (sizes[later] * limit.denominator >= limit.numerator * sizes[i]) & (sizes[i] * limit.denominator >= limit.numerator * sizes[later])
        later = later[fits]
        later = later[(bands[later] == bands[i]).any(1)]
        if not len(later):
            continue
        joined = np.concatenate([sets[j] for j in later])
        at = np.minimum(np.searchsorted(sets[i], joined), sizes[i] - 1)
        hits = np.concatenate(([0], np.cumsum(sets[i][at] == joined)))
        ends = np.cumsum(sizes[later])
        common = hits[ends] - hits[ends - sizes[later]]
        linked = later[common * limit.denominator >= limit.numerator * (sizes[i] + sizes[later] - common)]
        counts[i] += len(linked)
        counts[linked] += 1
        for j in linked.tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                edges.append((nodes[i], nodes[j]))
    return counts, edges


def links(docs: DataFrame, signed: DataFrame, similarity: float, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """(a, b, links): rows with b null carry links of node a, the others are edges of a forest of all links."""
    candidates = written(components(_stars(signed)), "candidates")
    tasks = _tasks(candidates, block_nodes)
    # One text for each node; only those are read again for their sets.
    chosen = signed.where("node is not null").groupBy("node").agg(F.min("text_key").alias("text_key"))
    chosen = chosen.join(candidates.select("node"), "node").select("text_key", "node")
    wanted = docs.select(F.xxhash64("text").alias("text_key"), "text").join(chosen, "text_key").dropDuplicates(["node"])

    bands, rows = banding(similarity, TARGET_RECALL)

    def make():
        shingles, banded = Shingles(), Bands(bands, rows)

        def run(batch: pa.RecordBatch) -> dict:
            sets = [shingles.of(t) for t in texts(batch)]
            return {
                "node": pa.array([_key(s) for s in sets], pa.int64()),
                "bands": pa.array([np.array(banded.of(s), np.int64).tobytes() for s in sets], pa.binary()),
                "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
            }

        return run

    sets = per_batch(wanted.select("text"), "node long, bands binary, shingles binary", make)
    limit = Fraction(str(similarity))

    def compare(table: pa.Table) -> pa.Table:
        nodes, sides = table["node"].to_pylist(), table["side"].to_pylist()
        band = np.array([np.frombuffer(b, np.int64) for b in table["bands"].to_pylist()])
        shingles = [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()]
        counts, edges = links_between(nodes, band, shingles, sides, limit)
        a = nodes + [e[0] for e in edges]
        b = [None] * len(nodes) + [e[1] for e in edges]
        n = counts.tolist() + [0] * len(edges)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array(n, pa.int64())})

    grouped = sets.join(tasks, "node").groupBy("task")
    return grouped.applyInArrow(compare, "a long, b long, links long")


def join(docs: DataFrame, similarity: float = SIMILARITY, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """(doc_id, class_id, copy_of, n_links): one row per document.

    ``copy_of`` is the smallest id with the same shingle set, ``class_id`` the smallest id that
    is reached over links, and ``n_links`` the number of other shingle sets with a Jaccard
    similarity of at least ``similarity``. Texts of one to four words are one shingle. A text
    without words, null included, is alone: class_id and copy_of are its own id. Rows without
    an id have links and a class like any other, but no id names a class while another does.
    Repeated rows are repeated. Columns other than doc_id and text are not looked at.
    """
    return _classes(docs, similarity, block_nodes).select("doc_id", "class_id", "copy_of", "n_links")


def _classes(docs: DataFrame, similarity: float, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """The rows of ``join`` with the hash of their text and the component of their class, null for a text without words."""
    bands, rows = banding(similarity, TARGET_RECALL)
    signed = written(signatures(docs, bands, rows), "signatures")
    found = written(links(docs, signed, similarity, block_nodes), "links")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("n_links"))
    linked = components(found.where("b is not null").select("a", "b"))
    nodes = signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("copy_of"))
    nodes = nodes.join(counts, "node", "left").join(linked, "node", "left")
    nodes = nodes.select("node", "copy_of", "n_links", F.coalesce("component", "node").alias("component"))
    firsts = nodes.groupBy("component").agg(F.min("copy_of").alias("class_id"))
    nodes = nodes.join(firsts, "component")
    with_words = signed.where("node is not null").select("doc_id", "text_key", "node").join(nodes, "node")
    alone = signed.where("node is null").select(
        "doc_id", "text_key", F.lit(None).cast("long").alias("component"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"),
        F.lit(0).cast("long").alias("n_links"),
    )
    n_links = F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    return with_words.select("doc_id", "text_key", "component", "class_id", "copy_of", n_links).union(alone)


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the document with the smallest id, once.

    An id on texts of several classes can stay for each of them. Rows without an id stay: no
    class is named by them.
    """
    key = "_" + max(map(len, docs.columns)) * "_" + "text_key"  # longer than any column, so none of theirs
    firsts = _classes(docs, similarity).where("doc_id = class_id").groupBy("class_id", "component")
    keepers = firsts.agg(F.min("text_key").alias(key)).select(F.col("class_id").alias("doc_id"), key)
    named = docs.withColumn(key, F.xxhash64("text")).join(keepers, ["doc_id", key], "left_semi")
    named = named.dropDuplicates(["doc_id", key]).select(*docs.columns)
    return named.union(docs.where("doc_id is null"))


ORACLE = r"""
with recursive words as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
sets as (
    select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_sort(list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)])) end as s
    from words),
nodes as (select s, min(doc_id) as node, len(s) as n from sets where len(s) > 0 group by s),
grams as (select node, n, unnest(s) as g from nodes),
pairs as (
    select a.node as a, b.node as b from grams a join grams b on a.g = b.g and a.node <> b.node
    group by a.node, b.node, a.n, b.n having count(*) * 5 >= 4 * (a.n + b.n - count(*))),
reach as (select node, node as other from nodes union select r.node, p.b from reach r join pairs p on r.other = p.a),
classes as (select node, min(other) as class_id from reach group by node),
counts as (select a as node, count(*) as n_links from pairs group by a)
select doc_id, coalesce(class_id, doc_id) as class_id, coalesce(node, doc_id) as copy_of, coalesce(n_links, 0) as n_links
from sets left join nodes using (s) left join classes using (node) left join counts using (node)
"""
