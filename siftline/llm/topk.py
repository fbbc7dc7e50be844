"""Exact top-k by inner product with multi-resolution segment statistics.

A vector is cut into segments of equal width, 1, 4, 16 and 32 of them. With the mean and
the deviation (as a norm) of each segment, the squared distance of two vectors is at
least the sum over the segments of width * (difference of means)**2 + (difference of
deviations)**2. As the lengths of both are known, the least distance gives the
greatest inner product. Bounds are taken coarse to fine; products are computed for the
pairs that could still be among the best of their query, and no other pair is dropped.

A bounded sample of the vectors gives each query a score that its last one reaches at least, so bounds prune from the
first pair on. All vectors lie in parts of a stored table; queries form blocks of a bounded number, and PASS of them at
a time are broadcast to the parts. A task keeps the best of each query over all its parts.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.common import written

SCALE = 256
SEGMENTS = (1, 4, 16, 32)
QUERY_BLOCK = 2048
PASS = 16
PART_ROWS = 4096
SAMPLE_ROWS = 4096  # rows that give the first thresholds; all rows are searched
CHUNK = 512
EXACT = float(1 << 53)


def quantized(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v): floor(256 * x) of every component. Rows without an id or with a null or non-finite part are left out."""
    x = F.col(vector).cast("array<double>")
    whole = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    values = F.transform(x, lambda c: F.floor(c * SCALE))
    return df.where(F.col(vec_id).isNotNull() & F.coalesce(whole, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"), values.alias("v")
    )


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per vector the scaled means and the deviations of its segments; products of two such rows bound inner products."""
    rows, dim = vectors.shape
    width = max(1, math.ceil(dim / segments))
    count = math.ceil(max(dim, 1) / width)
    padded = np.zeros((rows, width * count))
    padded[:, :dim] = vectors
    parts = padded.reshape(rows, count, width)
    means = parts.mean(2)
    deviations = np.sqrt(np.square(parts - means[:, :, None]).sum(2))
    return np.concatenate((means * math.sqrt(width), deviations), axis=1)


def least_distances(q: np.ndarray, x: np.ndarray, q_norms: np.ndarray, x_norms: np.ndarray) -> np.ndarray:
    """Lower bounds of squared distances from the statistics of one resolution."""
    return q_norms[:, None] + x_norms[None, :] - 2 * (q @ x.T)


class Search:
    """The best ``k`` of a stream of vectors for a block of queries."""

    def __init__(self, ids: list[int], vectors: list[np.ndarray], k: int, least: list[int | None] | None = None):
        """``least`` are scores that ``k`` vectors are known to reach, where known."""
        self._ids, self._k = np.array(ids, np.int64), k
        self._vectors = _matrix(vectors)
        self._best: list[list[tuple[int, int]]] = [[] for _ in ids]  # (-score, vec_id), best first
        self._least = np.array([-np.inf if x is None else x for x in least or [None] * len(ids)], np.float64)
        self.products = self.pairs = 0

    def add(self, ids: np.ndarray, vectors: list[np.ndarray]) -> None:
        x, q = _same_width(_matrix(vectors), self._vectors)
        largest = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1]
        rows, columns = np.arange(len(q)), np.arange(len(x))
        alive = self._ids[:, None] != ids[None, :]
        q_norms, x_norms = np.square(q).sum(1), np.square(x).sum(1)
        self.pairs += int(alive.sum())
        slack = 1e-9 * (q_norms[:, None] + x_norms[None, :]) + 1e-6
        for segments in SEGMENTS:
            rows, columns = rows[alive[rows][:, columns].any(1)], columns[alive[rows][:, columns].any(0)]
            at = np.ix_(rows, columns)
            distance = least_distances(
                statistics(q[rows], segments), statistics(x[columns], segments), q_norms[rows], x_norms[columns]
            )
            most = (q_norms[rows][:, None] + x_norms[columns][None, :] - distance) / 2 + slack[at]
            alive[at] &= most >= self._least[rows][:, None]
        for i in np.flatnonzero(alive.any(1)).tolist():
            found = np.flatnonzero(alive[i])
            self.products += len(found)
            if largest < EXACT:
                scores = (x[found] @ q[i]).astype(np.int64)
            else:  # products beyond the exact range of doubles; beyond 64 bits they are clipped
                whole = (x[found].astype(object) @ q[i].astype(object)).tolist()
                scores = np.array([max(min(int(s), 2**63 - 1), -(2**63)) for s in whole], np.int64)
            if len(found) > self._k:
                order = np.lexsort((ids[found], -scores))[: self._k]
                found, scores = found[order], scores[order]
            best = self._best[i] + list(zip((-scores).tolist(), ids[found].tolist(), strict=True))
            self._best[i] = best = sorted(best)[: self._k]
            if len(best) == self._k:
                self._least[i] = max(self._least[i], -best[-1][0])

    def found(self) -> list[list[tuple[int, int]]]:
        """By query (-score, vec_id), best first."""
        return self._best

    def results(self) -> tuple[list[int], list[int], list[int]]:
        rows = [(int(q), v, -s) for q, best in zip(self._ids, self._best, strict=True) for s, v in best]
        return tuple(map(list, zip(*rows, strict=True))) if rows else ([], [], [])


def _matrix(vectors: list[np.ndarray]) -> np.ndarray:
    """Rows of one width; a shorter vector is filled with zeros, so missing components add nothing."""
    width = max(map(len, vectors), default=0)
    if all(len(v) == width for v in vectors):
        return np.array(vectors, np.float64).reshape(len(vectors), width)
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for m in (a, b))


def _vectors(column: pa.ListArray) -> list[np.ndarray]:
    flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _with_thresholds(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """``queries`` with ``least``: the ``k``-th best score among the rows of a bounded sample, null if it has fewer."""
    sample = vectors.orderBy(F.xxhash64("vec_id", "v")).limit(SAMPLE_ROWS).toArrow().combine_chunks()
    ids = sample.column("vec_id").to_numpy()
    held = _vectors(sample.column("v").chunk(0)) if len(sample) else []
    shared = vectors.sparkSession.sparkContext.broadcast((ids, held))

    def run(batches):
        ids, held = shared.value
        for batch in batches:
            search = Search(batch.column(0).to_pylist(), _vectors(batch.column(1)), k)
            for at in range(0, len(ids), CHUNK):
                search.add(ids[at : at + CHUNK], held[at : at + CHUNK])
            least = [-best[-1][0] if len(best) == k else None for best in search.found()]
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column(0), "v": batch.column(1), "least": pa.array(least, pa.int64())})

    return queries.mapInArrow(run, "vec_id long, v array<long>, least long")


def search(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` highest products over all rows of other ids.

    ``vectors`` is (vec_id, v) as ``quantized`` gives it, ``is_query`` a condition on it. Ties
    go to the smaller id. A repeated query id is searched once, with the smallest of its
    vectors; repeated candidates are rows of their own. Vectors of unlike length are compared
    over the components both have. Fewer candidates give fewer rows.
    """
    rows = written(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    parts = max(1, math.ceil(rows.count() / PART_ROWS))
    part = F.pmod(F.xxhash64("row"), F.lit(parts))
    index = written(rows.groupBy(part.alias("part")).agg(F.collect_list(F.struct("vec_id", "v")).alias("rows")).repartition(parts, "part"), "vector-parts")

    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = written(_with_thresholds(queries, rows.select("vec_id", "v"), k), "queries")
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")
    asked = written(queries.groupBy(block).agg(F.collect_list(F.struct("vec_id", "v", "least")).alias("asked")), "query-blocks")

    def run(batches):
        state: dict[int, Search] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                block, given = batch.column("block")[i].as_py(), batch.column("rows")[i].values
                if block not in state:
                    q = batch.column("asked")[i].values
                    state[block] = Search(q.field("vec_id").to_pylist(), [v.copy() for v in _vectors(q.field("v"))], k, q.field("least").to_pylist())
                ids, held = given.field("vec_id").to_numpy(), _vectors(given.field("v"))
                for at in range(0, len(ids), CHUNK):
                    state[block].add(ids[at : at + CHUNK], held[at : at + CHUNK])
        for search in state.values():
            columns = dict(zip(("query_id", "vec_id", "score"), search.results(), strict=True))
            yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in columns.items()})

    def one_pass(begin: int) -> DataFrame:
        end = min(begin + PASS, blocks) - 1
        # PASS blocks of about QUERY_BLOCK queries, whatever their number.
        some = F.broadcast(asked.where(F.col("block").between(begin, end)))
        every = F.explode(F.sequence(F.lit(begin).cast("long"), F.lit(end).cast("long"))).alias("block")
        return index.select("rows", every).join(some, "block").mapInArrow(run, "query_id long, vec_id long, score long")

    partial = reduce(DataFrame.union, [one_pass(b) for b in range(0, blocks, PASS)])
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def oracle(table: str, vec_id: str, vector: str, every: int, k: int) -> str:
    """The same in SQL, pair by pair."""
    return f"""
with v as (
    select {vec_id} as id, [floor({SCALE} * c::double) for c in {vector}] as v from {table}
    where {vec_id} is not null and {vector} is not null
        and len([c for c in {vector} if c is null or isnan(c) or isinf(c)]) = 0),
scored as (
    select q.id as query_id, c.id as vec_id, list_inner_product(q.v, c.v)::bigint as score
    from v q join v c on q.id <> c.id where q.id % {every} = 0)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= {k}
"""
