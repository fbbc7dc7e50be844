"""Hard negatives by inner product: cover trees over all candidates, searched by blocks of anchors.

All rows are dealt by label and nearest pivot to trees of about ``TREE_ROWS`` points, a large label or a
dense region over as many trees as its rows fill. The pivots, a far-apart set of a bounded sample, are the
top of the tree; every row is in one tree whatever the sample. A tree is one row of a stored
table. Anchors form rows of ``BLOCK`` and meet all trees in passes of ``PASS`` blocks, which bounds what is
broadcast; a task keeps the best rows of a pass over all its trees, so a later tree meets the thresholds of the
earlier ones. First each anchor's positives are searched, then the windows that their scores give.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.common import written
from siftline.llm.covertree import LEAST, MOST, Best, CoverTree

SCALE = 256
TREE_ROWS = 2048
LABEL_BUCKETS = 64
PIVOTS = 256
SAMPLE_ROWS = 4096  # rows the pivots are chosen from; all rows are dealt
BLOCK = 2048
PASS = 16
_TREE = (
    "tree long, dim int, ids array<long>, labels array<long>, x array<long>, centre array<long>, start array<long>, "
    "stop array<long>, first array<long>, last array<long>, radius array<double>"
)


def quantized(df: DataFrame, vec_id: str, vector: str, label: Column) -> DataFrame:
    """(vec_id, label, v): floor(256 * x) of every component; rows with a null id, label, vector or a null or non-finite part are left out."""
    x = F.col(vector).cast("array<double>")
    whole = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    fine = F.col(vec_id).isNotNull() & label.isNotNull() & F.coalesce(whole, F.lit(False))
    values = F.transform(x, lambda c: F.floor(c * SCALE))
    return df.where(fine).select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), values.alias("v"))


def _rows(lists: pa.ListArray) -> np.ndarray:
    """Vectors as rows of the widest one's width, filled up with zeros."""
    flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    lengths = np.diff(offsets)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat[offsets[0] : offsets[-1]].reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    for row, a, b in zip(out, offsets[:-1], offsets[1:], strict=True):
        row[: b - a] = flat[a:b]
    return out


def _pivots(rows: DataFrame, count: int) -> np.ndarray:
    """Directions that are far apart, from a bounded sample."""
    sample = rows.orderBy(F.xxhash64("row")).limit(SAMPLE_ROWS).toArrow()
    x = _rows(sample.column("v").combine_chunks()).astype(np.float64)
    x = x / np.maximum(np.sqrt(np.square(x).sum(1)), 1e-300)[:, None]
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(count, len(x)):
        chosen.append(int(np.argmin(nearest)))
        np.maximum(nearest, x @ x[chosen[-1]], out=nearest)
    return x[chosen]


def trees(vectors: DataFrame) -> DataFrame:
    """A stored table with one row per cover tree over the rows of ``vectors`` (vec_id, label, v)."""
    spark = vectors.sparkSession
    rows = written(vectors.withColumn("row", F.monotonically_increasing_id()), "candidates")
    total = rows.count()
    labels = rows.select(F.pmod(F.xxhash64("label"), F.lit(LABEL_BUCKETS)).alias("b")).distinct().count()
    wanted = min(PIVOTS, math.ceil(total / (4 * TREE_ROWS * max(1, labels))))
    pivots = _pivots(rows, wanted) if wanted > 1 else None

    def route(batches):
        for batch in batches:
            near = np.zeros(batch.num_rows, np.int64)
            if pivots is not None:
                x = _rows(batch.column(2)).astype(np.float64)
                width = min(x.shape[1], pivots.shape[1])
                near = np.argmax(x[:, :width] @ pivots[:, :width].T, axis=1)
            yield pa.RecordBatch.from_pydict(
                dict(zip(("row", "vec_id", "v", "label"), batch.columns, strict=True)) | {"near": pa.array(near, pa.int64())}
            )

    routed = rows.select("row", "vec_id", "v", "label").mapInArrow(route, "row long, vec_id long, v array<long>, label long, near long")
    cell = F.pmod(F.xxhash64("label"), F.lit(LABEL_BUCKETS)) * PIVOTS + F.col("near")
    routed = written(routed.withColumn("cell", cell), "candidates")
    # At most LABEL_BUCKETS * PIVOTS rows.
    sizes = routed.groupBy("cell").agg(F.ceil(F.count("*") / TREE_ROWS).alias("parts"))
    tree = F.xxhash64("cell", F.pmod(F.xxhash64("row"), "parts"))
    dealt = routed.join(F.broadcast(sizes), "cell").select(tree.alias("tree"), "vec_id", "label", "v")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / (8 * TREE_ROWS)))

    def build(table: pa.Table) -> pa.Table:
        x = _rows(table.column("v").combine_chunks())
        made = CoverTree.built(x, table.column("vec_id").to_numpy(), table.column("label").to_numpy())
        parts = {p: [getattr(made, p)] for p in CoverTree.PARTS}
        columns = {"tree": [table.column("tree")[0].as_py()], "dim": pa.array([x.shape[1]], pa.int32())}
        return pa.table(columns | {"ids": [made.ids], "labels": [made.labels], "x": [made.x.ravel()]} | parts)

    built = dealt.repartition(tasks, "tree").groupBy("tree").applyInArrow(build, _TREE)
    return written(built, "cover-trees")


def _tree(batch: pa.RecordBatch, i: int) -> CoverTree:
    def column(name):
        return batch.column(name)[i].values.to_numpy(zero_copy_only=False)

    ids, dim = column("ids"), batch.column("dim")[i].as_py()
    parts = {p: column(p) for p in CoverTree.PARTS}
    return CoverTree(column("x").reshape(len(ids), dim), ids, column("labels"), parts)


def _asked(column: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[list[tuple[int, int, int]]]]:
    """Ids, labels, vectors and positives (rank, id, score) of a block of anchors."""
    asked = column.values
    v, positives = asked.field("v"), asked.field("positives")
    flat, offsets = v.values.to_numpy(zero_copy_only=False), v.offsets.to_numpy()
    vectors = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    windows = [[(p["rank"], p["id"], p["score"]) for p in row] for row in positives.to_pylist()]
    return asked.field("vec_id").to_numpy(), asked.field("label").to_numpy(), vectors, windows


_FOUND = "anchor_id long, positive_rank int, positive_id long, positive_score long, found_id long, found_score long"


def _search(index: DataFrame, anchors: DataFrame, blocks: int, k: int, windows, same: bool) -> DataFrame:
    """The best ``k`` rows of each window of each anchor, by task: of the anchor's label if ``same``, else of the others.

    ``anchors`` is (block, asked); ``windows(score)`` gives the bounds of the scores that a positive asks for, and
    a search of positives has one window for everything.
    """

    def run(batches):
        state: dict[int, tuple] = {}
        for batch in batches:
            shown, tree = None, None
            for i in range(batch.num_rows):
                block, name = batch.column("block")[i].as_py(), batch.column("tree")[i].as_py()
                if block not in state:
                    ids, labels, vectors, given = _asked(batch.column("asked")[i])
                    given = [g or [(0, 0, 0)] for g in given] if same else given
                    bests = [Best(*zip(*(windows(p[2]) for p in g), strict=True), k) if g else None for g in given]
                    state[block] = ids, labels, vectors, given, bests
                if name != shown:
                    shown, tree = name, _tree(batch, i)
                ids, labels, vectors, _, bests = state[block]
                for vec_id, label, v, best in zip(ids.tolist(), labels.tolist(), vectors, bests, strict=True):
                    alone = len(tree.kinds) == 1
                    inside = bool((tree.kinds == label).any())
                    if best is None or (same and not inside) or (not same and alone and inside):
                        continue
                    if same:
                        tree.search(v, best, lambda i, l, own=vec_id, mine=label: (i != own) & (l == mine))
                    else:
                        tree.search(v, best, lambda i, l, mine=label: l != mine)
        for ids, _, _, given, bests in state.values():
            columns: list[list] = [[] for _ in range(6)]
            for vec_id, windows_of, best in zip(ids.tolist(), given, bests, strict=True):
                for w, (rank, positive, score) in enumerate(windows_of):
                    scores, found = best.found[w]
                    for c, value in zip(columns[:4], (vec_id, rank, positive, score), strict=True):
                        c.extend([value] * len(found))
                    columns[4].extend(found.tolist())
                    columns[5].extend(scores.tolist())
            names = [part.split()[0] for part in _FOUND.split(", ")]
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds, strict=True)})

    def one_pass(begin: int) -> DataFrame:
        end = min(begin + PASS, blocks) - 1
        # PASS blocks of about BLOCK anchors each, whatever the number of anchors.
        asked = F.broadcast(anchors.where(F.col("block").between(begin, end)))
        every = F.explode(F.sequence(F.lit(begin).cast("long"), F.lit(end).cast("long"))).alias("block")
        return index.select("*", every).join(asked, "block").mapInArrow(run, _FOUND)

    found = reduce(DataFrame.union, [one_pass(b) for b in range(0, blocks, PASS)])
    order = Window.partitionBy("anchor_id", "positive_rank").orderBy(F.desc("found_score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _percent_window(low: int, high: int):
    """The whole scores s with low * score <= 100 * s <= high * score."""

    def window(score: int) -> tuple[int, int]:
        return max(-(-low * score // 100), LEAST), min(high * score // 100, MOST)

    return window


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` is (vec_id, label, v) as ``quantized`` gives it, ``is_anchor`` a condition on it. An anchor's
    positives are its ``positives`` best other rows of its label; for each of them the first ``negatives`` rows of other
    labels with low * positive_score <= 100 * score <= high * positive_score are returned, all if there are fewer;
    a positive without any gives no row, nor does an anchor that is alone in its label. Ties go to the smaller id.
    A repeated anchor id asks once, with the least of its (label, vector), and none of its rows is its own positive;
    repeated candidates are rows of their own. Vectors of unlike length are compared over the components both have;
    products beyond 64 bits are held at the limit. No rows, or no anchors, give no rows.
    """
    asked = vectors.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("a"))
    asked = written(asked.select("vec_id", "a.label", "a.v"), "anchors")
    count = asked.count()
    blocks = max(1, math.ceil(count / BLOCK))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")
    index = trees(vectors)

    def blocked(df: DataFrame) -> DataFrame:
        rows = F.collect_list(F.struct("vec_id", "label", "v", "positives")).alias("asked")
        return written(df.groupBy(block).agg(rows), "anchor-blocks")

    nothing = F.expr("cast(array() as array<struct<rank: int, id: long, score: long>>)")
    everything = blocked(asked.withColumn("positives", nothing))
    near = _search(index, everything, blocks, positives, lambda _: (LEAST, MOST), True)
    best = F.array_sort(F.collect_list(F.struct("rank", F.col("found_id").alias("id"), F.col("found_score").alias("score"))))
    near = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(best.alias("positives"))
    found = _search(index, blocked(asked.join(near, "vec_id")), blocks, negatives, _percent_window(low, high), False)
    return found.select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
        F.col("found_score").alias("negative_score"),
    )


def oracle(table: str, vec_id: str, vector: str, label: str, anchor: str) -> str:
    """The same in SQL, pair by pair; ``label`` and ``anchor`` are expressions over the table."""
    return f"""
with e as (
    select {vec_id} as vec_id, {label} as label, [floor({SCALE} * c::double) for c in {vector}] as v from {table}
    where {vec_id} is not null and label is not null and {vector} is not null
        and len([c for c in {vector} if c is null or isnan(c) or isinf(c)]) = 0),
pairs as (
    select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
        list_inner_product(a.v, b.v)::bigint as score
    from e a join e b on a.vec_id <> b.vec_id where a.{anchor}),
positives as (
    select anchor_id, other_id as positive_id, score as positive_score,
        row_number() over (partition by anchor_id order by score desc, other_id) as n
    from pairs where same qualify n <= 5),
ranked as (
    select p.anchor_id, p.positive_id, p.positive_score, q.other_id as negative_id, q.score as negative_score,
        row_number() over (partition by p.anchor_id, p.n order by q.score desc, q.other_id) as rank
    from positives p join pairs q on q.anchor_id = p.anchor_id and not q.same
        and 30 * p.positive_score <= 100 * q.score and 100 * q.score <= 90 * p.positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
from ranked where rank <= 10
"""
