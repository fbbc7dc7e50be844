"""Sharding by longest processing time: groups that stay together, largest first, to the least-loaded shard.

Groups of one size are alike for the schedule, so it runs over the histogram of group
sizes: a run of equal groups goes to the shards in one step, as the heap would deal
them one by one. The driver sees one row per different size, at most the square root
of twice the bytes; groups take their shards by their rank inside the run, on the
executors.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.common import written

SHARDS = 8
BUCKETS = 4096


def deal_run(loads: list[int], size: int, groups: int) -> list[int]:
    """How many of ``groups`` equal groups each shard gets, always the least-loaded next; ``loads`` is updated.

    A group is placed at a load below T on every shard until all loads reach T, so the
    largest T that uses up no more than all groups is found by halving; a heap deals the rest.
    """

    def until(level: int) -> list[int]:
        return [max(0, -(-(level - load) // size)) for load in loads]

    low, high = min(loads), min(loads) + size * groups + 1
    while low + 1 < high:
        middle = (low + high) // 2
        if sum(until(middle)) <= groups:
            low = middle
        else:
            high = middle
    counts = until(low)
    heap = [(load + n * size, shard) for shard, (load, n) in enumerate(zip(loads, counts, strict=True))]
    heapq.heapify(heap)
    for _ in range(groups - sum(counts)):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        counts[shard] += 1
    loads[:] = [load + n * size for load, n in zip(loads, counts, strict=True)]
    return counts


def schedule(runs, shards: int) -> list[tuple[int, list[int]]]:
    """For each (size, groups), largest size first: the groups up to and with each shard."""
    loads, plan = [0] * shards, []
    for size, groups in runs:
        ends, total = [], 0
        for n in deal_run(loads, size, groups):
            total += n
            ends.append(total)
        plan.append((size, ends))
    return plan


def _before(df: DataFrame, group: str, part: str, count: str) -> DataFrame:
    """``before``: the rows of ``group`` in smaller parts."""
    order = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.sum(count).over(order), F.lit(0)))


def _part(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): every document's shard, and its gapless place there.

    Size is the bytes of the text and one; null counts as empty. Documents with equal texts
    form a group and share a shard, so a group larger than an even share makes its shard the
    largest. Ties go to the lower shard and the smaller digest. Null and repeated ids are
    passed through; repeated rows have places of their own.
    """
    spark = docs.sparkSession
    data = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    rows = docs.select(
        "doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        F.sha2(data, 256).alias("_key"),
    )
    rows = written(rows, "sizes")
    # A group of copies may hold many rows: its size is added up before the shuffle.
    groups = rows.groupBy("_key").agg(F.sum("size").alias("bytes")).withColumn("part", _part(F.col("_key")))
    groups = written(groups, "groups")
    parts = groups.groupBy("bytes", "part").agg(F.count("*").alias("n"))
    runs = parts.groupBy("bytes").agg(F.sum("n").alias("n")).orderBy(F.desc("bytes"))
    plan = schedule(((r.bytes, r.n) for r in runs.toLocalIterator()), shards)
    plan = spark.createDataFrame(plan, "bytes long, ends array<long>")

    inside = Window.partitionBy("bytes", "part").orderBy("_key")
    ranked = groups.withColumn("rank", F.row_number().over(inside)).join(
        _before(parts, "bytes", "part", "n").drop("n"), ["bytes", "part"]
    )
    place = F.size(F.filter("ends", lambda end: end < F.col("before") + F.col("rank")))
    dealt = ranked.join(plan, "bytes").select("_key", place.alias("shard"))
    placed = rows.join(dealt, "_key").drop("_key")
    placed = written(placed.withColumn("_part", _part(F.struct("doc_id", "text_crc32"))), "shards")
    held = _before(placed.groupBy("shard", "_part").agg(F.count("*").alias("_n")), "shard", "_part", "_n").drop("_n")
    inside = Window.partitionBy("shard", "_part").orderBy("doc_id", "text_crc32", "size")
    # One row for each shard and part: a table of fixed size.
    numbered = placed.withColumn("_rank", F.row_number().over(inside)).join(F.broadcast(held), ["shard", "_part"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("_rank") - 1).alias("slot"))


def with_law(assigned: DataFrame) -> DataFrame:
    """The law that the shards keep: near equal bytes. Another shard would deal all groups anew."""
    return assigned.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))
