"""Send one classified micro-batch to every sink."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftline.operators.classify import classify, profane_only
from siftline.operators.decode import messages_of, rejects_of
from siftline.schema import PROFANE_TABLE, PROFANITY, SAFE_TABLE
from siftline.sinks.batches import read_batches, strip_batch_columns, taken, write_once

JUDGED = ("arrived", "rejected", "profane", "safe")
REPORT = T.StructType(
    [T.StructField("batch_id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("n", T.LongType())]
)

# A sink takes a batch and its id; a retry calls it again with the same rows. It may say how many rows
# it wrote by name, None for those an earlier attempt has written.
Sink = Callable[[DataFrame, int], "dict[str, int | None] | None"]


def _judged(inspected: bool) -> list[Column]:
    """Counts of a classified batch: arrived = rejected + profane + safe."""
    usable = F.col("reason").isNull() if inspected else F.lit(True)
    profane = F.col("profanity_type") == PROFANITY
    counts = (F.count("*"), F.count_if(~usable), F.count_if(usable & profane), F.count_if(usable & ~profane))
    return [count.alias(name) for count, name in zip(counts, JUDGED, strict=True)]


def lost_rows(counts: dict[str, int | None]) -> dict[str, int]:
    """Sinks whose rows are not those that the batch had for them, with the difference; all is well if it is empty.

    A batch is whole if arrived = rejected + profane + safe, the feed has the profane, the quarantine the rejected,
    and the analytics table, and the two lake tables together, the rest. An executor that is lost while a batch
    is written may have its rows counted twice, so a difference is a reason to look, not a proof.
    """
    messages = counts["profane"] + counts["safe"]
    due = {"feed": counts["profane"], "rejects": counts["rejected"], "olap": messages}
    found = {name: counts[name] - n for name, n in due.items() if counts.get(name) is not None}
    lake = [counts.get(name) for name in (PROFANE_TABLE, SAFE_TABLE)]
    if None not in lake:
        found["lake"] = sum(lake) - messages
    found["arrived"] = counts["rejected"] + messages - counts["arrived"]
    return {name: n for name, n in found.items() if n}


@dataclass(frozen=True)
class ReportFiles:
    """The counts of each batch as rows (name, n), in a folder per batch."""

    path: str

    def __call__(self, spark: SparkSession, batch_id: int, counts: dict[str, int | None]) -> None:
        rows = spark.createDataFrame([(batch_id, name, n) for name, n in counts.items()], REPORT)
        write_once(spark, self.path, batch_id, lambda to: rows.coalesce(1).write.mode("overwrite").parquet(to))

    def read(self, spark: SparkSession) -> DataFrame:
        return strip_batch_columns(read_batches(spark, self.path, REPORT))


@dataclass(frozen=True)
class FanOut:
    """``foreachBatch`` body: classify, keep the batch once, write each sink.

    ``feed`` gets the profane messages, ``lake`` and ``olap`` get all of them, and a sink
    that is None is left out. Undecodable values of an inspected batch go to ``rejects``.
    ``written`` is called with the batch id once all sinks have the batch, ``report`` with the counts
    of the batch, taken on the way: what arrived, how it was judged, and what each sink wrote.
    """

    words: Iterable[str] | DataFrame
    feed: Sink | None = None
    lake: Sink | None = None
    olap: Sink | None = None
    rejects: Sink | None = None
    written: Callable[[SparkSession, int], None] | None = None
    report: Callable[[SparkSession, int, dict[str, int | None]], None] | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        held = [batch.persist()] if isinstance(self.words, DataFrame) else []  # it is read for the texts, then tagged
        seen = Observation()
        screened = classify(batch, self.words).observe(seen, *_judged("reason" in batch.columns)).persist()
        counts: dict[str, int | None] = {}
        try:
            messages = screened
            if "reason" in batch.columns:
                if self.rejects is not None:
                    counts |= self.rejects(rejects_of(screened), batch_id) or {}
                messages = messages_of(screened)
            if self.feed is not None:
                counts |= self.feed(profane_only(messages), batch_id) or {}
            if self.olap is not None:
                counts |= self.olap(messages, batch_id) or {}
            if self.lake is not None:
                counts |= self.lake(messages, batch_id) or {}
            if self.written is not None:
                self.written(batch.sparkSession, batch_id)
            # Where all sinks had the batch, nothing was read and there is nothing to report.
            if self.report is not None and any(n is not None for n in counts.values()):
                self.report(batch.sparkSession, batch_id, taken(seen, JUDGED) | counts)
        finally:
            for rows in (screened, *held):
                rows.unpersist()

    def prompt(self) -> FanOut:
        """The sinks that want rows as they arrive: feed, analytics and quarantine."""
        return replace(self, lake=None)

    def lake_only(self) -> FanOut:
        return replace(self, feed=None, olap=None, rejects=None)
