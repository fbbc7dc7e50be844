"""One event-time clock per source partition.

A single watermark follows the fastest partition, so rows of a slower one count as late although they are in
order. Here each partition is an input with a watermark of its own, and a query over their union goes by the
least of them. A partition without rows would hold the least one back for ever: while messages are live, beats of
the machine's clock move the watermark of an idle partition on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.operators.decode import FAILFAST
from siftline.operators.late import ALLOWED_LATENESS
from siftline.sources.local import Source
from siftline.streaming.job import arrivals

POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


def with_beats(stream: DataFrame, idle: str, delay: str = ALLOWED_LATENESS) -> DataFrame:
    """``stream`` with a watermark that is never older than now less ``idle`` and ``delay``.

    Beats are rows of the clock that only the watermark sees. Meant for messages as they happen: in a replay of
    older ones everything would be late by the clock.
    """
    clock = stream.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields if f.name != "event_ts"]
    at = (F.col("timestamp") - F.expr(f"INTERVAL {idle}")).alias("event_ts")
    beats = clock.select(*nothing, at, F.lit(True).alias("_beat"))
    timed = stream.withColumn("_beat", F.lit(False)).unionByName(beats).withWatermark("event_ts", delay)
    # The condition reads the event time, so it stays above the watermark, which sees the beats.
    real = F.when(F.col("_beat"), F.lit(None)).otherwise(F.col("event_ts")).isNotNull()
    return timed.where(real).drop("_beat")


def arrivals_by_partition(
    spark: SparkSession,
    sources: Sequence[Source],
    mode: str = FAILFAST,
    idle: str | None = None,
    delay: str = ALLOWED_LATENESS,
) -> DataFrame:
    """``arrivals`` of several inputs, each with a watermark of its own; queries go by the least of them."""
    spark.conf.set(POLICY, "min")
    inputs = []
    for source in sources:
        if idle is None:
            inputs.append(arrivals(source(spark), mode, delay))
        else:
            inputs.append(with_beats(arrivals(source(spark), mode, None), idle, delay))
    return reduce(DataFrame.unionByName, inputs)
