"""The screening job: source, decode, event time, classify, three sinks.

Feed and analytics want rows at once, lake commits are rare: the continuous job is two
queries over one source, each with its own trigger and checkpoint. The path is stateless on purpose. The watermark marks late rows for windowed
queries beside the job, but the job itself drops none.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftline.operators.classify import classify
from siftline.operators.convert import event_time
from siftline.operators.decode import FAILFAST, QUARANTINE, decode_json, inspect_json
from siftline.operators.late import ALLOWED_LATENESS, window_counts, with_watermark
from siftline.session import prepare, shared_dir
from siftline.sinks.batches import fresh_id
from siftline.sinks.fanout import FanOut
from siftline.sources.local import Source

# Fixed value: time between micro-batches, and so between lake commits.
INTERVAL_MS = 300_000


PROMPT_MS = 1_000  # between micro-batches of feed and analytics


def arrivals(raw: DataFrame, mode: str = FAILFAST, delay: str | None = ALLOWED_LATENESS) -> DataFrame:
    """Messages with ``ingest_ts`` and ``event_ts`` from JSON values, or from messages as they are.

    The watermark is ``delay`` behind the newest event; None leaves it to the caller.

    The ingest time is taken here, where Spark fixes it for a micro-batch and a
    restart repeats it; a batch gets the time of this call. In quarantine mode every
    value stays, inspected.
    """
    now = F.current_timestamp() if raw.isStreaming else F.lit(dt.datetime.now(dt.UTC)).cast("timestamp")
    stamped = raw.withColumn("ingest_ts", now)
    if mode not in (FAILFAST, QUARANTINE):
        raise ValueError(f"unknown decode mode {mode}")
    if "value" not in raw.columns:
        decoded = stamped
    else:
        decoded = inspect_json(stamped) if mode == QUARANTINE else decode_json(stamped)
    at = event_time(F.col("timestamp"), F.col("ingest_ts"))
    timed = decoded.withColumn("event_ts", at)
    return with_watermark(timed, delay) if delay else timed


def _mode(sinks: FanOut) -> str:
    return FAILFAST if sinks.rejects is None else QUARANTINE


def start(
    spark: SparkSession,
    source: Source,
    sinks: FanOut,
    checkpoint: str | None = None,
    interval_ms: int | None = INTERVAL_MS,
    name: str = "message_screening",
    mode: str | None = None,
) -> StreamingQuery:
    """Start one query; without an interval it processes what is there and ends.

    Offsets live in ``checkpoint``: starting again with the same folder resumes
    there, and the sinks recognise a batch that was already written. A continuous
    query must name it, as with a new one everything would be stored again.
    """
    prepare(spark)
    if interval_ms is not None and not checkpoint:
        raise ValueError("a continuous query needs a checkpoint folder")
    trigger = (
        {"availableNow": True} if interval_ms is None else {"processingTime": f"{interval_ms} milliseconds"}
    )
    return (
        arrivals(source(spark), mode or _mode(sinks))
        .writeStream.queryName(name)
        .foreachBatch(sinks)
        .option("checkpointLocation", checkpoint or shared_dir(spark, name))
        .trigger(**trigger)
        .start()
    )


def starters(
    spark: SparkSession,
    source: Source,
    sinks: FanOut,
    checkpoint: str,
    interval_ms: int = INTERVAL_MS,
    prompt_ms: int = PROMPT_MS,
    name: str = "message_screening",
) -> dict[str, Callable[[], StreamingQuery]]:
    """What starts, or starts again, the queries of the continuous job: feed, analytics and quarantine promptly, the lake at its interval."""
    mode = _mode(sinks)
    parts = (("prompt", sinks.prompt(), prompt_ms), ("lake", sinks.lake_only(), interval_ms))
    return {
        kind: partial(start, spark, source, part, f"{checkpoint}/{kind}", every, f"{name}_{kind}", mode)
        for kind, part, every in parts
    }


def start_all(spark: SparkSession, source: Source, sinks: FanOut, checkpoint: str, *intervals_and_name) -> list[StreamingQuery]:
    """Start the queries of the continuous job."""
    return [begin() for begin in starters(spark, source, sinks, checkpoint, *intervals_and_name).values()]


def start_windows(
    spark: SparkSession,
    source: Source,
    words,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval_ms: int | None = PROMPT_MS,
    width: str = "5 minutes",
    name: str = "message_windows",
) -> StreamingQuery:
    """Counts per event-time window and type, handed to ``sink`` once a window is closed by the watermark."""
    prepare(spark)
    return window_query(window_counts(classify(arrivals(source(spark)), words), width), sink, checkpoint, interval_ms, name)


def window_query(
    counted: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, interval_ms: int | None, name: str
) -> StreamingQuery:
    trigger = (
        {"availableNow": True} if interval_ms is None else {"processingTime": f"{interval_ms} milliseconds"}
    )
    return (
        counted.writeStream.queryName(name)
        .outputMode("append")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run(spark: SparkSession, source: Source, sinks: FanOut, checkpoint: str | None = None) -> None:
    """Process everything available, then return.

    A source that is a batch, such as injected messages or a bounded topic, goes through the
    same functions once, as a batch of its own.
    """
    prepare(spark)
    rows = source(spark)
    if rows.isStreaming:
        start(spark, lambda _: rows, sinks, checkpoint, interval_ms=None).awaitTermination()
    else:
        sinks(arrivals(rows, _mode(sinks)), fresh_id())
