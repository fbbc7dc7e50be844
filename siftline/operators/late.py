"""Event-time windows and the audit of late rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: how far behind the newest event a row may arrive.
ALLOWED_LATENESS = "10 seconds"

# Arrival positions per chunk of the audit.
CHUNK_ROWS = 100_000


def with_watermark(messages: DataFrame, delay: str = ALLOWED_LATENESS) -> DataFrame:
    return messages.withWatermark("event_ts", delay)


def window_counts(classified: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Messages per event-time window and type."""
    return (
        classified.groupBy(F.window("event_ts", width).alias("w"), "profanity_type")
        .agg(F.count("*").alias("n"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "profanity_type",
            "n",
        )
    )


def mark_late(
    arrived: DataFrame,
    source: str = "source_partition",
    arrival: str = "offset",
    delay: str = ALLOWED_LATENESS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``watermark`` and ``is_late`` as seen when each row arrived.

    The watermark is the newest event time so far in the same source, less the
    delay. A source may hold most of the rows, so its running maximum is built
    from chunks of the arrival order: the maximum of all earlier chunks (from a
    summary with one row per chunk) and the running maximum inside the chunk. A row
    without a place in the order (null source, null arrival) has no watermark and is not late.
    """
    placed = F.col(source).isNotNull() & F.col(arrival).isNotNull()
    unplaced = arrived.where(~placed).withColumn("watermark", F.lit(None).cast("timestamp"))
    chunked = arrived.where(placed).withColumn("_chunk", F.expr(f"`{arrival}` div {int(chunk_rows)}"))
    before = Window.partitionBy(source).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        chunked.groupBy(source, "_chunk")
        .agg(F.max("event_ts").alias("_newest"))
        .select(source, "_chunk", F.max("_newest").over(before).alias("_earlier"))
    )
    inside = (
        Window.partitionBy(source, "_chunk")
        .orderBy(arrival)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    newest = F.greatest(F.max("event_ts").over(inside), F.col("_earlier"))
    marked = (
        chunked.join(earlier, [source, "_chunk"])
        .withColumn("watermark", newest - F.expr(f"INTERVAL {delay}"))
        .withColumn("is_late", F.coalesce(F.col("event_ts") < F.col("watermark"), F.lit(False)))
        .drop("_chunk", "_earlier")
    )
    unplaced = unplaced.withColumn("watermark", F.col("watermark").cast(marked.schema["watermark"].dataType))
    return marked.unionByName(unplaced.withColumn("is_late", F.lit(False)))
