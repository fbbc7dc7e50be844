"""The moderation queries over a message table.

``rows`` has the analytics columns (``event_time``). Aggregates combine on the
map side first, so a hot account or type costs one partial row per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftline.functions.instants import hour_of_day, month_number, truncate
from siftline.functions.sizes import readable_size
from siftline.schema import LAKE_DAY, OLAP_KEY, OLAP_MONTH, PROFANITY, SAFE


def count_all(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("total"))


def count_by_type(rows: DataFrame) -> DataFrame:
    return rows.groupBy("profanity_type").agg(F.count("*").alias("total"))


def type_share(rows: DataFrame) -> DataFrame:
    """Count and percentage per type. The window sees one row per type.

    Ties round to even, as floating-point rounding does on the OLAP server.
    """
    share = F.col("total") * F.lit(100.0) / F.sum("total").over(Window.partitionBy())
    return count_by_type(rows).withColumn("percentage", F.bround(share, 2))


def recent(rows: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Rows of the last hours before ``now``; reads only their months where stored by month."""
    bound = now - F.expr(f"INTERVAL {int(hours)} HOURS")
    return _from_month(rows, bound).where(F.col("event_time") > bound)


def _from_month(rows: DataFrame, bound: Column) -> DataFrame:
    """Plain files do not link ``event_time`` and its month: add the month's own bound."""
    if OLAP_MONTH not in rows.columns:
        return rows
    return rows.where(F.col(OLAP_MONTH) >= month_number(bound))


def messages_per_hour(rows: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    return (
        recent(rows, now, hours)
        .groupBy(truncate("hour", F.col("event_time")).alias("hour"))
        .agg(F.count("*").alias("message_count"))
        .orderBy("hour")
    )


def daily_trend(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy(F.to_date("event_time").alias("day"))
        .agg(
            F.count_if(F.col("profanity_type") == PROFANITY).alias("profane"),
            F.count_if(F.col("profanity_type") == SAFE).alias("safe"),
        )
        .orderBy("day")
    )


def top_profane_accounts(rows: DataFrame, n: int = 10) -> DataFrame:
    """Accounts with most profane messages; ``account_id`` breaks ties."""
    return (
        rows.where(F.col("profanity_type") == PROFANITY)
        .groupBy("account_id")
        .agg(F.count("*").alias("profane_messages"))
        .orderBy(F.desc("profane_messages"), "account_id")
        .limit(n)
    )


def account_hour_heatmap(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("account_id", hour_of_day(F.col("event_time")).alias("hour"))
        .agg(F.count("*").alias("messages"))
        .orderBy("account_id", "hour")
    )


def duplicate_keys(rows: DataFrame) -> DataFrame:
    """Keys stored more than once."""
    return (
        rows.groupBy(*OLAP_KEY).agg(F.count("*").alias("occurrences")).where("occurrences > 1")
    )


def latest_messages(rows: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` latest rows of a stored table; the key breaks ties.

    The time of the n-th latest row is found first, from the time column alone.
    As a bound on the scan it leaves out all files and row groups that end
    before it, so the wide columns are read for little more than the result.
    """
    times = rows.select("event_time").orderBy(F.desc("event_time")).limit(n)
    bound = times.agg(F.min("event_time")).scalar()
    late_enough = _from_month(rows, bound).where(F.col("event_time") >= bound)
    return late_enough.orderBy(F.desc("event_time"), *OLAP_KEY).limit(n)


def lake_range(
    lake: DataFrame,
    after: dt.datetime,
    columns: tuple[str, ...] = ("account_id", "message_body", "profanity_type", "timestamp"),
) -> DataFrame:
    """Columns of the lake rows later than ``after``.

    Plain files know nothing of the link between ``timestamp`` and its day, so
    the matching day bound is added for partition pruning where the day exists.
    """
    if LAKE_DAY in lake.columns:
        lake = lake.where(F.col(LAKE_DAY) >= F.lit(after.date()))
    bound = F.lit(after.isoformat()).cast("timestamp_ntz")
    return lake.where(F.col("timestamp") > bound).select(*columns)


def stored_size(spark: SparkSession, path: str) -> DataFrame:
    """Bytes and readable size of the files of a table, from their listing: no row is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    total = files.load(path).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    return total.withColumn("size", readable_size(F.col("bytes")))
