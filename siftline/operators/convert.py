"""Row projections: one instant parser, three answers to a missing or bad timestamp.

==============  ====================  =====================  ====================
timestamp       event time            lake row               analytics row
==============  ====================  =====================  ====================
valid           the instant           the instant (us)       the instant (ms)
null            ingest time           ingest time            ingest time
empty or bad    ingest time           blank ``ERROR`` row    ingest time
==============  ====================  =====================  ====================

``ingest_ts`` is always a column taken once per micro-batch, so that a retry
writes the same rows again.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions.instants import month_number, parse_instant, truncate, wall_clock
from siftline.schema import ERROR_STATUS, LAKE_DAY, MESSAGE_FIELDS, OLAP_FIELDS, OLAP_MONTH, SAFE

STRING_FIELDS = tuple(f for f in MESSAGE_FIELDS if f not in ("timestamp", "profanity_type"))


def event_time(timestamp: Column, ingest_ts: Column) -> Column:
    """Event time at the source: the instant, else the ingest time."""
    return F.coalesce(parse_instant(timestamp), ingest_ts)


def lake_rows(classified: DataFrame, ingest_ts: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Lake projection; a timestamp that is present but not an instant blanks the row."""
    parsed = parse_instant(F.col("timestamp"))
    usable = F.col("timestamp").isNull() | parsed.isNotNull()
    columns = {
        name: F.when(usable, F.coalesce(F.col(name), F.lit(""))).otherwise(
            F.lit(ERROR_STATUS if name == "message_status" else "")
        )
        for name in STRING_FIELDS
    }
    columns["timestamp"] = wall_clock(F.coalesce(parsed, ingest_ts))
    columns["profanity_type"] = F.when(
        usable, F.coalesce(F.col("profanity_type"), F.lit(SAFE))
    ).otherwise(F.lit(SAFE))
    return classified.select(*(columns[name].alias(name) for name in MESSAGE_FIELDS), *keep)


def with_lake_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn(LAKE_DAY, F.to_date("timestamp"))


def olap_rows(
    classified: DataFrame, ingest_ts: Column, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Analytics projection; a bad timestamp only replaces the time."""
    columns = {name: F.coalesce(F.col(name), F.lit("")) for name in STRING_FIELDS}
    columns["event_time"] = truncate("millisecond", event_time(F.col("timestamp"), ingest_ts))
    columns["profanity_type"] = F.coalesce(F.col("profanity_type"), F.lit(SAFE))
    return classified.select(*(columns[name].alias(name) for name in OLAP_FIELDS), *keep)


def with_event_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn(OLAP_MONTH, month_number(F.col("event_time")))
