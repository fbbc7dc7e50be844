"""Time functions: strict instant parsing and the calendar buckets."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# An ISO-8601 instant in UTC: full date, seconds, optional fraction, literal Z.
# Years beyond four digits need a sign, four-digit years must not have a plus.
INSTANT_PATTERN = (
    r"^(\d{4}|-\d{4,10}|\+\d{5,10})-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d{0,9})?[Zz]$"
)


def parse_instant(text: Column) -> Column:
    """Timestamp of a strict UTC instant string, null for anything else.

    The plain cast also takes dates, offsets and zone-less times, so the pattern
    decides the format and the cast only checks the calendar. Two times the cast
    refuses are instants: midnight written as the end of a day is the start of
    the next, and a leap second counts as the second before it.
    """
    instant = F.upper(text)
    day_end = F.lit("T24:00:00")
    next_day = F.replace(instant, day_end, F.lit("T00:00:00")).try_cast("timestamp") + F.expr(
        "INTERVAL 1 DAY"
    )
    no_leap = F.replace(instant, F.lit("T23:59:60"), F.lit("T23:59:59"))
    return F.when(
        text.rlike(INSTANT_PATTERN),
        F.when(F.contains(instant, day_end), F.when(instant.rlike(r"T24:00:00(\.0*)?Z$"), next_day))
        .otherwise(no_leap.try_cast("timestamp")),
    )


def wall_clock(ts: Column) -> Column:
    """UTC wall clock (no zone) of a timestamp."""
    return ts.cast("timestamp_ntz")


def truncate(unit: str, ts: Column) -> Column:
    """Truncate to ``unit``, kept as a no-zone timestamp."""
    return wall_clock(F.date_trunc(unit, ts))


def month_number(ts: Column) -> Column:
    """Calendar month as the integer yyyymm."""
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("long")
