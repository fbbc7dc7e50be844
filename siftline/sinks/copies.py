"""Copies of a table of batches, refreshed by partition with plain jobs.

The batches stay the truth. A copy holds, for each day or month, what a function makes of that partition's rows, and
with every row a mark of the batches it was made of. A refresh compares the marks, and overwrites only partitions that
have other batches now (dynamic partition overwrite). So nothing has to be remembered: a refresh that dies, or that a
slower one overwrites, leaves partitions whose mark is not that of the batches, and the next refresh makes them again.
Partitions are replaced one after another; one scheduler should run the refreshes of a table, and readers that must
never see a partition missing read the batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftline.sinks import files
from siftline.sinks.batches import BATCH_COLUMNS, strip_batch_columns

MADE_OF = "made_of"
MARK = T.StructField(MADE_OF, T.LongType())


def marks(rows: DataFrame, partition: str) -> DataFrame:
    """Partition and the mark of the batches that have rows in it; only partition columns are read."""
    names = [field.name for field in BATCH_COLUMNS]
    found = rows.select(partition, *names).distinct()
    return found.groupBy(partition).agg(F.bit_xor(F.xxhash64(*names)).alias(MADE_OF))


def stale_partitions(rows: DataFrame, copy: DataFrame, partition: str) -> DataFrame:
    """The marks of ``rows`` that the copy does not have."""
    now, then = marks(rows, partition).alias("now"), copy.select(partition, MADE_OF).distinct().alias("then")
    same = F.col(f"now.{partition}").eqNullSafe(F.col(f"then.{partition}")) & (F.col(f"now.{MADE_OF}") == F.col(f"then.{MADE_OF}"))
    return now.join(then, same, "left_anti")


def within(partition: str, values: list) -> Column:
    """The rows of these partitions, as a condition that prunes the scan."""
    known = F.col(partition).isin([v for v in values if v is not None])
    return known | F.col(partition).isNull() if None in values else known


def refresh(
    rows: DataFrame,
    path: str,
    schema: T.StructType,
    partition: T.StructField,
    make: Callable[[DataFrame], DataFrame],
    save: Callable[[DataFrame, str], None],
    whole: bool = False,
) -> list:
    """Bring the copy at ``path`` up to date; returns the partitions that were written.

    ``rows`` are committed batches with their batch columns, ``make`` turns the rows of whole partitions into those of
    the copy, and ``save`` must overwrite only partitions it has rows for. ``whole`` makes every partition again.
    What reaches the driver is one row for each partition, as many as its listing has folders.
    """
    spark, name = rows.sparkSession, partition.name
    due = marks(rows, name) if whole else stale_partitions(rows, read_copy(spark, path, schema, partition), name)
    found = due.collect()
    if not found:
        return []
    marked = F.broadcast(spark.createDataFrame(found, T.StructType([partition, MARK])).withColumnRenamed(name, "_of"))
    made = make(strip_batch_columns(rows.where(within(name, [row[0] for row in found]))))
    save(made.join(marked, F.col(name).eqNullSafe(F.col("_of"))).drop("_of"), path)
    return sorted((row[0] for row in found), key=str)


def read_copy(spark: SparkSession, path: str, schema: T.StructType, partition: T.StructField) -> DataFrame:
    """The rows of a copy with their partition and mark; none if it was never made."""
    full = T.StructType([*schema.fields, MARK, partition])
    if not files.exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)
