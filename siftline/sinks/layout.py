"""How rows are spread over tasks, and so over files, before a partitioned write."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import RLock

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Distribution modes and the default file size of 128 MiB.
HASH = "HASH"
NONE = "NONE"
RANGE = "RANGE"
TARGET_FILE_BYTES = 134_217_728

_TURNS: dict[str, RLock] = {}


def distribute(
    rows: DataFrame,
    mode: str,
    partition: str,
    sort: tuple[str, ...],
    writers: int | None = None,
) -> DataFrame:
    """Spread ``rows`` by ``mode``.

    HASH brings a partition's rows together, except that adaptive execution cuts
    a partition larger than the target file size into several tasks, so one day
    with a third of the rows is not one task. RANGE orders rows by the partition
    and the ``sort`` columns, which cuts a large partition too; the task a row
    comes from is the last key, so that even equal rows can be cut. NONE leaves
    rows where they are. With ``writers`` the number of write tasks is fixed.
    """
    mode = mode.upper()
    if mode == NONE:
        return rows.repartition(writers) if writers else rows
    if mode == HASH:
        return rows.hint("rebalance", *([writers] if writers else []), partition)
    if mode == RANGE:
        keys = (*([writers] if writers else []), partition, *sort, "_from")
        numbered = rows.withColumn("_from", F.spark_partition_id())
        return numbered.repartitionByRange(*keys).drop("_from")
    raise ValueError(f"unknown distribution mode {mode}")


def bytes_per_row(spark: SparkSession, table: str, paths: list[str], like: int) -> float | None:
    """What a row takes on storage in these folders of Parquet files below ``table``, from their listing and footers; None without rows.

    Large files take less for a row than small ones, so files of half to twice ``like`` bytes decide if there are any.
    """
    if not paths:
        return None
    found = spark.read.option("basePath", table).parquet(*paths).groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count("*").alias("n"))
    alike = F.col("file_size").between(like // 2, like * 2)
    shares = [F.sum(F.when(alike, F.col("file_size"))) / F.sum(F.when(alike, F.col("n"))), F.sum("file_size") / F.sum("n")]
    return found.agg(F.coalesce(*shares)).first()[0]


def sized(rows: DataFrame, partition: str, rows_per_file: int) -> DataFrame:
    """Spread ``rows`` so that each partition of the write becomes files of about ``rows_per_file`` rows.

    A partition of 1.5 times as many rows or more is dealt evenly to as many tasks as come closest, whatever its
    share of all rows; smaller ones stay whole, and tasks take several of them. ``rows`` are read twice: keep them.
    What reaches the driver is one row for each partition of the write.
    """
    sizes = rows.groupBy(partition).agg(F.count("*").alias("n")).withColumn("_files", F.greatest(F.lit(1), F.round(F.col("n") / rows_per_file)))
    large = F.col("_files") > 1
    before = Window.partitionBy(large).orderBy(partition).rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum(F.when(large, F.col("_files")).otherwise(F.col("n") / rows_per_file)).over(before), F.lit(0))
    placed = sizes.select(partition, F.col("_files").cast("long"), F.floor(taken).alias("_first"), large.alias("_large")).collect()
    if not placed:
        return rows
    tasks_large = sum(row["_files"] for row in placed if row["_large"])
    tasks = tasks_large + 1 + max((row["_first"] for row in placed if not row["_large"]), default=-1)
    places = [(row[0], row["_files"], row["_first"] + (0 if row["_large"] else tasks_large)) for row in placed]
    schema = T.StructType([T.StructField("_part", rows.schema[partition].dataType), *(T.StructField(c, T.LongType()) for c in ("_files", "_first"))])
    marked = rows.join(F.broadcast(rows.sparkSession.createDataFrame(places, schema)), F.col(partition).eqNullSafe(F.col("_part")))
    task = F.col("_first") + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_files"))
    return marked.repartitionById(tasks, task.cast("int")).drop("_part", "_files", "_first")


@contextmanager
def target_file_size(spark: SparkSession, n_bytes: int) -> Iterator[None]:
    """Aim writes at files of ``n_bytes`` (advisory, measured before file encoding; ``sized`` goes by what files took).

    The setting belongs to the session, so writers that share one take turns; every
    stream has a session of its own.
    """
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    with _TURNS.setdefault(spark._jsparkSession.sessionUUID(), RLock()):
        before = spark.conf.get(key)
        spark.conf.set(key, str(n_bytes))
        try:
            yield
        finally:
            spark.conf.set(key, before)
