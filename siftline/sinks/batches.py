"""Tables made of micro-batch folders that can be written again without harm.

``<table>/stream_id=S/batch=N/<partition>=…`` holds micro-batch N of stream S. A
batch counts once its folder has the committer's success mark; a retry of a
counted batch does nothing and a retry of a half-written one replaces it. The
stream id keeps two streams, or a stream restarted from nothing, apart.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftline.sinks import files

SUCCESS = "_SUCCESS"
DIRECT = "direct"

BATCH_COLUMNS = (T.StructField("stream_id", T.StringType()), T.StructField("batch", T.LongType()))

_STREAM = "sql.streaming.queryId"


def current_stream(spark: SparkSession) -> str:
    """Id of the streaming query now running on this thread; it survives restarts."""
    return spark.sparkContext.getLocalProperty(_STREAM) or DIRECT


@contextmanager
def as_stream(spark: SparkSession, stream_id: str) -> Iterator[None]:
    """Write batches as this stream does: a batch id that is committed is skipped."""
    before = spark.sparkContext.getLocalProperty(_STREAM)
    spark.sparkContext.setLocalProperty(_STREAM, stream_id)
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty(_STREAM, before)


def fresh_id() -> int:
    """A number nobody has used for a batch."""
    return time.time_ns() // 1000 * 1000 + random.randrange(1000)


def batch_dir(table: str, stream_id: str, batch_id: int) -> str:
    return f"{table}/stream_id={stream_id}/batch={batch_id}"


def write_once(spark: SparkSession, table: str, batch_id: int, save: Callable[[str], None]) -> bool:
    """Let ``save`` write the folder of this batch unless it is already committed.

    ``save`` must overwrite, which clears what a lost attempt left behind. Outside
    a stream nothing is a retry, so a batch id that is used is an error.
    """
    stream = current_stream(spark)
    target = batch_dir(table, stream, batch_id)
    if files.exists(spark, f"{target}/{SUCCESS}"):
        if stream == DIRECT:
            raise FileExistsError(f"{target} is written; new rows need a new batch id")
        return False
    save(target)
    return True


def write_counted(spark: SparkSession, table: str, batch_id: int, rows: DataFrame, save: Callable[[DataFrame, str], None]) -> int | None:
    """``write_once``, and how many rows it wrote as the write itself saw them; None if the batch was there already."""
    seen = Observation()
    counted = rows.observe(seen, F.count("*").alias("n"))
    return taken(seen, ("n",))["n"] if write_once(spark, table, batch_id, lambda to: save(counted, to)) else None


def taken(seen: Observation, names: tuple[str, ...]) -> dict[str, int]:
    """Observed counts. Adaptive execution cuts off a branch once a stage of it had no row, and the counts with it: they are 0."""
    try:
        return seen.get
    except Py4JJavaError as failure:
        if "AssertionError" not in failure.java_exception.getClass().getName():
            raise
        return dict.fromkeys(names, 0)


def committed(spark: SparkSession, table: str) -> list[str]:
    """Batch folders that make up the table now, relative to it."""
    marks = files.matching(spark, f"{table}/stream_id=*/batch=*/{SUCCESS}")
    return ["/".join(mark.split("/")[-3:-1]) for mark in marks]


def newest(spark: SparkSession, table: str, n: int = 3) -> list[str]:
    """Paths of the ``n`` committed batches with the highest numbers."""
    found = sorted(committed(spark, table), key=lambda folder: int(folder.rsplit("=", 1)[1]))
    return [f"{table}/{folder}" for folder in found[-n:] if partitions_of(spark, table, folder)]


def partitions_of(spark: SparkSession, table: str, folder: str) -> list[str]:
    """The partition folders of a batch folder, relative to the table."""
    return [f"{folder}/{p.rsplit('/', 1)[1]}" for p in files.matching(spark, f"{table}/{folder}/*=*")]


def read_batches(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partitions: tuple[T.StructField, ...] = (),
) -> DataFrame:
    """The committed rows of a parquet table, its partition columns included."""
    full = T.StructType([*schema.fields, *BATCH_COLUMNS, *partitions])
    folders = committed(spark, table)
    if not folders:
        return spark.createDataFrame([], full)
    paths = [f"{table}/{folder}" for folder in folders]
    return spark.read.schema(full).option("basePath", table).parquet(*paths)


def read_text_batches(spark: SparkSession, table: str) -> DataFrame:
    """The committed ``value`` lines of a text table."""
    folders = committed(spark, table)
    if not folders:
        return spark.createDataFrame([], "value string")
    return spark.read.text([f"{table}/{folder}" for folder in folders]).select("value")


def save_partitions(rows: DataFrame, partition: str, to: str, only_theirs: bool = False) -> None:
    """Overwrite the folder ``to``, or in it ``only_theirs``, the partitions that ``rows`` have."""
    mode = "dynamic" if only_theirs else "static"
    rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(partition).parquet(to)


def strip_batch_columns(rows: DataFrame) -> DataFrame:
    return rows.drop(*(field.name for field in BATCH_COLUMNS))
