"""Lake sink: two day-partitioned tables, chosen by the tag of the row."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftline.operators.convert import lake_rows, with_lake_day
from siftline.schema import LAKE_DAY, LAKE_SCHEMA, POSITION, POSITION_SCHEMA, PROFANE_TABLE, PROFANITY, SAFE_TABLE
from siftline.sinks import batches, copies
from siftline.sinks.layout import HASH, RANGE, TARGET_FILE_BYTES, bytes_per_row, distribute, sized, target_file_size

DAY_FIELD = T.StructField(LAKE_DAY, T.DateType())
TABLES = (PROFANE_TABLE, SAFE_TABLE)
SORT = ("timestamp", "message_id")


def table_of(profanity_type: Column) -> Column:
    """Name of the table a row goes to: profane rows to theirs, everything else to safe."""
    return F.when(profanity_type == PROFANITY, PROFANE_TABLE).otherwise(SAFE_TABLE)


def compacted(table: str) -> str:
    """Name of the copy of a table that ``compact`` keeps."""
    return f"{table}_compacted"


def route(rows: DataFrame) -> dict[str, DataFrame]:
    return {name: rows.where(table_of(F.col("profanity_type")) == name) for name in TABLES}


@dataclass(frozen=True)
class LakeSink:
    root: str
    distribution: str = HASH
    file_bytes: int = TARGET_FILE_BYTES
    writers: int | None = None
    # Go by the bytes a row took in the newest batches, not by its size before encoding (HASH without ``writers``).
    measured: bool = False
    # Lay a day's rows out by their place in the source: its files in the order of their names hold a source's rows as they came.
    in_order: bool = False

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def __call__(self, batch: DataFrame, batch_id: int) -> dict[str, int | None]:
        place = POSITION if set(POSITION) <= set(batch.columns) else ()
        rows = with_lake_day(lake_rows(batch, F.col("ingest_ts"), keep=place))
        return {
            table: batches.write_counted(batch.sparkSession, self.path(table), batch_id, part, partial(self._save, table))
            for table, part in route(rows).items()
        }

    def _save(self, table: str, rows: DataFrame, to: str, by_day: bool = False) -> None:
        """Overwrite ``to``, or the days of ``rows`` in it."""
        spark, place = rows.sparkSession, POSITION if POSITION[0] in rows.columns else ()
        ordered = self.in_order and bool(place)
        wanted = self.measured and not ordered and self.distribution.upper() == HASH and not self.writers
        taken = bytes_per_row(spark, self.path(table), batches.newest(spark, self.path(table)), self.file_bytes) if wanted else None
        with target_file_size(spark, self.file_bytes):
            if taken:
                spread = sized(rows, LAKE_DAY, max(1, round(self.file_bytes / taken)))
            else:
                spread = distribute(rows, RANGE if ordered else self.distribution, LAKE_DAY, place if ordered else SORT, self.writers)
            if place:
                spread = spread.sortWithinPartitions(LAKE_DAY, *place)
            batches.save_partitions(spread, LAKE_DAY, to, only_theirs=by_day)

    def compact(self, spark: SparkSession, table: str, whole: bool = False) -> list[dt.date]:
        """Bring the compacted copy of a table up to date: the same rows, a day in files of the target size.

        Only days with new batches are written again, or all with ``whole``; returns them.
        """
        save = partial(self._save, table, by_day=True)
        return copies.refresh(self._batches(spark, table), self.compacted_path(table), LAKE_SCHEMA, DAY_FIELD, lambda rows: rows, save, whole)

    def compacted_path(self, table: str) -> str:
        return f"{self.root}/{compacted(table)}"

    def _batches(self, spark: SparkSession, table: str) -> DataFrame:
        return batches.read_batches(spark, self.path(table), LAKE_SCHEMA, (DAY_FIELD,))

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The table's columns and its day, for pruning."""
        return batches.strip_batch_columns(self._batches(spark, table))

    def read_as_stored(self, spark: SparkSession, table: str) -> DataFrame:
        """Rows with their place in the source, null where it brought none, and ``stored``: what orders them as in the files."""
        full = T.StructType([*LAKE_SCHEMA.fields, *POSITION_SCHEMA.fields])
        rows = batches.read_batches(spark, self.path(table), full, (DAY_FIELD,))
        file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
        task = F.regexp_extract(file, r"/part-(\d+)-[^/]*$", 1).cast("int")  # as a number: names have five digits or more
        stored = F.struct("stream_id", "batch", task.alias("task"), file.alias("file"), row.alias("row"))
        return batches.strip_batch_columns(rows.withColumn("stored", stored))

    def read_compacted(self, spark: SparkSession, table: str) -> DataFrame:
        """The compacted copy as the last ``compact`` left it."""
        return copies.read_copy(spark, self.compacted_path(table), LAKE_SCHEMA, DAY_FIELD).drop(copies.MADE_OF)
