"""Analytics sink: every message, by month, sorted by key, deduplicated on read."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftline.functions.instants import truncate
from siftline.operators.convert import olap_rows, with_event_month
from siftline.operators.dedup import latest_versions
from siftline.schema import (
    OLAP_FIELDS,
    OLAP_KEY,
    OLAP_MONTH,
    OLAP_STORED_SCHEMA,
    OLAP_TABLE,
)
from siftline.sinks import batches, copies
from siftline.sinks.layout import HASH, TARGET_FILE_BYTES, bytes_per_row, distribute, sized, target_file_size

MONTH_FIELD = T.StructField(OLAP_MONTH, T.IntegerType())


def stored_rows(batch: DataFrame, batch_id: int) -> DataFrame:
    """Analytics rows with their insert time and batch.

    The insert time has second precision and comes from the batch, so a retry
    repeats it.
    """
    visible = olap_rows(batch, F.col("ingest_ts"), keep=("ingest_ts",))
    return visible.select(
        *OLAP_FIELDS,
        truncate("second", F.col("ingest_ts")).alias("inserted_at"),
        F.lit(batch_id).cast("long").alias("batch_id"),
    )


@dataclass(frozen=True)
class JdbcOlap:
    """The same rows into a table of a database, which sets the insert time itself.

    At least once: a retried batch may repeat rows, and the table deduplicates. The table
    must exist, as one made from the rows would have no months, key or versions.
    """

    url: str
    user: str
    password: str
    table: str = OLAP_TABLE
    rows_per_insert: int = 5000
    writers: int = 16

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "dbtable": self.table,
            "batchsize": str(self.rows_per_insert),
            "isolationLevel": "NONE",
            "numPartitions": str(self.writers),
        }

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Reading the schema fails if there is no such table.
        spark.read.format("jdbc").options(**self.options()).load()
        rows = olap_rows(batch, F.col("ingest_ts"))
        rows.write.format("jdbc").options(**self.options()).mode("append").save()


@dataclass(frozen=True)
class OlapSink:
    root: str
    table: str = OLAP_TABLE
    file_bytes: int = TARGET_FILE_BYTES
    # Go by the bytes a row took in the newest batches, not by its size before encoding.
    measured: bool = False

    @property
    def path(self) -> str:
        return f"{self.root}/{self.table}"

    @property
    def merged(self) -> str:
        """Name of the table that ``merge`` keeps."""
        return f"{self.table}_merged"

    @property
    def merged_path(self) -> str:
        return f"{self.root}/{self.merged}"

    def __call__(self, batch: DataFrame, batch_id: int) -> dict[str, int | None]:
        return {"olap": self.append_stored(stored_rows(batch, batch_id), batch_id)}

    def append_stored(self, rows: DataFrame, batch_id: int) -> int | None:
        """Append rows that already have the stored columns; how many, unless the batch was there already."""
        rows = with_event_month(rows)
        return batches.write_counted(rows.sparkSession, self.path, batch_id, rows, self._save)

    def _save(self, rows: DataFrame, to: str, by_month: bool = False) -> None:
        """Overwrite ``to``, or the months of ``rows`` in it, in files sorted by key."""
        spark = rows.sparkSession
        taken = bytes_per_row(spark, self.path, batches.newest(spark, self.path), self.file_bytes) if self.measured else None
        with target_file_size(spark, self.file_bytes):
            spread = sized(rows, OLAP_MONTH, max(1, round(self.file_bytes / taken))) if taken else distribute(rows, HASH, OLAP_MONTH, OLAP_KEY)
            ordered = spread.sortWithinPartitions(OLAP_MONTH, *OLAP_KEY)
            batches.save_partitions(ordered, OLAP_MONTH, to, only_theirs=by_month)

    def _batches(self, spark: SparkSession) -> DataFrame:
        return batches.read_batches(spark, self.path, OLAP_STORED_SCHEMA, (MONTH_FIELD,))

    def read_all(self, spark: SparkSession) -> DataFrame:
        """Every stored version, with ``inserted_at``, ``batch_id`` and the month."""
        return batches.strip_batch_columns(self._batches(spark))

    def read(self, spark: SparkSession) -> DataFrame:
        """The visible columns of the latest versions, and their month for pruning.

        A condition on the month reaches the scan, as versions never leave theirs.
        """
        return latest_versions(self.read_all(spark)).select(*OLAP_FIELDS, OLAP_MONTH)

    def merge(self, spark: SparkSession, whole: bool = False) -> list[int]:
        """Bring the merged table up to date: latest versions only, in files of the target size sorted by key.

        Versions never leave their month, so only months with new batches are written again, or all with ``whole``;
        returns them.
        """
        save = partial(self._save, by_month=True)
        return copies.refresh(self._batches(spark), self.merged_path, OLAP_STORED_SCHEMA, MONTH_FIELD, latest_versions, save, whole)

    def read_merged(self, spark: SparkSession) -> DataFrame:
        """The merged table as the last ``merge`` left it: one row a key and month, with the month."""
        return copies.read_copy(spark, self.merged_path, OLAP_STORED_SCHEMA, MONTH_FIELD).drop(copies.MADE_OF)
