"""Moderation feed: the profane messages as JSON, to a topic or to files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from siftline.operators.decode import encode_json
from siftline.schema import FEED_TOPIC
from siftline.sinks.batches import read_batches, read_text_batches, strip_batch_columns, write_counted, write_once
from siftline.sinks.records import records


@dataclass(frozen=True)
class TopicFeed:
    """Kafka topic, at least once: a retried batch may repeat messages, which ``without_repeats`` drops on reading."""

    bootstrap_servers: str
    topic: str = FEED_TOPIC

    def options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "topic": self.topic,
            "kafka.acks": "all",
        }

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        records(batch, batch_id).write.format("kafka").options(**self.options()).save()


@dataclass(frozen=True)
class FileFeed:
    """JSON lines in one folder per micro-batch."""

    path: str

    def __call__(self, batch: DataFrame, batch_id: int) -> dict[str, int | None]:
        # Few rows come from many tasks: gather them into few files.
        def save(rows: DataFrame, to: str) -> None:
            rows.hint("rebalance").write.mode("overwrite").text(to)

        return {"feed": write_counted(batch.sparkSession, self.path, batch_id, encode_json(batch), save)}

    def read(self, spark: SparkSession) -> DataFrame:
        return read_text_batches(spark, self.path)


@dataclass(frozen=True)
class RejectFiles:
    """Quarantined input values with the reason, as JSON lines."""

    path: str

    def __call__(self, batch: DataFrame, batch_id: int) -> dict[str, int | None]:
        def save(rows: DataFrame, to: str) -> None:
            rows.hint("rebalance").write.mode("overwrite").json(to)

        kept = batch.select("value", "reason", "ingest_ts")
        return {"rejects": write_counted(batch.sparkSession, self.path, batch_id, kept, save)}

    def read(self, spark: SparkSession) -> DataFrame:
        lines = read_text_batches(spark, self.path)
        return lines.selectExpr(
            "from_json(value, 'value string, reason string, ingest_ts timestamp') AS r"
        ).select("r.*")


@dataclass(frozen=True)
class RowFiles:
    """Rows of one schema as Parquet, one folder per micro-batch: late rows, closed windows."""

    path: str
    schema: T.StructType

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        out = batch.select(*self.schema.names).hint("rebalance").write.mode("overwrite")
        write_once(batch.sparkSession, self.path, batch_id, out.parquet)

    def read(self, spark: SparkSession) -> DataFrame:
        return strip_batch_columns(read_batches(spark, self.path, self.schema))
