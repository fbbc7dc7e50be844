"""Injected and file sources. A source is any callable from a session to rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from siftline.schema import MESSAGE_FIELDS, MESSAGE_SCHEMA

Source = Callable[[SparkSession], DataFrame]

# Input of one micro-batch. A batch is kept until all sinks have it, so a backlog
# must not become one batch.
MAX_BATCH_BYTES = 64 * 1024**3


@dataclass(frozen=True)
class LineFiles:
    """JSON lines from files, as a batch or as a stream of bounded micro-batches."""

    path: str
    streaming: bool = True
    max_bytes: int = MAX_BATCH_BYTES

    def __call__(self, spark: SparkSession) -> DataFrame:
        if not self.streaming:
            return spark.read.text(self.path).select("value")
        reader = spark.readStream.option("maxBytesPerTrigger", self.max_bytes)
        return reader.text(self.path).select("value")


def messages(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    """A batch of messages from dictionaries; fields left out are null."""
    return spark.createDataFrame(
        [tuple(row.get(name) for name in MESSAGE_FIELDS) for row in rows], MESSAGE_SCHEMA
    )
