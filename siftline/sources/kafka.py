"""Log-topic source. Needs the Kafka connector on the class path to run."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from siftline.schema import CONSUMER_GROUP, INPUT_TOPIC


@dataclass(frozen=True)
class TopicSource:
    """Values of a topic, from the earliest offset on.

    ``bounded`` reads what is there now and ends. ``min_partitions`` cuts large
    topic partitions into more read tasks and ``max_offsets`` bounds a micro-batch,
    which also bounds what one batch keeps in memory and on disk. ``partitions`` reads
    only these of the topic, as one of ``per_partition`` does.
    """

    bootstrap_servers: str
    topic: str = INPUT_TOPIC
    group: str = CONSUMER_GROUP
    bounded: bool = False
    min_partitions: int | None = None
    max_offsets: int | None = None
    partitions: tuple[int, ...] = ()

    def per_partition(self, count: int) -> list[TopicSource]:
        """A source for each partition of the topic, for a clock per partition."""
        shared = self.max_offsets and max(1, self.max_offsets // count)
        return [replace(self, partitions=(n,), max_offsets=shared) for n in range(count)]

    def options(self) -> dict[str, str]:
        chosen = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "startingOffsets": "earliest",
            "kafka.group.id": self.group,
        }
        if self.partitions:
            chosen["assign"] = json.dumps({self.topic: list(self.partitions)})
        else:
            chosen["subscribe"] = self.topic
        if self.bounded:
            chosen["endingOffsets"] = "latest"
        if self.min_partitions:
            chosen["minPartitions"] = str(self.min_partitions)
        if self.max_offsets and not self.bounded:
            chosen["maxOffsetsPerTrigger"] = str(self.max_offsets)
        return chosen

    def __call__(self, spark: SparkSession) -> DataFrame:
        reader = spark.read if self.bounded else spark.readStream
        rows = reader.format("kafka").options(**self.options()).load()
        return rows.selectExpr(
            "CAST(value AS STRING) AS value", "partition AS source_partition", "offset"
        )
