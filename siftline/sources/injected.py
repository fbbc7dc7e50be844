"""Injected messages as a stream with partitions and offsets, for jobs under test.

The rows travel with the source to the tasks, so they are few. What is released grows from run to run
(``upto``): a query that starts again from its checkpoint finds its place by the offsets.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from siftline.schema import MESSAGE_FIELDS, MESSAGE_SCHEMA

INJECTED_SCHEMA = T.StructType(
    [*MESSAGE_SCHEMA.fields, T.StructField("source_partition", T.IntegerType()), T.StructField("offset", T.LongType())]
)


class _Span(InputPartition):
    """Offsets ``start`` to ``end``, without it, of a partition."""

    def __init__(self, partition: int, start: int, end: int):
        self.partition, self.start, self.end = partition, start, end


class _Reader(DataSourceStreamReader):
    def __init__(self, rows: list[tuple], partitions: int, upto: int):
        self._rows, self._partitions, self._upto = rows, partitions, upto

    def initialOffset(self) -> dict:
        return {str(p): 0 for p in range(self._partitions)}

    def latestOffset(self) -> dict:
        return {str(p): len(range(p, self._upto, self._partitions)) for p in range(self._partitions)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        spans = (_Span(p, start[str(p)], end[str(p)]) for p in range(self._partitions))
        return [s for s in spans if s.end > s.start]

    def read(self, partition: _Span) -> Iterator[tuple]:
        for offset in range(partition.start, partition.end):
            yield (*self._rows[offset * self._partitions + partition.partition], partition.partition, offset)


class _Source(DataSource):
    rows: list[tuple] = []
    shares: int = 1
    upto: int = 0

    def schema(self) -> T.StructType:
        return INJECTED_SCHEMA

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _Reader(self.rows, self.shares, self.upto)


@dataclass(frozen=True)
class Injected:
    """A source of the given messages, dealt in turn over ``partitions``; the first ``upto`` are released, or all."""

    rows: Sequence[dict]
    partitions: int = 2
    upto: int | None = None

    def __call__(self, spark: SparkSession) -> DataFrame:
        name = f"injected_{uuid.uuid4().hex}"
        rows = [tuple(row.get(field) for field in MESSAGE_FIELDS) for row in self.rows]
        released = len(rows) if self.upto is None else min(self.upto, len(rows))
        made = {"rows": rows, "shares": self.partitions, "upto": released, "name": classmethod(lambda cls: name)}
        spark.dataSource.register(type("InjectedSource", (_Source,), made))
        return spark.readStream.format(name).load()
