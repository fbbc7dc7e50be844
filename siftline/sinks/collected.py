"""A sink that collects messages as JSON lines with all-or-nothing batches, for jobs under test.

Tasks write files of their own under names nobody reads; the commit of a batch publishes the list of them in one
rename, an abort deletes them. A batch that is written again replaces its list. The folder must be one that
all machines see as a plain path.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from siftline.schema import MESSAGE_FIELDS, MESSAGE_SCHEMA


@dataclass
class _Written(WriterCommitMessage):
    file: str
    rows: int


class _Writer(DataSourceWriter):
    def __init__(self, folder: str, batch: str):
        self._folder, self._batch = folder, batch

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        name, count = f"part-{uuid.uuid4().hex}.json", 0
        with open(f"{self._folder}/{name}", "w", encoding="utf-8") as out:
            for row in iterator:
                out.write(json.dumps(row.asDict()) + "\n")
                count += 1
        return _Written(name, count)

    def commit(self, messages: list[_Written | None]) -> None:
        listed = f"{self._folder}/batch-{self._batch}"
        temporary = f"{listed}.{uuid.uuid4().hex}"
        Path(temporary).write_text("\n".join(m.file for m in messages if m and m.rows))
        os.replace(temporary, listed)

    def abort(self, messages: list[_Written | None]) -> None:
        for message in messages:
            if message:
                Path(self._folder, message.file).unlink(missing_ok=True)


class CollectedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "siftline_collected"

    def schema(self) -> T.StructType:
        return MESSAGE_SCHEMA

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["folder"], self.options["batch"])


@dataclass(frozen=True)
class Collected:
    """Collects what a job hands to one of its sinks."""

    folder: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        Path(self.folder).mkdir(parents=True, exist_ok=True)
        batch.sparkSession.dataSource.register(CollectedSource)
        out = batch.select(*MESSAGE_FIELDS).write.format(CollectedSource.name()).mode("append")
        out.option("folder", self.folder).option("batch", str(batch_id)).save()

    def files(self) -> list[str]:
        """The files of committed batches."""
        lists = sorted(p for p in Path(self.folder).glob("batch-*") if "." not in p.name)
        return [f"{self.folder}/{name}" for p in lists for name in p.read_text().split("\n") if name]

    def read(self, spark: SparkSession) -> DataFrame:
        files = self.files()
        return spark.read.schema(MESSAGE_SCHEMA).json(files) if files else spark.createDataFrame([], MESSAGE_SCHEMA)
