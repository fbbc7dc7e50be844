"""Small helpers of the operators."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from siftline.session import shared_dir


BATCH_ROWS = 2_000
SLICE_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends there, and no later job repeats the work."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, rows: int = BATCH_ROWS):
    """The rows of a batch, so many at a time: what is made of them in Python stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def text_slices(batch: pa.RecordBatch, name: str = "text", most: int = SLICE_BYTES):
    """The rows of a batch in runs of about so many bytes of text; a longer text is in a run of its own or ends one."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    share = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(a, b - a)


def per_batch(
    df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], dict]], rows: int = BATCH_ROWS
) -> DataFrame:
    """Run ``make()`` once in each task and the function it returns on each slice of an Arrow batch."""

    def run(batches):
        function = make()
        for batch in batches:
            for part in slices(batch, rows):
                yield pa.RecordBatch.from_pydict(function(part))

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column, null as the empty text."""
    return [x or "" for x in batch.column(name).to_pylist()]


def lists(chunks: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """One list per array, without a Python object per element."""
    offsets = np.zeros(len(chunks) + 1, np.int32)
    np.cumsum([len(c) for c in chunks], out=offsets[1:])
    flat = np.concatenate(chunks) if chunks else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))
