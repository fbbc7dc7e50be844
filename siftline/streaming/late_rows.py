"""Late rows of a stream to an output of their own, judged by the clock of their source partition.

The newest event time of each source partition lives in the state store. A micro-batch brings a partition's
rows to one task, as its source does, and only their positions, times and the columns asked for: what a task
holds is narrow and bounded by the batch, which the source bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from siftline.operators.late import ALLOWED_LATENESS
from siftline.session import prepare

_NEVER = np.iinfo(np.int64).min // 2


def _micros(delay: str) -> int:
    return pd.Timedelta(delay) // pd.Timedelta(microseconds=1)


def late_rows(
    arrived: DataFrame,
    source: str = "source_partition",
    arrival: str = "offset",
    delay: str = ALLOWED_LATENESS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The rows of a stream that are late on arrival: place, ``event_ts``, ``watermark`` and the columns in ``keep``.

    Rows arrive in the order of their batches, inside a batch by ``arrival``; the watermark is the newest event
    time so far in the same source, less the delay. These are the rows ``mark_late`` marks. A row without a source,
    a place or an event time is never late.
    """
    behind = _micros(delay)
    columns = list(dict.fromkeys([source, arrival, *keep]))
    placed = F.col(source).isNotNull() & F.col(arrival).isNotNull() & F.col("event_ts").isNotNull()
    # Times go as numbers: pandas holds only some centuries.
    narrow = arrived.where(placed).select(*columns, F.unix_micros("event_ts").alias("_at"))
    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    out = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", _at long, _mark long"

    def advance(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        newest = state.get[0] if state.exists else _NEVER
        rows = pd.concat(chunks, ignore_index=True).sort_values(arrival, kind="stable")
        at = rows["_at"].to_numpy(np.int64)
        seen = np.maximum.accumulate(np.maximum(at, newest))
        state.update((int(seen[-1]),))
        rows["_mark"] = seen - behind
        yield rows[at < seen - behind]

    marked = narrow.groupBy(source).applyInPandasWithState(advance, out, "newest long", "append", GroupStateTimeout.NoTimeout)
    return marked.select(*columns, F.timestamp_micros("_at").alias("event_ts"), F.timestamp_micros("_mark").alias("watermark"))


def start_late_rows(
    spark: SparkSession,
    arrived: Callable[[SparkSession], DataFrame],
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval_ms: int | None = None,
    keep: tuple[str, ...] = (),
    name: str = "late_rows",
) -> StreamingQuery:
    """Hand the late rows of each micro-batch to ``sink``; without an interval take what is there and end.

    ``arrived`` gives messages with their place and ``event_ts``, as ``arrivals`` makes them.
    """
    prepare(spark)
    trigger = {"availableNow": True} if interval_ms is None else {"processingTime": f"{interval_ms} milliseconds"}
    writer = late_rows(arrived(spark), keep=keep).writeStream.queryName(name).outputMode("append").foreachBatch(sink)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
