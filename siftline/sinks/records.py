"""The feed as records of a topic, and its reading without the duplicates that retries leave.

A topic cannot be written exactly once: a batch that failed half-way is sent again. Each message therefore carries, in
headers beside its unchanged value, the query and batch it is of and the place of its row in the source, which a
replay repeats. Readers drop repeats of that key; how long they remember is bounded by a watermark on the time the
batch was made, which a replay repeats too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftline.operators.decode import encode_json
from siftline.sinks.batches import current_stream

# Names of the headers.
QUERY, BATCH, ROW, SENT = "query", "batch", "row", "sent"
POSITION = ("source_partition", "offset")

# How much later than its first sending a repeat may come.
REMEMBERED = "1 day"

RECORD = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("headers", T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]))),
    ]
)


def records(batch: DataFrame, batch_id: int) -> DataFrame:
    """(value, headers): the messages of a batch as a topic takes them.

    A row whose place in the source is not known has no key, and its repeats cannot be told from new rows.
    """
    placed = all(c in batch.columns for c in POSITION)
    row = F.when(F.col(POSITION[0]).isNotNull() & F.col(POSITION[1]).isNotNull(), F.concat_ws("-", *POSITION)) if placed else F.lit(None)
    texts = {
        QUERY: F.lit(current_stream(batch.sparkSession)),
        BATCH: F.lit(str(batch_id)),
        ROW: row,
        SENT: F.unix_micros("ingest_ts").cast("string"),
    }
    given = [F.struct(F.lit(k).alias("key"), v.cast("string").cast("binary").alias("value")) for k, v in texts.items()]
    headers = F.filter(F.array(*given), lambda h: h["value"].isNotNull())
    return encode_json(batch.withColumn("_headers", headers), "_headers").withColumnRenamed("_headers", "headers")


def header(name: str) -> Column:
    """The text of a record's header, null if it has none."""
    return F.try_element_at(F.filter("headers", lambda h: h["key"] == name), F.lit(1))["value"].cast("string")


def without_repeats(feed: DataFrame, remembered: str = REMEMBERED) -> DataFrame:
    """(value, sent) of the records of a stream or table, each row of a batch once.

    A stream forgets keys once their ``sent`` is ``remembered`` behind the newest; a repeat after that would come
    through. Records without a key are all kept.
    """
    key = F.when(header(ROW).isNotNull(), F.concat_ws("/", header(QUERY), header(BATCH), header(ROW)))
    sent = F.timestamp_micros(header(SENT).cast("long"))
    known = feed.select(F.col("value").cast("string").alias("value"), sent.alias("sent"), key.alias("_key"))
    keyed = known.where("_key IS NOT NULL")
    if feed.isStreaming:
        once = keyed.withWatermark("sent", remembered).dropDuplicatesWithinWatermark(["_key"])
    else:
        once = keyed.dropDuplicates(["_key"])
    return once.unionByName(known.where("_key IS NULL")).drop("_key")


@dataclass(frozen=True)
class RecordFiles:
    """Records in files as a topic would hold them: at least once, a retried batch appends again."""

    path: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        records(batch, batch_id).hint("rebalance").write.mode("append").parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(RECORD).parquet(self.path)

    def read_stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.schema(RECORD).parquet(self.path)
