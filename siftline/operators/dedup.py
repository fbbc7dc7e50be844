"""Latest version of each message key."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.schema import OLAP_FIELDS, OLAP_KEY, OLAP_MONTH


def latest_versions(stored: DataFrame) -> DataFrame:
    """One row per key and month: newest ``inserted_at``, then newest batch.

    Deduplication never crosses a month, so a key whose event time moved to
    another month stays once in each. Remaining ties are settled by the full
    row. ``rank = 1`` lets Spark keep the best row per key in every map task
    before the shuffle, so a key with very many versions shuffles one row a task.
    """
    others = [c for c in OLAP_FIELDS if c not in OLAP_KEY]
    order = [F.desc("inserted_at"), F.desc("batch_id"), *(F.desc(c) for c in others)]
    versions = Window.partitionBy(OLAP_MONTH, *OLAP_KEY).orderBy(*order)
    return (
        stored.withColumn("_rank", F.row_number().over(versions))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )
