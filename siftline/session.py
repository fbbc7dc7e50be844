"""Session settings every job and query here relies on."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings, safe to apply to a session somebody else created.
RUNTIME_CONF = {
    # Instants become no-zone wall clocks by a cast, which follows this zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A JSON object that repeats a key keeps the last value instead of failing.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, for checkpoints and job output.

    Lives under the cluster's ``spark.checkpoint.dir``. Only a local-mode session
    without that setting may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="siftline-")
    return f"{base.rstrip('/')}/siftline/{purpose}-{uuid.uuid4().hex}"
