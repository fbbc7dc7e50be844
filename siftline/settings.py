"""Job settings from environment variables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from siftline.schema import OLAP_TABLE
from siftline.sinks.layout import HASH, TARGET_FILE_BYTES
from siftline.streaming.job import INTERVAL_MS, PROMPT_MS
from siftline.streaming.supervise import PAUSE_MS, TOLERATED_FAILURES

# Messages per micro-batch. A batch is kept until all sinks have it, so a backlog
# must not become one batch.
MAX_OFFSETS = 50_000_000


@dataclass(frozen=True)
class Settings:
    """``olap_url`` sends analytics rows to a database instead of files.

    Without ``warehouse`` the tables lie in the session's own warehouse folder.
    """

    bootstrap_servers: str
    job_name: str
    interval_ms: int
    prompt_ms: int
    checkpoint: str | None
    warehouse: str | None
    namespace: str
    distribution: str
    file_bytes: int
    writers: int | None
    olap_database: str
    olap_table: str
    olap_url: str | None
    olap_user: str
    olap_password: str
    max_offsets: int
    words_path: str | None
    decode_mode: str
    tolerated_failures: int = TOLERATED_FAILURES
    pause_ms: int = PAUSE_MS

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Settings:
        # Variable names and defaults of the deployed job. Those
        # from SIFTLINE_ on are ours.
        writers = env.get("WRITE_PARALLELISM")
        return cls(
            bootstrap_servers=env.get("KAFKA_BOOTSTRAP_SERVERS", "broker:29092"),
            job_name=env.get("JOB_NAME", "message_screening"),
            interval_ms=int(env.get("CHECKPOINT_INTERVAL", INTERVAL_MS)),
            prompt_ms=int(env.get("SIFTLINE_PROMPT_INTERVAL", PROMPT_MS)),
            checkpoint=env.get("CHECKPOINTS_DIRECTORY"),
            namespace=env.get("ICEBERG_NAMESPACE", "raw_data"),
            distribution=env.get("ICEBERG_DISTRIBUTION_MODE", HASH),
            file_bytes=int(env.get("ICEBERG_TARGET_FILE_SIZE_BYTES", TARGET_FILE_BYTES)),
            writers=int(writers) if writers else None,
            olap_database=env.get("CLICKHOUSE_DATABASE", "default"),
            olap_table=env.get("CLICKHOUSE_TABLE", OLAP_TABLE),
            olap_url=env.get("CLICKHOUSE_JDBC_URL"),
            olap_user=env.get("CLICKHOUSE_USER", "default"),
            olap_password=env.get("CLICKHOUSE_PASSWORD", ""),
            max_offsets=int(env.get("SIFTLINE_MAX_OFFSETS", MAX_OFFSETS)),
            warehouse=env.get("SIFTLINE_WAREHOUSE"),
            words_path=env.get("SIFTLINE_WORDS"),
            decode_mode=env.get("SIFTLINE_DECODE_MODE", "failfast"),
            tolerated_failures=int(env.get("SIFTLINE_TOLERATED_FAILURES", TOLERATED_FAILURES)),
            pause_ms=int(env.get("SIFTLINE_RESTART_PAUSE", PAUSE_MS)),
        )
