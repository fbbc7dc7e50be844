"""Keep queries running through a bounded number of failures.

A listener hears of committed batches and of the ends of queries. A query that failed is started again from
its checkpoint after a pause; a committed batch clears its failures; one failure more than is tolerated ends all
queries with its cause.
"""

from __future__ import annotations

import queue
import threading
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# Failures in a row that are borne, and the pause after one.
TOLERATED_FAILURES = 3
PAUSE_MS = 60_000


class _Heard(StreamingQueryListener):
    """Passes on what the queries of one supervisor do."""

    def __init__(self, said: queue.Queue):
        self._said = said

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        # Progress is reported for committed batches; one without rows says nothing about the sinks.
        if event.progress.numInputRows:
            self._said.put(("committed", str(event.progress.runId), None))

    def onQueryTerminated(self, event) -> None:
        self._said.put(("ended", str(event.runId), event.exception))


@dataclass
class Supervisor:
    """Runs queries, each made by a function that starts it from its checkpoint."""

    spark: SparkSession
    starters: Mapping[str, Callable[[], StreamingQuery]]
    tolerated: int = TOLERATED_FAILURES
    pause_ms: int = PAUSE_MS
    failures: dict[str, int] = field(default_factory=dict)
    restarts: int = 0

    def __post_init__(self):
        self._stopped = threading.Event()

    def stop(self) -> None:
        """End all queries; ``run`` returns."""
        self._stopped.set()

    def run(self) -> None:
        """Until all queries have ended by themselves, ``stop`` is called, or one has failed too often: then raise its cause."""
        said: queue.Queue = queue.Queue()
        listener = _Heard(said)
        running: dict[str, tuple[str, StreamingQuery]] = {}

        def begin(name: str) -> None:
            query = self.starters[name]()
            running[str(query.runId)] = name, query

        self.spark.streams.addListener(listener)
        try:
            for name in self.starters:
                self.failures[name] = 0
                begin(name)
            while running and not self._stopped.is_set():
                try:
                    what, run_id, cause = said.get(timeout=0.2)
                except queue.Empty:
                    # An end that came before the listener was there is still seen here.
                    what, run_id, cause = next((("ended", i, None) for i, (_, q) in running.items() if not q.isActive), (None, None, None))
                if run_id not in running:
                    continue
                name, query = running[run_id]
                if what == "committed":
                    self.failures[name] = 0
                elif what == "ended":
                    del running[run_id]
                    failure = query.exception()
                    if failure is None and cause is None:
                        continue
                    self.failures[name] += 1
                    if self.failures[name] > self.tolerated:
                        raise failure or RuntimeError(cause)
                    self._stopped.wait(self.pause_ms / 1000)
                    if not self._stopped.is_set():
                        self.restarts += 1
                        begin(name)
        finally:
            self.spark.streams.removeListener(listener)
            for _, query in running.values():
                query.stop()
