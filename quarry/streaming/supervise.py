"""Processing-time streams that are watched: ended when drained, resumed after a failure.

``run_until_drained`` starts a query as a service (processing-time trigger)
and ends it once it has found no more input.  A query that fails is built and
started anew at the same location, so it resumes from its checkpoint; after
``retries`` failures in a row without progress the last error is raised.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from quarry.streaming import runner

_IDLE = "spark.sql.streaming.noDataProgressEventInterval"


class DrainListener(StreamingQueryListener):
    """Knows, per run of a query, the batches done and whether it is idle."""

    def __init__(self):
        self.batches: dict[str, int] = {}
        self.idle: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def idle_event(self, run_id: str) -> threading.Event:
        with self._lock:
            return self.idle.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run_id, progress = str(event.progress.runId), event.progress
        with self._lock:
            if progress.numInputRows:
                self.batches[run_id] = self.batches.get(run_id, 0) + 1

    def onQueryIdle(self, event) -> None:
        # the trigger has fired and found neither input nor anything left to do
        self.idle_event(event.runId).set()

    def onQueryTerminated(self, event) -> None:
        self.idle_event(event.runId).set()


def run_until_drained(spark: SparkSession, build: Callable[[int], DataFrame], name: str, mode: str = "append",
                      keys: list[str] | None = None, location: str | None = None,
                      processing_time: str = "0 seconds", retries: int = 3, pause_s: float = 0.2,
                      timeout_s: float | None = None, idle_ms: int = 200, **how) -> tuple[runner.StreamResult, int]:
    """The drained query's result and the number of failures it resumed from.

    ``build(attempt)`` gives the streaming DataFrame of an attempt (0, 1, ...).
    An attempt that finished a batch before it failed starts the count of
    failures in a row anew.  With a time limit the query is stopped and
    ``TimeoutError`` raised.
    """
    location = location or runner.new_location(spark, name)
    listener = DrainListener()
    before = spark.conf.get(_IDLE, None)
    spark.conf.set(_IDLE, str(idle_ms))
    spark.streams.addListener(listener)
    ends = None if timeout_s is None else time.monotonic() + timeout_s
    failures = in_a_row = 0
    try:
        while True:
            result = runner.run(build(failures), name, mode, keys, location, processing_time, **how)
            query = result.query
            idle = listener.idle_event(query.runId)
            while query.isActive and not idle.wait(0.1):
                if ends is not None and time.monotonic() > ends:
                    query.stop()
                    raise TimeoutError(f"stream {name} was not drained in {timeout_s} s")
            error = query.exception()
            query.stop()
            if error is None:
                return result, failures
            failures += 1
            in_a_row = 1 if listener.batches.get(str(query.runId)) else in_a_row + 1
            if in_a_row > retries:
                raise RuntimeError(str(error))
            time.sleep(pause_s)
    finally:
        spark.streams.removeListener(listener)
        if before is None:
            spark.conf.unset(_IDLE)
        else:
            spark.conf.set(_IDLE, before)
