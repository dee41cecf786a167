"""Continuous micro-batches (J2): queries on the default trigger, watched while they run.

A query started with ``available_now=False`` takes a micro-batch as soon as there is input and otherwise waits. ``Progress``
keeps what its batches reported; ``drained`` ends a query between two batches once all input is in, so that the
next start goes on from the checkpoint.
"""

from __future__ import annotations

import threading
from collections import deque

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

KEPT = 1000  # reports kept; totals count all of them


class Progress(StreamingQueryListener):
    """Batches with input and rows read, by query run; the newest reports and errors. Use it as a context manager."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.rows: dict[str, int] = {}
        self.batches: dict[str, list[int]] = {}
        self.reports: deque = deque(maxlen=KEPT)
        self.errors: dict[str, str] = {}
        self._ended: dict[str, threading.Event] = {}

    def __enter__(self) -> Progress:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc: object) -> None:
        self.spark.streams.removeListener(self)

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p, run = event.progress, str(event.progress.runId)
        if p.numInputRows:
            self.rows[run] = self.rows.get(run, 0) + p.numInputRows
            self.batches.setdefault(run, []).append(p.batchId)
        self.reports.append(p)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.errors[str(event.runId)] = event.exception
        self._end(str(event.runId)).set()

    def ended(self, run: str, seconds: float = 60.0) -> bool:
        """Wait until the end of a run was reported (reports come in order, after the work)."""
        return self._end(run).wait(seconds)


def drained(query: StreamingQuery, progress: Progress | None = None) -> str:
    """Wait until all input that is there was taken, stop the query between two batches, and return its run id."""
    run = str(query.runId)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    if progress is not None:
        progress.ended(run)
    return run
