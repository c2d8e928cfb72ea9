"""What streaming queries report of their micro-batches, and stopping by it.

A listener of the session gets the reports; nothing polls the queries. Reports come in the order of
the micro-batches, after a micro-batch is committed.
"""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

#: Reports kept of a query; older ones are forgotten.
KEPT = 1000

REPORT = T.StructType([
    T.StructField("batch_id", T.LongType()), T.StructField("rows", T.LongType()), T.StructField("state_rows", T.LongType()),
    T.StructField("state_bytes", T.LongType()), T.StructField("dropped_late", T.LongType()), T.StructField("millis", T.LongType())])


@dataclass(frozen=True)
class Report:
    """A committed micro-batch: rows read, keys and bytes of state after it, rows dropped as too late,
    milliseconds it took. The report of a query without new data repeats its last ``batch_id``."""

    batch_id: int
    rows: int
    state_rows: int
    state_bytes: int
    dropped_late: int
    millis: int


class ProgressLog(StreamingQueryListener):
    """Reports of the session's queries since ``watch_progress``."""

    def __init__(self) -> None:
        self._changed = threading.Condition()
        self._reports: dict[str, deque[Report]] = {}
        self._ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._reports.setdefault(str(event.runId), deque(maxlen=KEPT))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        states = p.stateOperators
        report = Report(
            p.batchId, p.numInputRows, sum(s.numRowsTotal for s in states), sum(s.memoryUsedBytes for s in states),
            sum(s.numRowsDroppedByWatermark for s in states), int(p.durationMs.get("triggerExecution", 0)))
        with self._changed:
            self._reports.setdefault(str(p.runId), deque(maxlen=KEPT)).append(report)
            self._changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended[str(event.runId)] = event.exception
            self._changed.notify_all()

    def reports(self, query: StreamingQuery) -> list[Report]:
        """The micro-batches of this run of the query, each once, with its first report."""
        with self._changed:
            found: dict[int, Report] = {}
            for report in self._reports.get(str(query.runId), ()):
                found.setdefault(report.batch_id, report)
            return list(found.values())

    def wait(self, query: StreamingQuery, until: Callable[[Report], bool], seconds: float) -> Report | None:
        """The first report that ``until`` holds for, else None once the query has ended or after
        ``seconds``. Reports that came before the call count."""
        run, seen, deadline = str(query.runId), 0, time.monotonic() + seconds
        with self._changed:
            while True:
                reports = self._reports.get(run, deque())
                for report in list(reports)[seen:] if len(reports) < KEPT else list(reports):
                    if until(report):
                        return report
                seen = len(reports)
                left = deadline - time.monotonic()
                if run in self._ended or left <= 0:
                    return None
                self._changed.wait(min(left, threading.TIMEOUT_MAX))


def watch_progress(spark: SparkSession) -> ProgressLog:
    """A log of what the session's queries report from now on."""
    log = ProgressLog()
    spark.streams.addListener(log)
    return log


def stop_after(
    query: StreamingQuery, log: ProgressLog, batch_id: int | None = None, rows: int | None = None, seconds: float = 600.0
) -> Report | None:
    """Stop the query once it has committed micro-batch ``batch_id``, or ``rows`` rows in this run, or
    (without either) a micro-batch without data; after ``seconds`` at the latest.

    Returns the report of that micro-batch, None if there was none. A micro-batch that had begun
    after it may be cut off; it is done again when the query restarts, and changes nothing twice.
    An exception of the query is raised.
    """
    total, counted = 0, set()

    def enough(report: Report) -> bool:
        nonlocal total
        if report.batch_id not in counted:
            counted.add(report.batch_id)
            total += report.rows
        if batch_id is not None:
            return report.batch_id >= batch_id
        return total >= rows if rows is not None else report.rows == 0

    found = log.wait(query, enough, seconds)
    query.stop()
    if query.exception() is not None:
        raise query.exception()
    return found


def progress_table(spark: SparkSession, log: ProgressLog, query: StreamingQuery) -> DataFrame:
    """The query's reports as rows, at most ``KEPT``."""
    return spark.createDataFrame([tuple(vars(r).values()) for r in log.reports(query)], REPORT)
