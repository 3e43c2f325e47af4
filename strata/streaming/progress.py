"""Counts of every micro-batch, kept on shared storage.

A listener of the session writes one small file per finished batch, named by the
query's id, which the stream's checkpoint keeps. So all batches of a stream are
there after any number of restarts, and the driver holds none of them. Counters
that a stream observes in the pass it makes anyway are written with them.
"""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from strata import storage
from strata.session import scratch_root

LAYOUT = "stream string, query string, run string, batch long, rows long, counters map<string, long>"
WAIT_SECONDS = 60
_logs: dict[str, ProgressLog] = {}


class ProgressLog(StreamingQueryListener):
    """Writes ``<folder>/<query id>/<batch>.json`` for each batch that had rows."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:  # a trigger that found nothing reports the batch before again
            return
        counters = {f"{name}.{k}": v for name, row in (p.observedMetrics or {}).items() for k, v in row.asDict().items() if isinstance(v, int)}
        line = {"stream": p.name, "query": str(p.id), "run": str(p.runId), "batch": p.batchId, "rows": p.numInputRows, "counters": counters}
        storage.write_text(self.spark, f"{self.folder}/{p.id}/{p.batchId}.json", json.dumps(line), overwrite=True)

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait(self, run: str, seconds: float = WAIT_SECONDS) -> bool:
        """Until the events of a run that has ended have arrived; they come in order, the end last."""
        until = time.monotonic() + seconds
        with self.changed:
            while run not in self.ended and time.monotonic() < until:
                self.changed.wait(timeout=max(0.0, until - time.monotonic()))
            return run in self.ended


def log_progress(spark: SparkSession) -> ProgressLog:
    """The session's log; to be called before a stream starts."""
    app = spark.sparkContext.applicationId
    if app not in _logs:
        _logs[app] = ProgressLog(spark, f"{scratch_root(spark)}/progress")
        spark.streams.addListener(_logs[app])
    return _logs[app]


def progress_of(query: StreamingQuery) -> DataFrame:
    """stream, query, run, batch, rows and counters of all batches of a stream, those before its restarts too."""
    spark = SparkSession.getActiveSession()
    log = log_progress(spark)
    if not query.isActive:
        log.wait(str(query.runId))
    path = f"{log.folder}/{query.id}"
    if not storage.exists(spark, path):
        return spark.createDataFrame([], LAYOUT)
    return spark.read.schema(LAYOUT).json(path)


def batch_counts(query: StreamingQuery, all_runs: bool = False) -> list[tuple[str, int, int]]:
    """Query name, batch number and input rows of each finished micro-batch with
    rows, of this run of the stream or of all its runs."""
    found = progress_of(query)
    if not all_runs:
        found = found.filter(found["run"] == str(query.runId))
    return [tuple(r) for r in found.select("stream", "batch", "rows").orderBy("batch").collect()]
