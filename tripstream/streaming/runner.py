"""Start/run streaming queries (SNK-1..5, STR-11, STR-12, SNK-11).

Every query gets its own checkpoint folder (never shared). Bounded runs use
``availableNow`` (process what has landed, then stop); long-running layers
use a processing-time trigger and return the ``StreamingQuery`` so the
caller decides how to wait (``awaitAnyTermination`` over all layers).
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def _writer(df: DataFrame, ckpt: str, mode: str, trigger: str | None, name: str | None):
    w = df.writeStream.outputMode(mode).option("checkpointLocation", ckpt)
    if name:
        w = w.queryName(name)
    return w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)


def start_to_table(
    df: DataFrame,
    path: str,
    ckpt: str,
    fmt: str = "parquet",
    mode: str = "append",
    trigger: str | None = None,
    partition_by: list[str] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a file table; exactly-once through the checkpoint + file sink log."""
    w = _writer(df, ckpt, mode, trigger, name).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start(path)


def start_foreach_batch(df: DataFrame, fn, ckpt: str, trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """SNK-5: hand every micro-batch to ``fn(batch_df, batch_id)``."""
    return _writer(df, ckpt, "append", trigger, name).foreachBatch(fn).start()


def await_done(q: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to drain; re-raise its failure."""
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {q.name or q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return q


def run_to_table(df: DataFrame, path: str, ckpt: str, **kw) -> StreamingQuery:
    return await_done(start_to_table(df, path, ckpt, **kw))


PROGRESS_SCHEMA = (
    "query_id string, query_name string, batchId long, numInputRows long, "
    "inputRowsPerSecond double, processedRowsPerSecond double, triggerExecution_ms long"
)


OPERATOR_SCHEMA = (
    "query_id string, query_name string, batchId long, operator int, operator_name string, numRowsTotal long, "
    "numRowsUpdated long, numRowsRemoved long, numRowsDroppedByWatermark long"
)


class ProgressRecorder(StreamingQueryListener):
    """SNK-11 for long runs: every progress event of every query, not only the
    last ``spark.sql.streaming.numRecentProgressUpdates`` kept by ``recentProgress``.

    Events arrive on the listener bus (driver side, one small row per trigger and one per
    stateful operator of it); ``flush`` and ``flush_operators`` append what has arrived to tables.

    STR-9: ``numRowsDroppedByWatermark`` of a deduplication or a join counts late rows. Behind
    a window aggregate it counts partial groups, which Spark has summed before the state.
    """

    def __init__(self):
        self._rows: list[tuple] = []
        self._operators: list[tuple] = []
        self._done: set[str] = set()
        self._lock = threading.Lock()
        self._cv = threading.Condition(self._lock)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        dur = p.durationMs or {}
        row = (
            str(p.id), p.name, int(p.batchId), int(p.numInputRows or 0),
            float(p.inputRowsPerSecond or 0.0), float(p.processedRowsPerSecond or 0.0),
            int(dur.get("triggerExecution", 0) or 0),
        )
        operators = [
            (row[0], row[1], row[2], i, o.operatorName, int(o.numRowsTotal), int(o.numRowsUpdated), int(o.numRowsRemoved), int(o.numRowsDroppedByWatermark))
            for i, o in enumerate(p.stateOperators)
        ]
        with self._lock:
            self._rows.append(row)
            self._operators += operators

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self._cv:
            self._done.add(str(event.runId))
            self._cv.notify_all()

    def wait_terminated(self, q: StreamingQuery, timeout_s: float = 60.0) -> None:
        """Block until the bus has delivered ``q``'s termination (so all its progress)."""
        with self._cv:
            if not self._cv.wait_for(lambda: str(q.runId) in self._done, timeout_s):
                raise TimeoutError(f"no termination event for stream {q.name or q.id} within {timeout_s}s")

    def flush(self, spark: SparkSession, path: str) -> int:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            spark.createDataFrame(rows, PROGRESS_SCHEMA).write.mode("append").parquet(path)
        return len(rows)

    def flush_operators(self, spark: SparkSession, path: str) -> int:
        with self._lock:
            rows, self._operators = self._operators, []
        if rows:
            spark.createDataFrame(rows, OPERATOR_SCHEMA).write.mode("append").parquet(path)
        return len(rows)


class CrashAfterWrite:
    """STR-13 under test: a foreachBatch function that fails once, after it has written batch
    ``batch_id`` and before the checkpoint commits it, so that Spark delivers it again."""

    def __init__(self, fn, batch_id: int):
        self.fn, self.batch_id, self.crashed = fn, batch_id, False

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.fn(batch, batch_id)
        if batch_id == self.batch_id and not self.crashed:
            self.crashed = True
            raise RuntimeError(f"crash between the write and the commit of batch {batch_id}")

