"""Progress of a streaming query as rows, of its recent batches or of all it ever ran."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

_SCHEMA = (
    "query_id STRING, run_id STRING, batch_id BIGINT, timestamp STRING, input_rows BIGINT, "
    "input_rows_per_second DOUBLE, processed_rows_per_second DOUBLE, batch_duration_ms BIGINT, "
    "state_rows BIGINT"
)


def progress_rows(spark: SparkSession, query: StreamingQuery, last: int | None = None) -> DataFrame:
    """One row per recent batch. Spark keeps a bounded number of them, so this stays small."""
    recent = query.recentProgress
    rows = [_row(item) for item in (recent[-last:] if last else recent)]
    return spark.createDataFrame(rows, _SCHEMA)


def _row(progress) -> tuple:
    state = sum(operator["numRowsTotal"] for operator in progress["stateOperators"])
    return (
        str(progress["id"]),
        str(progress["runId"]),
        int(progress["batchId"]),
        progress["timestamp"],
        int(progress["numInputRows"]),
        _rate(progress["inputRowsPerSecond"]),
        _rate(progress["processedRowsPerSecond"]),
        int(progress["batchDuration"]),
        int(state),
    )


def _rate(value) -> float:
    return float(value or 0.0)


class ProgressListener(StreamingQueryListener):
    """Hands a dictionary per finished micro-batch to a callback; add it with `spark.streams`."""

    def __init__(self, report: Callable[[dict], None]):
        self._report = report

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        done = event.progress
        self._report(
            {
                "query_id": str(done.id),
                "batch_id": done.batchId,
                "input_rows": done.numInputRows,
                "processed_rows_per_second": done.processedRowsPerSecond,
                "batch_duration_ms": done.batchDuration,
            }
        )

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


_LOG_SCHEMA = (
    _SCHEMA + ", name STRING, watermark STRING, sink STRING, sink_rows BIGINT, "
    "sources ARRAY<STRUCT<description: STRING, input_rows: BIGINT, end_offset: STRING>>, "
    "durations MAP<STRING, BIGINT>"
)


class ProgressLog(StreamingQueryListener):
    """Writes the progress of every batch below a folder, one small JSON file a batch, as it ends.

    Spark itself keeps the last batches of a running query only. The files outlive the query, the
    session and a restart; a batch that runs again in a later run has a file of its own there. Files
    are written on the driver by Spark's file system, so any store that Spark reaches will do. A
    failure to write is kept and raised by `wait`, because Spark drops what a listener raises.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path = path.rstrip("/")
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        self.failure: Exception | None = None

    def onQueryStarted(self, event):
        self._end(str(event.runId))

    def onQueryProgress(self, event):
        try:
            self._write(event.progress)
        except Exception as error:
            self.failure = error

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._end(str(event.runId)).set()

    def _end(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all batches of a query that has ended are written; Spark reports them with a delay."""
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of run {query.runId} reported in {seconds} s")
        if self.failure is not None:
            raise self.failure

    def _write(self, done) -> None:
        row = {
            "query_id": str(done.id),
            "run_id": str(done.runId),
            "name": done.name,
            "batch_id": done.batchId,
            "timestamp": done.timestamp,
            "input_rows": done.numInputRows,
            "input_rows_per_second": _rate(done.inputRowsPerSecond),
            "processed_rows_per_second": _rate(done.processedRowsPerSecond),
            "batch_duration_ms": done.batchDuration,
            "state_rows": sum(operator.numRowsTotal for operator in done.stateOperators),
            "watermark": dict(done.eventTime).get("watermark"),
            "sink": done.sink.description,
            "sink_rows": done.sink.numOutputRows,
            "sources": [
                {"description": s.description, "input_rows": s.numInputRows, "end_offset": str(s.endOffset)}
                for s in done.sources
            ],
            "durations": dict(done.durationMs),
        }
        jvm = self._spark._jvm
        name = f"{self._path}/date={done.timestamp[:10]}/{done.id}-{done.batchId:012d}-{done.runId}.json"
        at = jvm.org.apache.hadoop.fs.Path(name)
        out = at.getFileSystem(self._spark._jsc.hadoopConfiguration()).create(at, True)
        try:
            out.write(bytearray((json.dumps(row) + "\n").encode("utf-8")))
        finally:
            out.close()


@contextmanager
def logged(spark: SparkSession, path: str):
    """Log the progress of all queries that run inside; yields the `ProgressLog`."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row for every batch that a `ProgressLog` wrote, the newest run of it; `date` prunes days.

    The log may hold a file more than once for a batch that was run again after a failure.
    """
    rows = spark.read.schema(_LOG_SCHEMA + ", date DATE").json(path)
    newest = Window.partitionBy("query_id", "batch_id").orderBy(F.desc("timestamp"), F.desc("input_rows"))
    return rows.withColumn("__run", F.row_number().over(newest)).filter("__run = 1").drop("__run")


def fold_progress(spark: SparkSession, path: str, to: str) -> None:
    """Rewrite the small files of a log as one table by day, for logs that have grown long."""
    read_progress(spark, path).repartitionByRange("date", "query_id", "batch_id").write.mode("overwrite").partitionBy("date").parquet(to)
