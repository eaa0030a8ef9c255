"""Incremental export with Structured Streaming.

The batch export reads a bounded table once. For a folder that keeps
receiving files, the same source → transform → sink runs as a streaming query
with ``trigger(availableNow=True)``: each run exports only files not yet
exported, the file sink commits exactly once through its log, and a run that
dies (or loses executors) resumes from the checkpoint in the shared folder.
Row-level transforms only: the file sink appends, so aggregates would need a
watermark the reference does not have.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from ringcast.operators.transform import transform as run_transform
from ringcast.sinks.writer import check_target, format_options, output_format, prepare


def stream_source(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None,
                  file_pattern: str | None = None) -> DataFrame:
    """Files of folder ``path`` (only those matching ``file_pattern`` if given)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if file_pattern:
        reader = reader.option("pathGlobFilter", file_pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path)


def incremental_export(spark: SparkSession, source: DataFrame, path: str, checkpoint: str,
                       transform: str | None = None, fmt: str | None = None,
                       partition_by=None, query_name: str | None = None,
                       compression: str | None = None, keep_nulls: bool = False) -> dict:
    """Export what is new in the streaming ``source`` to ``path``; returns progress.
    Formats get the same options and column handling as the batch sinks."""
    check_target(path)
    fmt_name = output_format(path, fmt)
    out = run_transform(spark, source, transform) if transform else source
    # counted where the rows are written, batch by batch: rows that the transform drops are not
    out = prepare(out, fmt_name).observe(WRITTEN, F.count(F.lit(1)).alias("rows"))
    writer = (out.writeStream.format("json" if fmt_name == "ndjson" else fmt_name)
              .option("checkpointLocation", checkpoint).outputMode("append")
              .trigger(availableNow=True))
    for key, value in format_options(fmt_name, compression, keep_nulls).items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if query_name:
        writer = writer.queryName(query_name)
    counter = _ProgressTotals()
    spark.streams.addListener(counter)
    try:
        query = writer.start(path)
        query.awaitTermination()  # raises when the query failed
        # Events are delivered in order: once this query's termination event
        # arrived, all of its progress events have been counted.
        if not counter.wait_terminated(str(query.id), timeout=300):
            raise RuntimeError("the export is written, but Spark did not report all of its progress; "
                               "read the totals from the output")
    finally:
        spark.streams.removeListener(counter)
    return counter.totals(str(query.id))


WRITTEN = "ringcast_written"


class _ProgressTotals(StreamingQueryListener):
    """Sums written rows and batches per query from every progress event (the query's
    own ``recentProgress`` keeps only the last few batches)."""

    def __init__(self):
        self._lock = threading.Lock()
        self._rows: dict[str, int] = {}
        self._batches: dict[str, int] = {}
        self._done: dict[str, threading.Event] = {}

    def _event(self, query_id: str) -> threading.Event:
        with self._lock:
            return self._done.setdefault(query_id, threading.Event())

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        written = p.observedMetrics.get(WRITTEN)
        with self._lock:
            key = str(p.id)
            self._rows[key] = self._rows.get(key, 0) + (int(written["rows"]) if written else 0)
            self._batches[key] = self._batches.get(key, 0) + 1

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._event(str(event.id)).set()

    def wait_terminated(self, query_id: str, timeout: float) -> bool:
        return self._event(query_id).wait(timeout)

    def totals(self, query_id: str) -> dict:
        with self._lock:
            return {"batches": self._batches.get(query_id, 0), "rows": self._rows.get(query_id, 0)}
