"""One-call export jobs (O1, O4): source → optional SQL transform → sink.

``export`` is the writer of both reference commands; ``token_range_export``
and ``query_export`` build the source first. Metrics are taken while the data
is written (``DataFrame.observe``), not by a second pass over the output.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ringcast.operators.ring import SPLIT_COL, split_bounds, token_scan
from ringcast.operators.transform import transform as run_transform
from ringcast.sinks.writer import (effective_codec, output_format, path_exists, single_file_path,
                                   write)


@dataclass
class ExportResult:
    path: str
    format: str
    rows: int
    seconds: float
    metrics: dict = field(default_factory=dict)


def export(spark: SparkSession, source: DataFrame, path: str, transform: str | None = None,
           tables: Mapping[str, DataFrame] | None = None, fmt: str | None = None,
           single_file: bool = False, partition_by=None, mode: str = "errorifexists",
           on_complete: Callable[[ExportResult], None] | None = None,
           **write_options) -> ExportResult:
    """Write ``source`` (or ``transform`` run over it as ``source``) to ``path``.

    ``on_complete`` is called with the result once the write has committed;
    a failed write raises instead and never calls it.
    """
    fmt_name = output_format(path, fmt)
    codec = effective_codec(write_options.get("compression"), write_options.get("options"))
    final = single_file_path(path, fmt_name, codec) if single_file else path
    if mode == "ignore" and path_exists(spark, final):
        skipped = ExportResult(final, fmt_name, 0, 0.0, {"skipped": True})
        if on_complete is not None:
            on_complete(skipped)
        return skipped
    result = run_transform(spark, source, transform, tables)
    observation = Observation("ringcast_export")
    started = time.perf_counter()
    # counted in the writer's own tasks, above every exchange: a task that runs
    # again, or a lost executor's map output, is not counted twice
    written = write(result, path, fmt=fmt_name, single_file=single_file, partition_by=partition_by, mode=mode,
                    observe=lambda df: df.observe(observation, F.count(F.lit(1)).alias("rows")), **write_options)
    seconds = time.perf_counter() - started
    metrics = observation.get
    result = ExportResult(written, fmt_name, int(metrics.get("rows", 0)), seconds, dict(metrics))
    if on_complete is not None:
        on_complete(result)
    return result


def token_range_export(spark: SparkSession, df: DataFrame, partition_keys, path: str,
                       splits: int | None = None, columns=None, token_method: str = "xxhash64",
                       keep_split: bool = False, **export_options) -> ExportResult:
    """The ``token-range`` command: whole table over the ring, then export.

    The token is computed under an internal name and dropped, so a data column
    called ``token`` is exported untouched; ``keep_split`` adds ``split_id``."""
    split_col = SPLIT_COL if keep_split else "__ring_split"
    scanned = token_scan(df, partition_keys, splits, columns, token_method, keep_token=False,
                         token_col="__ring_token", split_col=split_col)
    if not keep_split:
        scanned = scanned.drop(split_col)
    return export(spark, scanned, path, **export_options)


def query_export(spark: SparkSession, sql: str, path: str, params_path: str | None = None,
                 markers: Mapping[str, str] | None = None,
                 tables: Mapping[str, DataFrame] | None = None,
                 **export_options) -> ExportResult:
    """The ``query`` command: a query text run once, or once per line of an
    NDJSON parameter file, then exported. Marker types are read from the query
    (:func:`infer_markers`); ``markers`` states those of markers it names."""
    from ringcast.operators.fanout import infer_markers, query_fanout, run_query
    from ringcast.sources.params import read_params

    if params_path is None:
        rows = run_query(spark, sql, tables=tables)
    else:
        markers = infer_markers(spark, sql, tables, markers)
        params = read_params(spark, params_path, markers)
        rows = query_fanout(spark, sql, params.drop("param_set"), tables=tables)
    return export(spark, rows, path, tables=tables, **export_options)


def split_metrics(df: DataFrame, splits: int, split_col: str = SPLIT_COL) -> DataFrame:
    """Rows per split, every split listed (zero when empty): the data side of the
    reference's per-query completion callback. Partially aggregated, so a hot
    split adds one row per task to the shuffle."""
    counted = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"))
    bounds = split_bounds(df.sparkSession, splits, split_col)
    return (bounds.join(counted, split_col, "left")
            .select(split_col, F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows")))
