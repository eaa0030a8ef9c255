"""Benchmark the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. ``value`` is the job the reference benchmarks: a whole
table (lineitem) over 2400 ring splits into one zstd Parquet file, in
seconds. ``queries`` has every job (each the best of $BENCH_REPEAT runs after
a warm-up pass on the smallest data), ``total_sec`` their sum, and the
rows-per-second figures compare with the reference's 1.23M rows/s.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from ringcast.operators import fanout as fo  # noqa: E402
from ringcast.operators import ring  # noqa: E402
from ringcast.plans.export import export, token_range_export  # noqa: E402
from ringcast.session import build_session, cleanup_scratch, scratch_path  # noqa: E402
from ringcast.sinks.writer import remove_path  # noqa: E402
from ringcast.sources.params import read_params  # noqa: E402
from ringcast.sources.table import Tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
# Each job runs once on this (small) data first, so timings are not JIT warm-up.
WARMUP_DIR = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(SF_DIR), "sf0.001"))
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = max(1, int(os.environ.get("BENCH_REPEAT", "3")))


def _sf(path: str) -> str:
    tail = os.path.basename(path)
    return tail[2:] if tail.startswith("sf") else tail


def main() -> None:
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=CPUS,
                          extra={"spark.driver.memory": "16g"})
    def timed(job) -> float:
        """Run one job; its output is deleted right after timing."""
        started = time.perf_counter()
        out = job()
        took = time.perf_counter() - started
        if out:
            remove_path(spark, out)
        return took

    warm = os.path.isdir(WARMUP_DIR) and WARMUP_DIR != SF_DIR
    try:
        if warm:
            for job in make_jobs(spark, Tables(spark, WARMUP_DIR)).values():
                timed(job)
        t = Tables(spark, SF_DIR)
        lineitem_rows = t.lineitem.count()
        times = {}
        for name, job in make_jobs(spark, t).items():
            times[name] = round(min(timed(job) for _ in range(REPEAT)), 3)
    finally:
        cleanup_scratch(spark)
    single = times["export_single_parquet"]
    parts = times["export_parts_parquet"]
    print(json.dumps({
        "metric": "export_single_parquet_sec",
        "value": single,
        "unit": "sec",
        "queries": times,
        "sf": _sf(SF_DIR),
        "rows": lineitem_rows,
        "rows_per_sec": round(lineitem_rows / single) if single else None,
        "parts_rows_per_sec": round(lineitem_rows / parts) if parts else None,
        "total_sec": round(sum(times.values()), 3),
        "cpus": CPUS,
        "repeat": REPEAT,
        "warmup": WARMUP_DIR if warm else None,
    }))
    spark.stop()


def make_jobs(spark, t):
    """The benchmark jobs over the tables ``t``; each returns the path it wrote
    (deleted after timing) or None."""

    def export_single():
        # The reference's benchmark: whole table over the ring, one Parquet file.
        r = token_range_export(spark, t.lineitem, ["l_orderkey", "l_linenumber"],
                               scratch_path(spark, "bench-single") + ".parquet",
                               splits=2400, single_file=True)
        return r.path

    def export_parts():
        r = token_range_export(spark, t.lineitem, ["l_orderkey", "l_linenumber"],
                               scratch_path(spark, "bench-parts") + ".parquet", splits=2400)
        return r.path

    def split_counts():
        ring.split_counts(t.lineitem, ["l_orderkey", "l_linenumber"], 2400,
                          include_empty=True).agg(F.sum("rows")).first()

    def flagship_transform():
        r = export(spark, ring.token_scan(t.events, "event_id", 16, keep_token=False),
                   scratch_path(spark, "bench-flagship") + ".parquet",
                   transform="SELECT event_type, COUNT(*) AS cnt, AVG(value) AS avg_value "
                             "FROM source GROUP BY event_type", single_file=True)
        return r.path

    def fanout_rows():
        params = t.customer.filter(F.col("c_mktsegment") == "MACHINERY").select("c_custkey")
        fo.fanout(t.orders, params, on={"c_custkey": "o_custkey"}).count()

    def fanout_counts():
        params = t.customer.select(F.col("c_custkey").alias("param_set"), "c_custkey")
        fo.fanout_count(t.orders, params, on={"c_custkey": "o_custkey"}).agg(F.sum("cnt")).first()

    def fanout_limit():
        params = t.customer.select(F.col("c_custkey").alias("param_set"), "c_custkey")
        fo.fanout_limit(t.orders, params, 2, [F.col("o_orderdate").desc(), "o_orderkey"],
                        on={"c_custkey": "o_custkey"}).count()

    def hive_export():
        r = export(spark, t.lineitem, scratch_path(spark, "bench-hive"),
                   partition_by=["l_returnflag", "l_linestatus"])
        return r.path

    def csv_export():
        return export(spark, t.documents, scratch_path(spark, "bench-csv") + ".csv").path

    def ndjson_transform():
        return export(spark, t.orders, scratch_path(spark, "bench-ndjson") + ".ndjson",
                      transform="SELECT o_custkey, COUNT(*) AS n, SUM(o_totalprice) AS total "
                                "FROM source GROUP BY o_custkey").path

    def params_file():
        path = scratch_path(spark, "bench-params")
        t.events.select(F.to_json(F.struct(F.col("user_id").alias("uid"),
                                           F.col("event_type").alias("kind"))).alias("value")
                        ).write.text(path)
        params = read_params(spark, path, {"uid": "bigint", "kind": "text"})
        fo.fanout_count(t.events, params, on={"uid": "user_id", "kind": "event_type"}
                        ).agg(F.sum("cnt")).first()
        return path

    return {
        "export_single_parquet": export_single,
        "export_parts_parquet": export_parts,
        "split_counts_2400": split_counts,
        "flagship_transform": flagship_transform,
        "fanout_rows": fanout_rows,
        "fanout_count_per_set": fanout_counts,
        "fanout_limit_per_set": fanout_limit,
        "hive_export": hive_export,
        "csv_export": csv_export,
        "ndjson_transform": ndjson_transform,
        "params_fanout": params_file,
    }


if __name__ == "__main__":
    main()
