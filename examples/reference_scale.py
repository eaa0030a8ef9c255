"""Export the reference's benchmark table shape at its scale and time it.

    python examples/reference_scale.py 40000000 [cores]

Generates ``rows`` events (8 columns: uuid text, timestamp, device, user,
event, value, count, active) as Parquet under the shared checkpoint folder,
then exports the whole table over 2400 ring splits, once to one zstd Parquet
file and once to part files, and prints one JSON line with the timings.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ringcast.plans.export import token_range_export  # noqa: E402
from ringcast.plans.generate import bench_events_range  # noqa: E402
from ringcast.session import build_session, cleanup_scratch, scratch_path  # noqa: E402


def main(rows: int, cores: int) -> dict:
    spark = build_session(f"local[{cores}]", shuffle_partitions=cores,
                          extra={"spark.driver.memory": "16g"})
    source = scratch_path(spark, "bench-events")
    started = time.perf_counter()
    bench_events_range(spark, rows).write.parquet(source)
    generated = time.perf_counter() - started
    events = spark.read.parquet(source)
    out = {"rows": rows, "cores": cores, "generate_sec": round(generated, 1)}
    for name, single in (("single_file", True), ("part_files", False)):
        path = scratch_path(spark, f"bench-{name}") + ".parquet"
        result = token_range_export(spark, events, "id", path, splits=2400, single_file=single)
        out[f"{name}_sec"] = round(result.seconds, 1)
        out[f"{name}_rows_per_sec"] = round(result.rows / result.seconds)
    cleanup_scratch(spark)
    spark.stop()
    return out


if __name__ == "__main__":
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 40_000_000
    c = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    print(json.dumps(main(n, c)))
