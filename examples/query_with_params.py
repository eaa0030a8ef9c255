"""Run one query text per line of a parameter file and export the rows.

    python examples/query_with_params.py /root/testdata/sf0.01 out_dir

Writes a small parameter file (users and a time window), checks it, runs the
query once per line and writes NDJSON partitioned by event type.
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ringcast.plans.export import query_export  # noqa: E402
from ringcast.session import build_session  # noqa: E402
from ringcast.sources.table import Tables  # noqa: E402

LINES = [
    {"uid": 7, "t0": "2024-01-15T00:00:00Z", "t1": "2024-01-20T00:00:00Z"},
    {"uid": 8, "t0": "2024-01-01T00:00:00Z", "t1": "2024-01-08T00:00:00Z"},
    {"uid": 7, "t0": "2024-01-18T00:00:00Z", "t1": "2024-01-25T00:00:00Z"},
]


def main(sf_dir: str, out_dir: str) -> None:
    spark = build_session("local[4]", shuffle_partitions=4)
    os.makedirs(out_dir, exist_ok=False)
    params = os.path.join(out_dir, "params.ndjson")
    with open(params, "w") as f:
        f.write("\n".join(json.dumps(line) for line in LINES) + "\n")
    events = Tables(spark, sf_dir).events
    result = query_export(
        spark,
        "SELECT * FROM events WHERE user_id = :uid "
        "AND ts >= CAST(:t0 AS TIMESTAMP_NTZ) AND ts < CAST(:t1 AS TIMESTAMP_NTZ)",
        os.path.join(out_dir, "events"), params_path=params,
        markers={"uid": "bigint", "t0": "timestamp", "t1": "timestamp"},
        tables={"events": events}, fmt="ndjson", partition_by="event_type")
    print(json.dumps({"path": result.path, "rows": result.rows}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
