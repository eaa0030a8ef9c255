"""Write the physical plans of the main operators to PLANS.md.

Usage: python tools/plans.py [sf_dir]   (default /root/testdata/sf0.1)
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from ringcast.operators import fanout as fo  # noqa: E402
from ringcast.operators import ring  # noqa: E402
from ringcast.operators.transform import transform  # noqa: E402
from ringcast.session import build_session  # noqa: E402
from ringcast.sources.table import Tables  # noqa: E402


def plans(spark, t):
    machinery = t.customer.filter(F.col("c_mktsegment") == "MACHINERY").select("c_custkey")
    sets = t.customer.select(F.col("c_custkey").alias("param_set"), "c_custkey")
    yield ("Token-range scan with projection and a pushed filter",
           ring.token_scan(t.lineitem, ["l_orderkey", "l_linenumber"], 2400,
                           columns=["l_orderkey", "l_quantity"]).filter("l_quantity > 40"))
    yield ("Rows per split (2400 splits): key columns only, partial count before the shuffle",
           ring.split_counts(t.lineitem, ["l_orderkey", "l_linenumber"], 2400))
    yield ("Fan-out over measured sets: broadcast hash join",
           fo.fanout(t.orders, machinery, on={"c_custkey": "o_custkey"}))
    yield ("Per-set LIMIT: partial WindowGroupLimit before the shuffle",
           fo.fanout_limit(t.orders, sets, 2, [F.col("o_orderdate").desc(), "o_orderkey"],
                           on={"c_custkey": "o_custkey"}))
    yield ("Per-set COUNT: semi join with the set keys, count per key, join to the sets",
           fo.fanout_count(t.orders, sets, on={"c_custkey": "o_custkey"}))
    yield ("A range per set: an equality join on width class and bucket, the range on top",
           fo.fanout(t.orders, t.nation.select((F.col("n_nationkey") * F.lit(20000.0)).alias("lo"),
                                               (F.col("n_nationkey") * F.lit(20000.0) + 500.0).alias("hi")),
                     between=("o_totalprice", "lo", "hi")))
    yield ("Query text per parameter row (LATERAL) with LIMIT: semi join with the asked keys below the ranking",
           fo.query_fanout(spark, "SELECT * FROM orders WHERE o_custkey = :k "
                                  "ORDER BY o_orderdate DESC, o_orderkey LIMIT 2",
                           sets.select(F.col("c_custkey").alias("k")),
                           tables={"orders": t.orders}))
    yield ("Query text per parameter row with an aggregate, as planned for a large table: semi join with "
           "the asked keys below the first exchange",
           _large_table(spark, lambda: fo.query_fanout(
               spark, "SELECT COUNT(*) AS n FROM orders WHERE o_custkey = :k",
               machinery.select(F.col("c_custkey").alias("k")), tables={"orders": t.orders})))
    yield ("SQL transform over `source`: filters and columns reach the Parquet scan",
           transform(spark, t.orders, "SELECT o_orderkey FROM source "
                                      "WHERE o_totalprice > 400000 AND o_orderstatus = 'F'"))
    yield ("Hive layout: rebalance on the partition column (AQE splits hot values)",
           t.lineitem.hint("rebalance", "l_returnflag"))


def _large_table(spark, build):
    """Plan ``build()`` as if the scanned table were above the runtime-filter
    size threshold (10 GB), which the test data is not."""
    key = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        df = build()
        df._jdf.queryExecution().executedPlan()  # plan while the setting holds
        return df
    finally:
        spark.conf.set(key, old)


def main(sf_dir: str) -> None:
    spark = build_session("local[8]", shuffle_partitions=8)
    t = Tables(spark, sf_dir)
    out = ["# Physical plans of the main operators", "",
           f"Generated by `tools/plans.py` on `{sf_dir}` (`local[8]`, AQE on; initial plans).", ""]
    for title, df in plans(spark, t):
        text = df._jdf.queryExecution().executedPlan().toString()
        out += [f"## {title}", "", "```", text.rstrip(), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
