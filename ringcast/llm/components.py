"""Connected components by alternating large-star and small-star rounds.

Each round's edges are written as Parquet under the shared checkpoint folder,
so a lost executor re-reads files. A node's neighbours are only ever reduced to
their minimum (partial aggregation before the shuffle). The minima are stored
before the edges are joined with them: a join of two stored tables is split by
AQE where a hub has a third of all edges, a join with an aggregate is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringcast.llm.ship import drop
from ringcast.session import materialize


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (columns ``u``, ``v``, longs): root
    is the smallest node reachable. Loops, repeated edges and nulls are ignored."""
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
        .filter("u is not null and v is not null and u <> v").distinct()
    e = materialize(e, "cc")
    state = _state(e)
    spark = edges.sparkSession
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low_of_all = materialize(both.groupBy("u").agg(F.min("v").alias("m")), "cc")
        large = both.join(low_of_all, "u").filter("v > u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = materialize(large, "cc")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "cc")
        drop(spark, e, low_of_all)
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*") \
            .filter("u <> v").distinct()
        e = materialize(small, "cc")
        drop(spark, large, low)
        now = _state(e)
        if now == state:
            break
        state = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
