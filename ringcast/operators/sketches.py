"""Approximate aggregates that can be stored and merged (Q10).

One distinct-count sketch and one quantile sketch per split of the ring, written
as a small table (a few kilobytes a split, whatever the rows). The figures of any
set of splits, or of the whole table, then come from merging their sketches: the
rows are read once. Sketches are built by partial aggregation, so a hot split
sends one sketch per task to the shuffle, not its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringcast.operators.ring import SPLIT_COL, token_scan

LOG_BUCKETS = 14  # registers of the distinct-count sketch, as a power of two
ACCURACY = 400  # k of the quantile sketch
# Three standard errors of each at these sizes: of the count, and of a quantile's rank.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LOG_BUCKETS / 2)
RANK_ERROR = 0.01


def sketch_by_split(df: DataFrame, partition_keys, splits: int, distinct: str | Column, value: str | Column,
                    token_method: str = "xxhash64") -> DataFrame:
    """``split_id, rows, distinct_sketch, value_sketch`` of every split with rows;
    null values are in no sketch."""
    counted = (F.col(distinct) if isinstance(distinct, str) else distinct).alias("__distinct")
    measured = (F.col(value) if isinstance(value, str) else value).cast("double").alias("__value")
    scanned = token_scan(df, partition_keys, splits, token_method=token_method, keep_token=False,
                         token_col="__ring_token", split_col=SPLIT_COL)
    return scanned.select(SPLIT_COL, counted, measured).groupBy(SPLIT_COL).agg(
        F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg("__distinct", LOG_BUCKETS).alias("distinct_sketch"),
        F.call_function("kll_sketch_agg_double", F.col("__value"), F.lit(ACCURACY)).alias("value_sketch"))


def merged(sketches: DataFrame, by=(), quantiles=(0.5,)) -> DataFrame:
    """Rows, distinct count and quantiles of the sketches' union, per group ``by``."""
    groups = [by] if isinstance(by, (str, Column)) else list(by)
    one = sketches.groupBy(*groups).agg(
        F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct"),
        F.call_function("kll_merge_agg_double", F.col("value_sketch")).alias("__values"))
    points = [F.call_function("kll_sketch_get_quantile_double", F.col("__values"), F.lit(float(q))) for q in quantiles]
    return one.withColumn("quantiles", F.array(*points)).drop("__values")
