"""Benchmark data generators (G1, G2) as Spark jobs.

G1 derives every value from two 64-bit hashes of a seed row, so it is
deterministic and runs in parallel; the reference draws from a sequential
random stream per writer. The dependencies of the reference's data hold:
``device_id`` fixes ``event`` (20 divides 10,000), ``event`` fixes
``active``, and ``user_id`` fixes ``count`` (10,000 divides 100,000).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the benchmark table.
EVENTS = ["page_view", "click", "purchase", "login", "logout", "signup", "search",
          "add_to_cart", "remove_from_cart", "checkout", "payment_success", "payment_failed",
          "refund", "share", "like", "comment", "view_product", "download", "install",
          "uninstall"]
DEVICE_COUNT = 10_000
USER_COUNT = 100_000
TS_START_MS = 1_672_531_200_000  # 2023-01-01 00:00:00 UTC
TS_RANGE_MS = 63_072_000_000  # two years

# Fixed values of the small example data (users and their events).
USERS = [
    ("us-east", 1, "Alice", 30, 95.5, True),
    ("us-east", 2, "Bob", 25, 88.0, True),
    ("us-east", 3, "Charlie", 35, 72.3, False),
    ("us-west", 4, "Diana", 28, 91.2, True),
    ("us-west", 5, "Eve", 22, 67.8, False),
    ("eu-west", 6, "Frank", 40, 85.1, True),
    ("eu-west", 7, "Grace", 33, 90.0, True),
    ("eu-west", 8, "Hank", 45, 78.5, False),
    ("ap-south", 9, "Ivy", 27, 93.4, True),
    ("ap-south", 10, "Jack", 31, 82.7, True),
]
USERS_SCHEMA = "region string, user_id bigint, name string, age int, score double, active boolean"
EVENT_TYPES = ["login", "purchase", "logout"]
EVENT_REGIONS = ["us-east", "us-west", "eu-west", "ap-south"]
EVENT_HOURS = [0, 1, 2]


def bench_events(seed: DataFrame, key_cols) -> DataFrame:
    """One benchmark event per row of ``seed``, derived from its key columns."""
    keys = [F.col(c) for c in ([key_cols] if isinstance(key_cols, str) else key_cols)]
    return events_of(seed.select(F.xxhash64(*keys, F.lit(1)).alias("r1"), F.xxhash64(*keys, F.lit(2)).alias("r2")))


def events_of(base: DataFrame) -> DataFrame:
    """The benchmark events of two 64-bit numbers ``r1`` and ``r2`` a row."""
    hex16 = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    both = F.concat(hex16(F.col("r1")), hex16(F.col("r2")))
    uuid = F.regexp_replace(both, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    events = F.array(*[F.lit(e) for e in EVENTS])
    ms = F.lit(TS_START_MS) + F.pmod(F.col("r1"), F.lit(TS_RANGE_MS))
    return base.select(
        uuid.alias("id"),
        F.timestamp_millis(ms).alias("ts"),
        F.concat(F.lit("dev-"), F.lpad(F.pmod("r1", F.lit(DEVICE_COUNT)).cast("string"), 5, "0")).alias("device_id"),
        F.concat(F.lit("user-"), F.lpad(F.pmod("r2", F.lit(USER_COUNT)).cast("string"), 6, "0")).alias("user_id"),
        F.element_at(events, (F.pmod("r1", F.lit(len(EVENTS))) + 1).cast("int")).alias("event"),
        (F.pmod("r1", F.lit(1_000_000)) / F.lit(100.0)).alias("value"),
        F.pmod("r2", F.lit(10_000)).cast("int").alias("count"),
        (F.pmod("r1", F.lit(2)) == 0).alias("active"),
    )


def bench_events_range(spark: SparkSession, rows: int) -> DataFrame:
    """``rows`` benchmark events seeded by ``spark.range`` (loading a test cluster)."""
    return bench_events(spark.range(rows), "id")


def example_users(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(USERS, USERS_SCHEMA)


def example_events(spark: SparkSession, users: int = 10, days: int = 30) -> DataFrame:
    """Users x days x 3 events (900 rows by default), as the small example data."""
    per_user = days * len(EVENT_TYPES)
    i = F.col("id")
    grid = spark.range(users * per_user).select(
        (F.call_function("div", i, F.lit(per_user)) + 1).alias("user_id"),
        F.call_function("div", F.pmod(i, F.lit(per_user)), F.lit(len(EVENT_TYPES))).alias("day"),
        F.pmod(i, F.lit(len(EVENT_TYPES))).alias("ev"))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    hours = F.array(*[F.lit(h) for h in EVENT_HOURS])
    ts = F.timestamp_add("HOUR", F.col("day") * 24 + F.element_at(hours, (F.col("ev") + 1).cast("int")), start)
    return grid.select(
        "user_id",
        ts.alias("event_time"),
        F.element_at(F.array(*[F.lit(t) for t in EVENT_TYPES]), (F.col("ev") + 1).cast("int")).alias("event_type"),
        F.element_at(F.array(*[F.lit(r) for r in EVENT_REGIONS]),
                     (F.pmod("user_id", F.lit(4)) + 1).cast("int")).alias("region"),
        F.pmod(F.col("user_id") * F.col("day") + F.col("ev"), F.lit(100)).cast("int").alias("value"),
    )
