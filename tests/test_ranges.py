"""Range join against a comparison of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from ringcast.operators import fanout as fo
from ringcast.operators.ranges import range_join


def pairs(df):
    return sorted((r.i, r.j) for r in df.select("s.i", "p.j").collect())


@pytest.mark.parametrize("bounds", ["[]", "[)", "(]", "()"])
@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(20,4)", "date", "timestamp", "timestamp_ntz", "int"])
def test_equals_all_pairs(spark, kind, bounds):
    rng = random.Random(hash(kind) % 100)
    scale = {"bigint": 10 ** 9, "double": 1e3, "decimal(20,4)": 100, "date": 20000, "int": 2000}.get(kind, 10 ** 9)
    values = [rng.uniform(-scale, scale) * rng.choice([1, 0.001, 1e-6]) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(values)) + [(1000, None)], "i int, x double")
    ranges = []
    for j in range(60):
        low = rng.choice(values) if j % 3 else rng.uniform(-scale, scale)
        ranges.append((j, low, low + rng.choice([0.0, 1.0, scale * rng.random(), scale * 1e-4, 3 * scale, -1.0])))
    ranges += [(100, None, 1.0), (101, 1.0, None), (102, -2.0 * scale, 2.0 * scale)]
    sets = spark.createDataFrame(ranges, "j int, lo double, hi double")

    def cast(c):
        if kind == "date":
            return F.date_add(F.lit("1980-01-01").cast("date"), F.col(c).cast("int"))
        if kind.startswith("timestamp"):
            return F.timestamp_micros((F.col(c) * 1000).cast("bigint")).cast(kind)
        return F.col(c).cast(kind)

    rows, sets = rows.select("i", cast("x").alias("x")), sets.select("j", cast("lo").alias("lo"), cast("hi").alias("hi"))
    got = range_join(rows, sets, "x", "lo", "hi", bounds)
    over, under = {"[]": (">=", "<="), "[)": (">=", "<"), "(]": (">", "<="), "()": (">", "<")}[bounds]
    want = rows.alias("s").join(sets.alias("p"), F.expr(f"s.x {over} p.lo AND s.x {under} p.hi"))
    assert pairs(got) == pairs(want) and got.count() > 50


def test_special_doubles(spark):
    inf, nan = float("inf"), float("nan")
    rows = spark.createDataFrame([(0, 0.0), (1, -0.0), (2, inf), (3, -inf), (4, nan), (5, 1e308), (6, 5e-324)], "i int, x double")
    sets = spark.createDataFrame([(0, -inf, inf), (1, 0.0, 0.0), (2, 0.0, nan), (3, nan, nan), (4, -1e308, 1e308), (5, inf, inf),
                                  (6, 5e-324, 1e-300)], "j int, lo double, hi double")
    want = rows.alias("s").join(sets.alias("p"), F.expr("s.x BETWEEN p.lo AND p.hi"))
    assert pairs(range_join(rows, sets, "x", "lo", "hi")) == pairs(want)


def test_empty_sides_and_refused_types(spark):
    rows = spark.createDataFrame([(1, 1.0)], "i int, x double")
    none = spark.createDataFrame([], "j int, lo double, hi double")
    assert range_join(rows, none, "x", "lo", "hi").count() == 0
    with pytest.raises(ValueError, match="range join"):
        range_join(rows, spark.createDataFrame([(1, "a", "b")], "j int, lo string, hi string"), "x", "lo", "hi")
    with pytest.raises(ValueError, match="bounds"):
        range_join(rows, none, "x", "lo", "hi", "[[")


def test_fanout_between(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    sets = spark.createDataFrame([(1, 10, 20, 3), (2, 990, 2000, 4), (3, 10, 20, 3)], "param_set int, lo long, hi long, k long")
    got = fo.fanout(rows, sets, between=("id", "lo", "hi", "[)"), set_col="param_set")
    assert sorted((r.param_set, r.id) for r in got.collect()) == \
        [(s, i) for s, a, b in [(1, 10, 20), (2, 990, 1000), (3, 10, 20)] for i in range(a, b)]
    keyed = fo.fanout(rows, sets, on="k", between=("id", "lo", "hi"), set_col="param_set")
    assert sorted((r.param_set, r.id) for r in keyed.collect()) == [(1, 10), (1, 17), (2, 991), (2, 998), (3, 10), (3, 17)]
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    counted = fo.fanout_count(rows, sets, between=("id", "lo", "hi"), keep_params=False)
    assert sorted((r.param_set, r.cnt) for r in counted.collect()) == [(1, 11), (2, 10), (3, 11)]
    limited = fo.fanout_limit(rows, sets, 2, "id", between=("id", "lo", "hi"))
    assert sorted((r.param_set, r.id) for r in limited.collect()) == [(1, 10), (1, 11), (2, 990), (2, 991), (3, 10), (3, 11)]
