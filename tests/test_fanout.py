import datetime as dt

import pytest
from pyspark.sql import functions as F

from ringcast.operators import fanout as fo
from ringcast.sources.table import Tables

from conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fanout_is_union_all_of_single_queries(spark):
    ev = Tables(spark, SF_SMALL).events
    sets = [(1, "click"), (1, "click"), (2, "view"), (3, "error")]
    params = spark.createDataFrame(sets, "user_id bigint, event_type string")
    got = fo.fanout(ev, params, on=["user_id", "event_type"])
    expected = None
    for uid, et in sets:
        one = ev.filter((F.col("user_id") == uid) & (F.col("event_type") == et))
        expected = one if expected is None else expected.unionAll(one)
    assert _rows(got) == _rows(expected)


def test_fanout_residual_and_range(spark):
    ev = Tables(spark, SF_SMALL).events
    params = spark.createDataFrame([(1, dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20), 10.0)],
                                   "user_id bigint, t0 timestamp_ntz, t1 timestamp_ntz, v double")
    got = fo.fanout(ev, params, on="user_id", condition="s.ts >= p.t0 AND s.ts < p.t1 AND s.value > p.v")
    exp = ev.filter((F.col("user_id") == 1) & (F.col("ts") >= dt.datetime(2024, 1, 5))
                    & (F.col("ts") < dt.datetime(2024, 1, 20)) & (F.col("value") > 10.0))
    assert _rows(got) == _rows(exp)


def test_broadcast_only_after_measuring(spark):
    ev = Tables(spark, SF_SMALL).events
    params = spark.createDataFrame([(1,)], "user_id bigint")
    plan = fo.fanout(ev, params, on="user_id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    big, is_b = fo.maybe_broadcast(params, max_bytes=1)
    assert not is_b
    size = fo.measure(spark.createDataFrame([("abc",), ("de",)], "s string"))
    assert size.rows == 2 and size.bytes == 2 * 16 + 5


def test_predicate_only_fanout_is_the_same_at_every_size(spark):
    ev = Tables(spark, SF_SMALL).events
    params = spark.createDataFrame([(50.0,), (80.0,)], "v double")
    want = ev.filter("value > 50").count() + ev.filter("value > 80").count()
    for kw in ({}, {"broadcast": "never"}, {"max_broadcast_bytes": 1}, {"broadcast": True, "max_broadcast_bytes": 1}):
        assert fo.fanout(ev, params, condition="s.value > p.v", **kw).count() == want
    with pytest.raises(ValueError):
        fo.fanout(ev, params)


def test_fanout_over_a_source_with_its_own_cross_join(spark):
    ev = Tables(spark, SF_SMALL).events
    source = ev.crossJoin(spark.range(2).withColumnRenamed("id", "side"))
    params = spark.createDataFrame([(7,)], "user_id bigint")
    for size in (1, 1 << 25):
        got = fo.fanout(source, params, on="user_id", max_broadcast_bytes=size).count()
        assert got == 2 * ev.filter("user_id = 7").count()


def test_limit_per_set_keeps_sets_apart(spark):
    ev = Tables(spark, SF_SMALL).events
    params = spark.createDataFrame([(1,), (1,), (2,)], "user_id bigint")
    got = fo.fanout_limit(ev, params, 2, [F.col("ts").desc(), "event_id"], on="user_id")
    per_set = {r[0]: r[1] for r in got.groupBy("param_set").count().collect()}
    assert len(per_set) == 3 and all(v <= 2 for v in per_set.values())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_count_per_set_keeps_empty_sets(spark):
    ev = Tables(spark, SF_SMALL).events
    params = spark.createDataFrame([(1, 1), (2, 1), (3, 999999)], "param_set bigint, user_id bigint")
    got = {r.param_set: r.cnt for r in fo.fanout_count(ev, params, on="user_id").collect()}
    n1 = ev.filter("user_id = 1").count()
    assert got == {1: n1, 2: n1, 3: 0}


def test_empty_params_give_no_rows(spark):
    ev = Tables(spark, SF_SMALL).events
    assert fo.fanout(ev, spark.createDataFrame([], "user_id bigint"), on="user_id").count() == 0


def test_set_ids_are_stable(spark):
    params = spark.createDataFrame([(1,), (1,)], "user_id bigint")
    numbered = fo.with_set_ids(params)
    a = sorted(r.param_set for r in numbered.collect())
    b = sorted(r.param_set for r in numbered.collect())
    assert a == b and len(set(a)) == 2


def test_latest_per_key(spark):
    ev = Tables(spark, SF_SMALL).events
    got = fo.latest_per_key(ev, "user_id", [F.col("ts").desc(), "event_id"])
    assert got.count() == ev.select("user_id").distinct().count()


def test_bind_markers_skips_quotes_comments_and_casts():
    text, used = fo.bind_markers("SELECT ':a', `:b`, x::int FROM t WHERE k = :k AND v > ? -- :c\n AND w = ?")
    assert used == ["k", "p0", "p1"]
    assert "':a'" in text and "`:b`" in text and "x::int" in text and "-- :c" in text


def test_query_fanout_equals_single_runs(spark):
    ev = Tables(spark, SF_SMALL).events
    sets = [(1, "click"), (1, "click"), (2, "view")]
    params = spark.createDataFrame(sets, "uid bigint, kind string")
    text = "SELECT * FROM events WHERE user_id = :uid AND event_type = :kind"
    got = fo.query_fanout(spark, text, params, tables={"events": ev})
    expected = None
    for uid, kind in sets:
        one = fo.run_query(spark, text, args={"uid": uid, "kind": kind}, tables={"events": ev})
        expected = one if expected is None else expected.unionAll(one)
    assert _rows(got) == _rows(expected)


def test_query_fanout_limit_and_count_per_set(spark):
    ev = Tables(spark, SF_SMALL).events
    params = spark.createDataFrame([(1, 1), (2, 1), (3, 424242)], "param_set bigint, uid bigint")
    limited = fo.query_fanout(spark, "SELECT * FROM events WHERE user_id = :uid ORDER BY ts, event_id LIMIT 2",
                              params, tables={"events": ev}, set_col="param_set")
    assert sorted(r[0] for r in limited.groupBy("param_set").count().collect()) == [1, 2]
    counted = fo.query_fanout(spark, "SELECT COUNT(*) AS n FROM events WHERE user_id = :uid",
                              params, tables={"events": ev}, set_col="param_set")
    got = {r.param_set: r.n for r in counted.collect()}
    assert got[3] == 0 and got[1] == got[2] == ev.filter("user_id = 1").count()


def test_query_fanout_missing_param_column(spark):
    params = spark.createDataFrame([(1,)], "a bigint")
    with pytest.raises(ValueError):
        fo.query_fanout(spark, "SELECT * FROM events WHERE user_id = :uid", params)


def test_count_pre_aggregated_when_sets_are_big(spark):
    ev = Tables(spark, SF_SMALL).events
    params = spark.createDataFrame([(1, 1), (2, 1), (3, 999999), (4, 2)], "param_set bigint, user_id bigint")
    small = fo.fanout_count(ev, params, on="user_id")
    big = fo.fanout_count(ev, params, on="user_id", max_broadcast_bytes=1)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def _skewed_events(spark):
    ev = Tables(spark, SF_SMALL).events
    # a third of the rows share user 1
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1).cast("bigint"))
                         .otherwise(F.col("user_id")))


def test_hot_set_limit_ships_bounded_rows(spark):
    ev = _skewed_events(spark)
    params = spark.createDataFrame([(1, 1)], "param_set bigint, user_id bigint")
    got = fo.fanout_limit(ev, params, 5, [F.col("ts").desc(), "event_id"], on="user_id")
    assert got.count() == 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_hive_value_is_split_over_files(spark, tmp_out):
    from ringcast.sinks.writer import write

    # AQE splits a hot partition at map-output boundaries: give it several map tasks.
    _skewed_events(spark).repartition(8).write.parquet(tmp_out + "/in")
    ev = spark.read.parquet(tmp_out + "/in").withColumn("hot", (F.col("user_id") == 1))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        write(ev, tmp_out + "/h", fmt="parquet", partition_by="hot")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    import os
    hot_files = [f for f in os.listdir(tmp_out + "/h/hot=true") if f.endswith(".parquet")]
    assert len(hot_files) > 1
    assert spark.read.parquet(tmp_out + "/h").count() == ev.count()


def test_query_fanout_is_the_same_at_every_size(spark):
    ev = Tables(spark, SF_SMALL).events
    params = spark.createDataFrame([(10.0,), (20.0,)], "v double")
    text = "SELECT COUNT(*) AS n FROM events WHERE value > :v"
    ok = fo.query_fanout(spark, text, params, tables={"events": ev})
    assert sorted(r.n for r in ok.collect()) == sorted(
        [ev.filter("value > 20").count(), ev.filter("value > 10").count()])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = fo.query_fanout(spark, text, params, tables={"events": ev}, max_broadcast_bytes=1)
        assert sorted(r.n for r in again.collect()) == sorted(r.n for r in ok.collect())
        keyed = fo.query_fanout(spark, "SELECT COUNT(*) AS n FROM events WHERE user_id = :u",
                                spark.createDataFrame([(1,)], "u bigint"), tables={"events": ev},
                                max_broadcast_bytes=1)
        assert keyed.first().n == ev.filter("user_id = 1").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_key_on_shuffle_join_is_split(spark, tmp_out):
    # Sets too big to broadcast; one key holds a third of the rows.
    _skewed_events(spark).repartition(8).write.parquet(tmp_out + "/ev")
    ev = spark.read.parquet(tmp_out + "/ev")
    params = spark.range(1, 200).select(F.col("id").alias("user_id"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = fo.fanout(ev, params, on="user_id", broadcast="never")
        n = len(out.collect())  # runs this plan, so AQE's final plan is recorded
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert n == ev.filter("user_id BETWEEN 1 AND 199").count()
    assert "SortMergeJoin" in plan and "skew=true" in plan
