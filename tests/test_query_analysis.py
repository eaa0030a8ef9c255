"""What the session's parser and analyzer tell: statement kinds, marker types, key and range reduction."""

import pytest
from pyspark.sql import functions as F

from ringcast.operators import fanout as fo
from ringcast.operators.parsed import TransformError, table_places
from ringcast.operators.transform import check_query_text
from ringcast.plans.export import query_export
from ringcast.sources.params import ParamError
from ringcast.sources.table import Tables

from conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("sql", ["EXPLAIN SELECT 1", "SHOW TABLES", "CREATE TABLE t AS SELECT 1", "CACHE TABLE t", "USE x",
                                 "MERGE INTO t USING s ON t.a = s.a WHEN MATCHED THEN DELETE", "UPDATE t SET a = 1",
                                 "DELETE FROM t", "EXECUTE IMMEDIATE 'DROP TABLE t'", "CALL x()", "BEGIN SELECT 1; END",
                                 "ANALYZE TABLE t COMPUTE STATISTICS", "FROM t INSERT INTO u SELECT *", "SELECT 1; DROP TABLE t",
                                 "SELECT 1 +", "SELECT 'open"])
def test_everything_but_a_query_is_refused(spark, sql):
    with pytest.raises(TransformError):
        check_query_text(sql)


@pytest.mark.parametrize("sql", ["FROM t |> WHERE a > 1", "SELECT 'DROP TABLE x; --' AS a", "SELECT `insert into` FROM t",
                                 "WITH a AS (SELECT 1) SELECT * FROM a ;;", "SELECT r'\\' AS a -- '"])
def test_queries_pass(spark, sql):
    assert check_query_text(sql)


def test_table_places(spark):
    sql = "SELECT * FROM events e JOIN users ON e.k = users.k WHERE k IN (SELECT k FROM events)"
    assert [(sql[a:b], aliased) for a, b, aliased in table_places(spark, sql, "events")] == [("events", True), ("events", False)]
    assert [(sql[a:b], aliased) for a, b, aliased in table_places(spark, sql, "USERS")] == [("users", False)]


def test_marker_types_come_from_the_query(spark):
    t = Tables(spark, SF_SMALL)
    text = ("SELECT * FROM events WHERE user_id = :uid AND event_type IN (:kind, 'view') AND ts >= :t0 "
            "AND value * :scale > 3 AND CAST(ts AS DATE) <> :day")
    assert fo.infer_markers(spark, text, {"events": t.events}) == {
        "uid": "bigint", "kind": "text", "t0": "timestamp", "scale": "double", "day": "date"}
    assert fo.infer_markers(spark, "SELECT * FROM events WHERE user_id = ? AND event_type = ?", {"events": t.events}) == {
        "p0": "bigint", "p1": "text"}
    assert fo.infer_markers(spark, "SELECT 1 AS x") == {}
    with pytest.raises(ValueError, match="nothing"):
        fo.infer_markers(spark, "SELECT :nothing AS x FROM events", {"events": t.events})
    with pytest.raises(ValueError, match="ambiguous.*uid"):
        fo.infer_markers(spark, "SELECT * FROM events WHERE user_id = :uid OR event_type = :uid", {"events": t.events})
    declared = fo.infer_markers(spark, "SELECT * FROM events WHERE user_id = :uid OR event_type = :uid", {"events": t.events},
                                {"uid": "int"})
    assert declared == {"uid": "int"}


def test_query_export_without_marker_types(spark, tmp_out):
    with open(tmp_out + "/p.ndjson", "w") as f:
        f.write('{"uid":7}\n{"uid":8}\n{"uid":7}\n')
    events = Tables(spark, SF_SMALL).events
    res = query_export(spark, "SELECT * FROM events WHERE user_id = :uid", tmp_out + "/out.parquet",
                       params_path=tmp_out + "/p.ndjson", tables={"events": events})
    assert res.rows == 2 * events.filter("user_id = 7").count() + events.filter("user_id = 8").count()
    with open(tmp_out + "/q.ndjson", "w") as f:
        f.write('{"uid":"7"}\n')
    with pytest.raises(ParamError, match="expected integer"):
        query_export(spark, "SELECT * FROM events WHERE user_id = :uid", tmp_out + "/out2.parquet",
                     params_path=tmp_out + "/q.ndjson", tables={"events": events})


def per_set(rows, name="param_set"):
    return sorted(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("broadcast", ["auto", "never"])
def test_keys_are_reduced_below_limit_and_aggregate(spark, broadcast):
    events = Tables(spark, SF_SMALL).events
    params = spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, 999999)], "param_set bigint, uid bigint")
    limit = fo.query_fanout(spark, "SELECT event_id FROM events WHERE user_id = :uid ORDER BY ts, event_id LIMIT 2", params,
                            tables={"events": events}, set_col="param_set", broadcast=broadcast)
    want = []
    for s, uid in [(1, 7), (2, 7), (3, 8)]:
        want += [(s, r.event_id) for r in events.filter(F.col("user_id") == uid).orderBy("ts", "event_id").limit(2).collect()]
    assert per_set(limit) == sorted(want)
    count = fo.query_fanout(spark, "SELECT COUNT(*) AS n FROM events e WHERE :uid = e.user_id AND value > 0", params,
                            tables={"events": events}, set_col="param_set", broadcast=broadcast)
    assert per_set(count) == [(s, events.filter(f"user_id = {uid} AND value > 0").count())
                              for s, uid in [(1, 7), (2, 7), (3, 8), (4, 999999)]]
    for df in (limit, count):
        assert "LeftSemi" in plan_of(df)


def test_semi_join_comes_before_the_first_exchange(spark):
    events = Tables(spark, SF_SMALL).events
    params = spark.createDataFrame([(7,)], "uid bigint")
    plan = plan_of(fo.query_fanout(spark, "SELECT COUNT(*) AS n FROM events WHERE user_id = :uid", params, tables={"events": events}))
    lines = plan.splitlines()
    semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
    # on the way up from the semi join: a partial aggregate, then the exchange
    above = [x for x in lines[:semi] if "Exchange hashpartitioning" in x or "HashAggregate" in x]
    assert "partial_count" in above[-1] and "Exchange" in above[-2]


def test_tables_named_twice_are_not_reduced(spark):
    events = Tables(spark, SF_SMALL).events
    params = spark.createDataFrame([(7,), (8,)], "uid bigint")
    text = "SELECT COUNT(*) AS n, (SELECT COUNT(*) FROM events) AS total FROM events WHERE user_id = :uid"
    got = fo.query_fanout(spark, text, params, tables={"events": events}, set_col="uid")
    assert {r.total for r in got.collect()} == {events.count()}


@pytest.mark.parametrize("text", [
    "SELECT event_id FROM events WHERE ts >= :t0 AND ts < :t1",
    "SELECT e.event_id FROM events AS e WHERE :t0 <= e.ts AND e.ts < :t1 AND value IS NOT NULL",
    "WITH x AS (SELECT * FROM events WHERE ts >= :t0 AND ts < :t1) SELECT event_id FROM x"])
def test_range_only_sets_have_no_nested_loop(spark, text):
    events = Tables(spark, SF_SMALL).events
    days = events.select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("t0")).distinct()
    params = days.select("t0", (F.col("t0") + F.expr("INTERVAL 90 MINUTES")).alias("t1"))
    params = params.unionAll(spark.sql("SELECT timestamp_ntz'1900-01-01' AS t0, timestamp_ntz'2900-01-01' AS t1"))
    got = fo.query_fanout(spark, text, params, tables={"events": events})
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)
    extra = " AND value IS NOT NULL" if "value" in text else ""
    want = events.alias("e").join(params.alias("p"), F.expr("e.ts >= p.t0 AND e.ts < p.t1" + extra)).select("event_id")
    assert sorted(r.event_id for r in got.collect()) == sorted(r.event_id for r in want.collect())


def test_range_per_set_with_limit_and_count(spark):
    orders = Tables(spark, SF_SMALL).orders
    params = spark.createDataFrame([(1, 1000.0, 50000.0), (2, 1000.0, 50000.0), (3, 5.0, 1.0), (4, None, 9.0), (5, 0.0, 1e300)],
                                   "param_set int, lo double, hi double")
    got = fo.query_fanout(spark, "SELECT COUNT(*) AS n FROM orders WHERE o_totalprice BETWEEN :lo AND :hi", params,
                          tables={"orders": orders}, set_col="param_set")
    n = orders.filter("o_totalprice BETWEEN 1000 AND 50000").count()
    assert per_set(got) == [(1, n), (2, n), (3, 0), (4, 0), (5, orders.count())]
    assert "NestedLoop" not in plan_of(got)
    first = fo.query_fanout(spark, "SELECT o_orderkey FROM orders WHERE o_totalprice > :lo AND o_totalprice < :hi "
                                   "ORDER BY o_totalprice, o_orderkey LIMIT 3", params, tables={"orders": orders}, set_col="param_set")
    assert "NestedLoop" not in plan_of(first)
    cheapest = [r.o_orderkey for r in orders.orderBy("o_totalprice", "o_orderkey").limit(3).collect()]
    assert [r.o_orderkey for r in first.filter("param_set = 5").collect()] == cheapest


def test_range_markers_named_elsewhere_too(spark):
    orders = Tables(spark, SF_SMALL).orders
    params = spark.createDataFrame([(1000.0, 50000.0), (5.0, 2000.0)], "lo double, hi double")
    for text in ("SELECT :lo AS lo, o_orderkey FROM orders WHERE o_totalprice BETWEEN :lo AND :hi",
                 "SELECT o_orderkey, o_totalprice, o_custkey FROM orders WHERE o_totalprice BETWEEN :lo AND :hi "
                 "UNION ALL SELECT 1L, 2D, 3L"):
        got = fo.query_fanout(spark, text, params, tables={"orders": orders})
        n = sum(orders.filter(f"o_totalprice BETWEEN {a} AND {b}").count() for a, b in [(1000.0, 50000.0), (5.0, 2000.0)])
        assert got.count() == n + (2 if "UNION" in text else 0)
    star = fo.query_fanout(spark, "SELECT * FROM orders WHERE o_totalprice BETWEEN :lo AND :hi", params, tables={"orders": orders})
    assert star.columns == orders.columns and star.count() == n
