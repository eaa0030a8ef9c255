"""The seven reference scenarios on the 10-row fixture (users table)."""

from pyspark.sql import functions as F

from ringcast.operators import fanout as fo
from ringcast.operators.transform import transform
from ringcast.plans.generate import example_events, example_users


def test_simple_count(spark):
    users = example_users(spark)
    out = transform(spark, users, "SELECT COUNT(*) AS n FROM source")
    assert out.first().n == 10
    assert {"region", "user_id", "name"} <= set(users.columns)


def test_limit_in_query(spark):
    users = example_users(spark)
    out = fo.run_query(spark, "SELECT * FROM test_export ORDER BY user_id LIMIT 5",
                       tables={"test_export": users})
    assert out.count() == 5


def test_single_parameter_set(spark):
    users = example_users(spark)
    rows = fo.run_query(spark, "SELECT * FROM test_export WHERE region = :region",
                        args={"region": "us-east"}, tables={"test_export": users})
    out = transform(spark, rows, "SELECT * FROM source WHERE region = 'us-east' ORDER BY user_id")
    got = out.collect()
    assert len(got) == 3 and all(r.region == "us-east" for r in got)
    assert [r.user_id for r in got] == [1, 2, 3]


def test_several_markers(spark):
    users = example_users(spark)
    params = spark.createDataFrame([("us-east", 25)], "region string, min_age int")
    got = fo.fanout(users, params, on="region", condition="s.age > p.min_age").collect()
    assert sorted(r.name for r in got) == ["Alice", "Charlie"]


def test_concurrent_sets(spark):
    users = example_users(spark)
    params = spark.createDataFrame([("us-east",), ("us-west",), ("eu-west",)], "region string")
    got = fo.fanout(users, params, on="region")
    assert got.count() == 8
    assert transform(spark, got, "SELECT DISTINCT region FROM source").count() == 3


def test_concurrent_sets_two_markers(spark):
    users = example_users(spark)
    params = spark.createDataFrame([("us-east", 25), ("us-west", 20), ("eu-west", 30)],
                                   "region string, min_age int")
    # The reference asserts >= 5; the exact answer is 2 + 2 + 3.
    assert fo.fanout(users, params, on="region", condition="s.age > p.min_age").count() == 7


def test_grouped_sql(spark):
    users = example_users(spark)
    out = transform(spark, users, "SELECT region, COUNT(*) AS cnt, AVG(age) AS avg_age "
                                  "FROM source GROUP BY region ORDER BY region")
    got = {r.region: (r.cnt, round(r.avg_age, 2)) for r in out.collect()}
    assert got == {"ap-south": (2, 29.0), "eu-west": (3, 39.33), "us-east": (3, 30.0),
                   "us-west": (2, 25.0)}


def test_example_events_shape(spark):
    ev = example_events(spark)
    assert ev.count() == 900
    one = ev.filter((F.col("user_id") == 1) & (F.col("event_time") >= "2024-01-15")
                    & (F.col("event_time") < "2024-01-20"))
    assert one.count() == 15
    assert ev.filter("user_id = 1").select("region").distinct().first().region == "us-west"
