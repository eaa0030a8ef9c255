from pyspark.sql import functions as F

from ringcast.plans.generate import EVENTS, bench_events_range


def test_bench_events_dependencies(spark):
    ev = bench_events_range(spark, 50000)
    assert ev.count() == 50000
    assert ev.select("id").distinct().count() == 50000
    assert ev.groupBy("device_id").agg(F.countDistinct("event").alias("n")).filter("n > 1").count() == 0
    assert ev.groupBy("event").agg(F.countDistinct("active").alias("n")).filter("n > 1").count() == 0
    assert ev.groupBy("user_id").agg(F.countDistinct("count").alias("n")).filter("n > 1").count() == 0
    r = ev.agg(F.min("ts"), F.max("ts"), F.countDistinct("event")).first()
    assert str(r[0]) >= "2023-01-01" and str(r[1]) < "2025-01-01" and r[2] == len(EVENTS)
