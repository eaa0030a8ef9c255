import datetime as dt

import pytest
from pyspark.sql import functions as F

from ringcast.functions import convert as cv


def test_date_raw_including_pre_1970(spark):
    df = spark.createDataFrame([(2 ** 31,), (2 ** 31 - 1,), (2 ** 31 + 19723,), (-1,), (2 ** 32,)], "raw bigint")
    got = [r.d for r in df.select(cv.date_from_raw("raw").alias("d")).collect()]
    assert got == [dt.date(1970, 1, 1), dt.date(1969, 12, 31), dt.date(2024, 1, 1), None, None]
    back = df.limit(3).select(cv.raw_from_date(cv.date_from_raw("raw")).alias("r")).collect()
    assert [r.r for r in back] == [2 ** 31, 2 ** 31 - 1, 2 ** 31 + 19723]


def test_time_ns(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 13, 5, 7, 123456),)], "ts timestamp_ntz")
    r = df.select(cv.time_ns_of_day("ts").alias("ns")).select("ns", cv.format_time_ns("ns").alias("t")).first()
    assert r.ns == ((13 * 3600 + 5 * 60 + 7) * 1_000_000 + 123456) * 1000
    assert r.t == "13:05:07.123456000"
    assert spark.range(1).select(cv.format_time_ns(F.lit(-1)).alias("t")).first().t is None


def test_timestamp_millis_floor(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),),
                                (dt.datetime(1969, 12, 31, 23, 59, 59, 999500),)], "ts timestamp_ntz")
    got = [r.t for r in df.select(cv.floor_millis_ntz("ts").alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 0, 0, 7, 179000), dt.datetime(1969, 12, 31, 23, 59, 59, 999000)]


def test_mismatch_becomes_null(spark):
    df = spark.createDataFrame([("12",), ("x",), ("300",)], "s string")
    got = [r.v for r in df.select(cv.to_tinyint("s").alias("v")).collect()]
    assert got == [12, None, None]
    arr = spark.createDataFrame([(["1", "x", None],)], "a array<string>")
    assert arr.select(cv.list_of("a", "int").alias("l")).first().l == [1, None, None]
    null_list = spark.createDataFrame([(None,)], "a array<string>")
    assert null_list.select(cv.list_of("a", "int").alias("l")).first().l is None


def test_set_and_map(spark):
    df = spark.createDataFrame([([3, 1, 3, 2], {"b": 2, "a": 1})], "a array<int>, m map<string,int>")
    r = df.select(cv.set_of("a").alias("s"), cv.map_to_text(cv.map_text_text("m")).alias("t")).first()
    assert r.s == [1, 2, 3] and r.t == "a=1,b=2"


def test_stringify(spark):
    df = spark.createDataFrame([(95.0, True, 7, b"\x01")], "d double, b boolean, i int, x binary")
    r = df.select(cv.stringify("d", "double").alias("d"), cv.stringify("b", "boolean").alias("b"),
                  cv.stringify("i", "int").alias("i"), cv.stringify("x", "blob").alias("x")).first()
    assert (r.d, r.b, r.i, r.x) == ("95.0", "true", "7", None)


def test_varint_of_any_length_and_strict_errors(spark):
    big = "123456789012345678901234567890123456789012345"
    df = spark.createDataFrame([(big, "1.5E3", "2.5e0", "-12E50")], "a string, b string, c string, d string")
    r = cv.convert_columns(df, dict.fromkeys("abcd", "varint")).first()
    assert (r.a, r.b, r.c, r.d) == (big, "1500", None, "-12" + "0" * 50)
    for bad, kind in (("2.5", "varint"), ("x", "uuid"), ("99999999999", "date")):
        one = spark.createDataFrame([(bad,)], "a string")
        assert cv.convert_columns(one, {"a": kind}).first().a is None
        with pytest.raises(Exception):
            cv.convert_columns(one, {"a": kind}, strict=True).collect()


def test_uuid_duration_varint(spark):
    df = spark.createDataFrame([("0123456789ABCDEF0123456789abcdef", 1, 2, 3, 5)], "h string, m int, d int, n bigint, k bigint")
    r = df.select(cv.uuid_text("h").alias("u"), cv.duration_text("m", "d", "n").alias("dur"),
                  cv.varint_text(F.col("k").cast("decimal(38,0)") * F.lit(10 ** 18).cast("decimal(38,0)")).alias("v")).first()
    assert r.u == "01234567-89ab-cdef-0123-456789abcdef"
    assert r.dur == "1mo2d3ns" and r.v == "5000000000000000000"


def test_date_bin_and_trunc(spark):
    from ringcast.functions.time import date_bin, trunc_ntz

    rows = [(dt.datetime(2024, 1, 1, 0, 7, 30),), (dt.datetime(1969, 12, 31, 23, 59, 59),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [r.b for r in df.select(date_bin(dt.timedelta(minutes=15), "ts").alias("b")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 0, 0), dt.datetime(1969, 12, 31, 23, 45)]
    r = df.limit(1).select(trunc_ntz("MONTH", "ts").alias("m"), trunc_ntz("HOUR", "ts").alias("h")).first()
    assert r.m == dt.datetime(2024, 1, 1) and r.h == dt.datetime(2024, 1, 1, 0, 0)


def test_stringify_containers(spark):
    df = spark.createDataFrame([([1, 2], [dt.date(2024, 1, 1)], {"a": dt.date(2024, 1, 2)}, None)],
                               "i array<int>, d array<date>, m map<string,date>, n array<int>")
    r = df.select(cv.stringify_list("i", "int").alias("i"), cv.stringify_list("d", "date").alias("d"),
                  cv.stringify_map_values("m", "date").alias("m"),
                  cv.stringify_list("n", "int").alias("n")).first()
    assert r.i == ["1", "2"] and r.d == [None] and r.m == {"a": None} and r.n is None


def test_boolean_and_decimal_text(spark):
    df = spark.createDataFrame([("true", 1.5), ("x", None)], "s string, d double")
    got = df.select(cv.to_boolean("s").alias("b"),
                    cv.decimal_text(F.col("d").cast("decimal(10,2)")).alias("t")).collect()
    assert [(r.b, r.t) for r in got] == [(True, "1.50"), (None, None)]
