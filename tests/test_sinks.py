import os

import pytest
from pyspark.sql import functions as F

from ringcast.plans.export import export, token_range_export
from ringcast.sinks.writer import (SinkError, check_target, count_data_files, output_format,
                                   read_back, write)
from ringcast.sources.table import Tables

from conftest import SF_SMALL


@pytest.mark.parametrize("path,fmt,expected", [
    ("out.parquet", None, "parquet"), ("out.csv", "parquet", "csv"), ("out.ndjson", None, "ndjson"),
    ("out.jsonl", None, "ndjson"), ("out.json", None, "ndjson"), ("out/", None, "parquet"),
    ("dir/out", "csv", "csv"), ("out.csv/", None, "csv"), ("v1.2", "ndjson", "ndjson"),
])
def test_output_format(path, fmt, expected):
    assert output_format(path, fmt) == expected


@pytest.mark.parametrize("path", ["out.txt", "s3://my.bucket", "/out/v1.2", "out.CSV"])
def test_unknown_extension_without_format(path):
    with pytest.raises(SinkError):
        output_format(path)


@pytest.mark.parametrize("path,ok", [
    ("/tmp/x", True), ("file:///tmp/x", True), ("s3://bucket/prefix", True), ("s3a://b/p", True),
    ("hdfs://nn/p", True), ("http://host/p", False), ("ftp://host/p", False), ("s3:///p", False),
])
def test_targets(path, ok):
    if ok:
        assert check_target(path) == path
    else:
        with pytest.raises(SinkError):
            check_target(path)


def test_single_file_conflicts_with_partitions(spark, tmp_out):
    df = spark.range(3)
    with pytest.raises(SinkError):
        write(df.withColumn("k", F.lit(1)), tmp_out + "/x.parquet", single_file=True, partition_by="k")
    with pytest.raises(SinkError):
        write(df, tmp_out + "/y", partition_by="id")


@pytest.mark.parametrize("ext", [".parquet", ".csv", ".ndjson"])
@pytest.mark.parametrize("layout", ["parts", "single", "hive"])
def test_round_trip(spark, tmp_out, ext, layout):
    orders = Tables(spark, SF_SMALL).orders
    path = tmp_out + "/o" + (ext if layout != "hive" else "")
    kw = {"parts": {}, "single": {"single_file": True}, "hive": {"partition_by": "o_orderstatus"}}[layout]
    fmt = ext.lstrip(".") if layout == "hive" else None
    write(orders, path, fmt=fmt, **kw)
    back = read_back(spark, path, fmt=fmt, schema=orders.schema).select(*orders.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, orders.collect()))
    if layout == "single":
        assert os.path.isfile(path) and count_data_files(spark, path) == 1


def test_single_file_modes(spark, tmp_out):
    df = spark.range(5)
    path = tmp_out + "/one.parquet"
    write(df, path, single_file=True)
    with pytest.raises(SinkError):
        write(df, path, single_file=True)
    write(spark.range(7), path, single_file=True, mode="overwrite")
    assert spark.read.parquet(path).count() == 7
    write(spark.range(9), path, single_file=True, mode="ignore")
    assert spark.read.parquet(path).count() == 7
    empty = tmp_out + "/empty.parquet"
    write(spark.range(0), empty, single_file=True)
    assert os.path.isfile(empty)


def test_csv_keeps_quotes_newlines_spaces_and_nested(spark, tmp_out):
    rows = [(1, ' a "quoted", text \n next line ', [1, 2]), (2, None, None)]
    df = spark.createDataFrame(rows, "id int, t string, arr array<int>")
    path = tmp_out + "/x.csv"
    write(df, path)
    back = read_back(spark, path, schema="id int, t string, arr string").orderBy("id").collect()
    assert back[0].t == rows[0][1] and back[0].arr == "[1,2]"
    assert back[1].t is None


def test_ndjson_nulls_omitted_or_kept(spark, tmp_out):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    write(df, tmp_out + "/a.ndjson")
    write(df, tmp_out + "/b.ndjson", keep_nulls=True)
    text_a = spark.read.text(tmp_out + "/a.ndjson").first().value
    text_b = spark.read.text(tmp_out + "/b.ndjson").first().value
    assert text_a == '{"a":1}' and text_b == '{"a":1,"b":null}'


def test_export_observes_rows(spark, tmp_out):
    li = Tables(spark, SF_SMALL).lineitem
    result = token_range_export(spark, li, ["l_orderkey", "l_linenumber"], tmp_out + "/l.parquet",
                                splits=64, single_file=True)
    assert result.rows == li.count() and result.format == "parquet"
    again = export(spark, li, tmp_out + "/g.ndjson",
                   transform="SELECT l_returnflag, COUNT(*) AS n FROM source GROUP BY l_returnflag")
    assert again.rows == li.select("l_returnflag").distinct().count()


def test_query_export_with_and_without_params(spark, tmp_out):
    orders = Tables(spark, SF_SMALL).orders
    from ringcast.plans.export import query_export

    with open(tmp_out + "/p.ndjson", "w") as f:
        f.write('{"st":"F"}\n\n{"st":"O"}\n{"st":"F"}\n')
    text = "SELECT o_orderkey FROM orders WHERE o_orderstatus = :st"
    res = query_export(spark, text, tmp_out + "/a.parquet", params_path=tmp_out + "/p.ndjson",
                       markers={"st": "text"}, tables={"orders": orders})
    n_f = orders.filter("o_orderstatus = 'F'").count()
    assert res.rows == 2 * n_f + orders.filter("o_orderstatus = 'O'").count()
    once = query_export(spark, "SELECT COUNT(*) AS n FROM orders", tmp_out + "/b.ndjson",
                        tables={"orders": orders})
    assert once.rows == 1


def test_on_complete_fires_only_on_success(spark, tmp_out):
    seen = []
    df = spark.range(4)
    export(spark, df, tmp_out + "/ok.parquet", on_complete=seen.append)
    assert len(seen) == 1 and seen[0].rows == 4
    with pytest.raises(Exception):
        export(spark, df, tmp_out + "/ok.parquet", single_file=True, on_complete=seen.append)
    assert len(seen) == 1


def test_hive_null_and_empty_values(spark, tmp_out):
    df = spark.createDataFrame([(1, "a"), (2, None), (4, "a")], "id int, k string")
    write(df, tmp_out + "/h", fmt="parquet", partition_by="k")
    back = read_back(spark, tmp_out + "/h", fmt="parquet", schema=df.schema)
    got = sorted((r.id, r.k) for r in back.collect())
    assert got == [(1, "a"), (2, None), (4, "a")]
    # Spark would write '' as null: refused
    with pytest.raises(Exception, match="empty value"):
        write(df.union(spark.createDataFrame([(3, "")], df.schema)), tmp_out + "/e", fmt="parquet", partition_by="k")


def test_single_file_keeps_order(spark, tmp_out):
    df = spark.range(5000).repartition(7).selectExpr("id", "id * 7919 % 5000 AS k").orderBy("k")
    path = write(df, tmp_out + "/o.csv", single_file=True)
    with open(path) as f:
        ks = [int(x.split(",")[1]) for x in f.read().split()[1:]]
    assert ks == sorted(ks) and len(ks) == 5000


@pytest.mark.parametrize("ext", [".parquet", ".csv", ".ndjson"])
def test_single_file_empty_result(spark, tmp_out, ext):
    path = tmp_out + "/empty" + ext
    write(spark.range(0), path, single_file=True)
    assert os.path.isfile(path)
    assert read_back(spark, path, schema="id bigint").count() == 0


def test_max_records_per_file(spark, tmp_out):
    orders = Tables(spark, SF_SMALL).orders.coalesce(1)
    write(orders, tmp_out + "/m.parquet", max_records_per_file=100)
    assert count_data_files(spark, tmp_out + "/m.parquet") >= orders.count() // 100
