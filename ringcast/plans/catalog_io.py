"""Round-trip queries: write with the sinks, read the files back (W1-W11,
O1, O4), the token layout, the streaming export and the generator."""

from __future__ import annotations

from pyspark.sql import functions as F

from ringcast.functions.tokens import range_bound
from ringcast.operators import fanout as fo
from ringcast.operators import ring
from ringcast.plans.catalog import SPLITS, register, split_sql, tok_sql
from ringcast.plans.export import export, split_metrics
from ringcast.plans.generate import bench_events
from ringcast.session import scratch_path
from ringcast.sinks.writer import count_data_files, read_back, write
from ringcast.sources.table import Tables
from ringcast.streaming.incremental import incremental_export, stream_source


def _rt(df, spark, label, ext, **kw):
    """Write ``df`` and return it read back with its own schema."""
    path = scratch_path(spark, label) + ext
    write(df, path, **kw)
    back = read_back(spark, path, fmt=kw.get("fmt"), schema=df.schema)
    return back.select(*df.columns), path


@register("write_parquet", "SELECT * FROM lineitem")
def q_write_parquet(spark, d):
    return _rt(Tables(spark, d).lineitem, spark, "w-parquet", ".parquet")[0]


@register("write_csv", "SELECT * FROM documents")
def q_write_csv(spark, d):
    return _rt(Tables(spark, d).documents, spark, "w-csv", ".csv")[0]


@register("write_ndjson", "SELECT * FROM orders")
def q_write_ndjson(spark, d):
    return _rt(Tables(spark, d).orders, spark, "w-ndjson", ".ndjson")[0]


@register("write_ndjson_nulls", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal FROM customer""")
def q_write_ndjson_nulls(spark, d):
    c = Tables(spark, d).customer.select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"))
    return _rt(c, spark, "w-ndjson-nulls", ".jsonl")[0]


@register("write_single_file", "SELECT *, 1 AS files FROM lineitem")
def q_write_single_file(spark, d):
    back, path = _rt(Tables(spark, d).lineitem, spark, "w-single", ".parquet", single_file=True)
    return back.withColumn("files", F.lit(count_data_files(spark, path)))


@register("write_single_csv", "SELECT *, 1 AS files FROM conversations")
def q_write_single_csv(spark, d):
    back, path = _rt(Tables(spark, d).conversations, spark, "w-single-csv", ".csv", single_file=True)
    return back.withColumn("files", F.lit(count_data_files(spark, path)))


@register("write_hive", "SELECT * FROM events")
def q_write_hive(spark, d):
    return _rt(Tables(spark, d).events, spark, "w-hive", "", partition_by="event_type")[0]


@register("write_hive_two", "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders")
def q_write_hive_two(spark, d):
    o = Tables(spark, d).orders.withColumn("o_year", F.year("o_orderdate"))
    return _rt(o, spark, "w-hive2", "", partition_by=["o_orderstatus", "o_year"])[0]


EXPORT_SQL = """
SELECT user_id, event_type, COUNT(*) AS cnt, CAST(ROUND(TRY_CAST(CAST(SUM(value) AS STRING) AS DECIMAL(38,18)), 4) AS DOUBLE) AS total
FROM source GROUP BY user_id, event_type"""


@register("export_transform", """
SELECT user_id, event_type, COUNT(*) AS cnt, CAST(ROUND(TRY_CAST(CAST(SUM(value) AS STRING) AS DECIMAL(38,18)), 4) AS DOUBLE) AS total
FROM events WHERE user_id IN (7, 8, 9, 10) GROUP BY user_id, event_type""")
def q_export_transform(spark, d):
    ev = Tables(spark, d).events
    params = spark.createDataFrame([(7,), (8,), (9,), (10,)], "user_id bigint")
    rows = fo.fanout(ev, params, on="user_id")
    path = scratch_path(spark, "export") + ".ndjson"
    export(spark, rows, path, transform=EXPORT_SQL)
    schema = "user_id bigint, event_type string, cnt bigint, total double"
    return read_back(spark, path, schema=schema)


@register("export_metrics", f"""
WITH t AS (SELECT {split_sql(tok_sql('l_orderkey * 8 + l_linenumber'))} AS split_id FROM lineitem),
c AS (SELECT split_id, COUNT(*) AS rows FROM t GROUP BY split_id)
SELECT CAST(r.range AS INTEGER) AS split_id, COALESCE(c.rows, 0) AS rows,
       (SELECT COUNT(*) FROM lineitem) AS written_rows
FROM range({SPLITS}) r LEFT JOIN c ON c.split_id = r.range""")
def q_export_metrics(spark, d):
    li = Tables(spark, d).lineitem.withColumn("pk", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    scanned = ring.token_scan(li, "pk", SPLITS, token_method="multiplicative", keep_token=False)
    result = export(spark, scanned, scratch_path(spark, "metrics") + ".parquet")
    written = read_back(spark, result.path)
    return (split_metrics(written, SPLITS)
            .withColumn("written_rows", F.lit(result.rows).cast("bigint")))


_RANGE5 = range_bound(SPLITS, 5)


@register("token_layout_range", f"""
SELECT o_orderkey, o_totalprice, {tok_sql('o_orderkey')} AS token FROM orders
WHERE {tok_sql('o_orderkey')} >= {_RANGE5[1]} AND {tok_sql('o_orderkey')} < {_RANGE5[2]}""")
def q_token_layout_range(spark, d):
    path = scratch_path(spark, "layout")
    ring.write_token_layout(Tables(spark, d).orders, "o_orderkey", path, num_files=8,
                            token_method="multiplicative")
    laid_out = spark.read.parquet(path)
    return ring.scan_split(laid_out, "token", SPLITS, 5, token_method="column",
                           columns=["o_orderkey", "o_totalprice"])


@register("stream_export", "SELECT event_id, ts, user_id, event_type, value FROM events WHERE value >= 0")
def q_stream_export(spark, d):
    ev_path = f"{d.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(ev_path).schema
    src = stream_source(spark, d, schema, file_pattern="events.parquet")
    out = scratch_path(spark, "stream") + ".parquet"
    incremental_export(spark, src, out, checkpoint=scratch_path(spark, "stream-ckpt"),
                       transform="SELECT event_id, ts, user_id, event_type, value FROM source "
                                 "WHERE value >= 0")
    return spark.read.parquet(out)


@register("generate_events", """
SELECT 'rows' AS check_name, COUNT(*) AS value FROM lineitem
UNION ALL SELECT 'device_event_violations', CAST(0 AS BIGINT)
UNION ALL SELECT 'event_active_violations', CAST(0 AS BIGINT)
UNION ALL SELECT 'user_count_violations', CAST(0 AS BIGINT)""")
def q_generate_events(spark, d):
    """G1 seeded by lineitem keys: one event per row, and the dependencies of the
    benchmark data hold (device → event → active, user → count)."""
    gen = bench_events(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])
    out = gen.agg(F.lit("rows").alias("check_name"), F.count(F.lit(1)).alias("value"))
    for key, dep, name in [("device_id", "event", "device_event_violations"),
                           ("event", "active", "event_active_violations"),
                           ("user_id", "count", "user_count_violations")]:
        bad = (gen.groupBy(key).agg(F.count_distinct(dep).alias("n"))
               .agg(F.lit(name).alias("check_name"), F.count_if(F.col("n") > 1).alias("value")))
        out = out.unionByName(bad)
    return out


@register("write_csv_pages", "SELECT * FROM pages")
def q_write_csv_pages(spark, d):
    """Raw HTML (quotes, commas, line breaks) through one CSV file."""
    return _rt(Tables(spark, d).pages, spark, "w-pages", ".csv", single_file=True)[0]


@register("write_ndjson_conversations", "SELECT * FROM conversations")
def q_write_ndjson_conversations(spark, d):
    return _rt(Tables(spark, d).conversations, spark, "w-conv", "", fmt="ndjson",
               partition_by="role")[0]


@register("write_parquet_embeddings", "SELECT * FROM embeddings")
def q_write_parquet_embeddings(spark, d):
    return _rt(Tables(spark, d).embeddings, spark, "w-emb", ".parquet", partition_by="label")[0]


@register("write_ndjson_embeddings", "SELECT * FROM embeddings")
def q_write_ndjson_embeddings(spark, d):
    return _rt(Tables(spark, d).embeddings, spark, "w-emb-json", ".jsonl")[0]


@register("write_csv_labels_hive", "SELECT * FROM labels")
def q_write_csv_labels_hive(spark, d):
    return _rt(Tables(spark, d).labels, spark, "w-labels", "", fmt="csv",
               partition_by=["quality", "toxic"])[0]
