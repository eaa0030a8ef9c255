"""Parameter-file and type-conversion queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringcast.functions import convert as cv
from ringcast.plans.catalog import register
from ringcast.session import scratch_path
from ringcast.sources.params import read_params
from ringcast.sources.table import Tables


def _write_lines(lines: DataFrame, spark: SparkSession, label: str) -> str:
    """Write one text line per row (part files, in parallel) to a fresh folder."""
    path = scratch_path(spark, label)
    lines.write.text(path)
    return path


def _uuid_of(text_col) -> F.Column:
    return F.regexp_replace(F.md5(text_col), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


VALID_MARKERS = {"uid": "bigint", "kind": "text", "v": "double", "t": "timestamp", "u": "uuid",
                 "b": "blob", "d": "date", "ok": "boolean", "small": "tinyint", "ns": "time"}


@register("params_valid", """
SELECT user_id AS uid, event_type AS kind, value AS v, date_trunc('millisecond', ts) AS t,
  regexp_replace(md5(CAST(event_id AS VARCHAR)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS u,
  upper(md5(CAST(event_id AS VARCHAR))) AS b_hex,
  CAST(DATE '1970-01-01' + CAST(event_id - 5000 AS INTEGER) AS DATE) AS d,
  event_id % 2 = 0 AS ok, CAST(event_id % 100 AS TINYINT) AS small,
  (epoch_us(ts) - epoch_us(date_trunc('day', ts))) * 1000 AS ns
FROM events""")
def q_params_valid(spark, d):
    ev = Tables(spark, d).events
    ts_text = F.concat(F.regexp_replace(ev.ts.cast("string"), " ", "T"), F.lit("Z"))
    obj = F.to_json(F.struct(
        F.col("user_id").alias("uid"), F.col("event_type").alias("kind"), F.col("value").alias("v"),
        ts_text.alias("t"), F.upper(_uuid_of(F.col("event_id").cast("string"))).alias("u"),
        F.md5(F.col("event_id").cast("string")).alias("b"),
        (F.lit(2 ** 31) + F.col("event_id") - 5000).alias("d"),
        (F.col("event_id") % 2 == 0).alias("ok"), (F.col("event_id") % 100).alias("small"),
        cv.time_ns_of_day("ts").alias("ns")))
    path = _write_lines(ev.select(obj.alias("value")), spark, "params-valid")
    params = read_params(spark, path, VALID_MARKERS, on_error="collect")[0]
    return params.select(
        "uid", "kind", "v", cv.timestamp_ntz_from_millis(F.unix_millis("t")).alias("t"), "u",
        cv.blob_to_hex("b").alias("b_hex"), "d", "ok", "small", "ns")


ERROR_MARKERS = {"eid": "bigint", "uid": "bigint", "kind": "text", "small": "tinyint"}
# Fault made for each remainder of event_id by 10 (every row is
# written; remainder 0 is a valid set, 9 a blank line).
FAULTS = {
    1: ("uid", "expected integer"),
    2: ("zone", "unknown key"),
    3: ("uid", "null value"),
    4: ("uid", "expected integer"),
    5: (None, "not a JSON object"),
    6: (None, "invalid JSON"),
    7: ("kind", "missing key"),
    8: ("small", "out of range for tinyint"),
}


def _faults_oracle() -> str:
    names = " ".join(f"WHEN {k} THEN {('NULL' if n is None else repr(n))}" for k, (n, _) in FAULTS.items())
    reasons = " ".join(f"WHEN {k} THEN '{r}'" for k, (_, r) in FAULTS.items())
    return (f"SELECT event_id AS eid, CASE event_id % 10 {names} END AS name, "
            f"CASE event_id % 10 {reasons} END AS reason FROM events WHERE event_id % 10 BETWEEN 1 AND 8")


@register("params_errors", _faults_oracle())
def q_params_errors(spark, d):
    ev = Tables(spark, d).events
    eid, uid, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    small = eid % 100

    def obj(**kv):
        return F.to_json(F.struct(*[v.alias(k) for k, v in kv.items()]))

    case = eid % 10
    line = (F.when(case == 1, obj(eid=eid, uid=uid.cast("string"), kind=kind, small=small))
            .when(case == 2, obj(eid=eid, uid=uid, kind=kind, small=small, zone=F.lit("x")))
            .when(case == 3, F.format_string('{"eid":%d,"uid":null,"kind":"%s","small":%d}', eid, kind, small))
            .when(case == 4, obj(eid=eid, uid=uid + F.lit(0.5), kind=kind, small=small))
            .when(case == 5, F.format_string("[%d]", eid))
            .when(case == 6, F.format_string("bad #%d", eid))
            .when(case == 7, obj(eid=eid, uid=uid, small=small))
            .when(case == 8, obj(eid=eid, uid=uid, kind=kind, small=F.lit(300)))
            .when(case == 9, F.lit(""))
            .otherwise(obj(eid=eid, uid=uid, kind=kind, small=small)))
    path = _write_lines(ev.select(line.alias("value")), spark, "params-errors")
    params, errors = read_params(spark, path, ERROR_MARKERS, on_error="collect")
    # Identify each faulty line by the event it was made from.
    text_id = F.coalesce(F.get_json_object("text", "$.eid"), F.get_json_object("text", "$[0]"),
                         F.regexp_extract("text", r"#(\d+)", 1)).cast("bigint")
    return errors.select(text_id.alias("eid"), "name", "reason")


# ---------------------------------------------------------------- conversions
@register("convert_date_raw", """
SELECT o_orderkey, o_orderkey + 2147483648 - 7500 AS raw,
       CAST(DATE '1970-01-01' + CAST(o_orderkey - 7500 AS INTEGER) AS DATE) AS d FROM orders""")
def q_convert_date_raw(spark, d):
    o = Tables(spark, d).orders
    raw = F.col("o_orderkey") + F.lit(2 ** 31) - 7500
    return o.select("o_orderkey", raw.alias("raw"), cv.date_from_raw(raw).alias("d"))


@register("convert_timestamp_ms", """
SELECT event_id, date_trunc('millisecond', ts) AS t_ms, epoch_us(ts) // 1000 AS ms FROM events""")
def q_convert_timestamp_ms(spark, d):
    ev = Tables(spark, d).events
    micros = cv.epoch_micros_ntz("ts")
    ms = F.call_function("div", micros, F.lit(1000))
    return ev.select("event_id", cv.floor_millis_ntz("ts").alias("t_ms"), ms.alias("ms"))


@register("convert_time_ns", """
SELECT event_id, (epoch_us(ts) - epoch_us(date_trunc('day', ts))) * 1000 AS ns,
  strftime(ts, '%H:%M:%S') || '.' || lpad(CAST((epoch_us(ts) % 1000000) * 1000 AS VARCHAR), 9, '0') AS txt
FROM events""")
def q_convert_time_ns(spark, d):
    ev = Tables(spark, d).events
    ns = cv.time_ns_of_day("ts")
    return ev.select("event_id", ns.alias("ns"), cv.format_time_ns(ns).alias("txt"))


@register("convert_duration", """
SELECT o_orderkey, CAST(o_orderkey % 12 AS VARCHAR) || 'mo' || CAST(o_custkey % 31 AS VARCHAR) || 'd'
  || CAST(o_orderkey * 1000003 AS VARCHAR) || 'ns' AS duration FROM orders""")
def q_convert_duration(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", cv.duration_text(F.col("o_orderkey") % 12, F.col("o_custkey") % 31,
                                                   F.col("o_orderkey") * 1000003).alias("duration"))


@register("convert_uuid", """
SELECT c_custkey,
  regexp_replace(md5(c_name), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS u,
  regexp_replace(md5(c_name), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS u_bin
FROM customer""")
def q_convert_uuid(spark, d):
    c = Tables(spark, d).customer
    return c.select("c_custkey", cv.uuid_text(F.upper(F.md5("c_name"))).alias("u"),
                    cv.uuid_from_binary(F.unhex(F.md5("c_name"))).alias("u_bin"))


@register("convert_blob_hex", """
SELECT c_custkey, upper(md5(c_name)) AS hex_text, CASE WHEN c_name IS NULL THEN NULL ELSE 16 END AS n_bytes
FROM customer""")
def q_convert_blob_hex(spark, d):
    c = Tables(spark, d).customer
    blob = cv.hex_to_blob(F.md5("c_name"))
    return c.select("c_custkey", cv.blob_to_hex(blob).alias("hex_text"),
                    F.octet_length(blob).alias("n_bytes"))


@register("convert_varint", """
SELECT o_orderkey, CAST(o_orderkey::HUGEINT * 1000000000000000000 AS VARCHAR) AS big FROM orders""")
def q_convert_varint(spark, d):
    o = Tables(spark, d).orders
    big = F.col("o_orderkey").cast("decimal(38,0)") * F.lit(10 ** 18).cast("decimal(38,0)")
    return o.select("o_orderkey", cv.varint_text(big).alias("big"))


@register("convert_narrow", """
SELECT o_orderkey, TRY_CAST(o_orderkey - 100 AS TINYINT) AS t8,
  TRY_CAST(o_orderkey * 10 - 30000 AS SMALLINT) AS t16, TRY_CAST(o_orderkey * 200000 AS INTEGER) AS t32,
  TRY_CAST(o_orderkey AS BIGINT) AS t64 FROM orders""")
def q_convert_narrow(spark, d):
    o = Tables(spark, d).orders
    k = F.col("o_orderkey")
    return o.select("o_orderkey", cv.to_tinyint(k - 100).alias("t8"),
                    cv.to_smallint(k * 10 - 30000).alias("t16"),
                    cv.to_int(k * 200000).alias("t32"), cv.to_bigint(k).alias("t64"))


@register("convert_list", """
SELECT doc_id,
  array_to_string(list_transform([lang, 'x', CAST(n_chars AS VARCHAR)],
      lambda x: coalesce(CAST(TRY_CAST(x AS INTEGER) AS VARCHAR), 'null')), ',') AS ints,
  array_to_string([lang, source], '|') AS texts
FROM documents""")
def q_convert_list(spark, d):
    doc = Tables(spark, d).documents
    raw = F.array(F.col("lang"), F.lit("x"), F.col("n_chars").cast("string"))
    ints = cv.list_of(raw, "int")
    return doc.select("doc_id", F.array_join(ints, ",", "null").alias("ints"),
                      F.array_join(cv.list_of(F.array("lang", "source"), "string"), "|").alias("texts"))


@register("convert_set", """
SELECT vec_id, array_to_string(list_sort(list_distinct(list_transform(embedding,
    lambda x: CAST(floor(CAST(x AS DOUBLE) * 4) AS INTEGER)))), ',') AS buckets
FROM embeddings""")
def q_convert_set(spark, d):
    e = Tables(spark, d).embeddings
    buckets = F.transform("embedding", lambda x: F.floor(x.cast("double") * 4).cast("int"))
    return e.select("vec_id", cv.list_to_text(cv.set_of(buckets)).alias("buckets"))


@register("convert_map", """
SELECT event_id, CASE WHEN json_extract_string(props, '$.k') IS NULL THEN 'type=' || event_type
  ELSE 'k=' || json_extract_string(props, '$.k') || ',type=' || event_type END AS entries
FROM events""")
def q_convert_map(spark, d):
    ev = Tables(spark, d).events
    # the map of the text props' "k" and the event type, as text
    k = F.get_json_object("props", "$.k")
    m = F.map_filter(F.create_map(F.lit("k"), k, F.lit("type"), F.col("event_type")),
                     lambda key, v: v.isNotNull())
    return ev.select("event_id", cv.map_to_text(cv.map_text_text(m)).alias("entries"))


@register("stringify_mixed", """
SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS s_int, CAST(c_acctbal AS VARCHAR) AS s_double,
  CAST(c_acctbal > 0 AS VARCHAR) AS s_bool, c_mktsegment AS s_text, CAST(NULL AS VARCHAR) AS s_blob
FROM customer""")
def q_stringify_mixed(spark, d):
    c = Tables(spark, d).customer
    return c.select("c_custkey", cv.stringify("c_nationkey", "int").alias("s_int"),
                    cv.stringify("c_acctbal", "double").alias("s_double"),
                    cv.stringify(F.col("c_acctbal") > 0, "boolean").alias("s_bool"),
                    cv.stringify("c_mktsegment", "text").alias("s_text"),
                    cv.stringify(F.unhex(F.md5("c_name")), "blob").alias("s_blob"))


@register("convert_columns", """
SELECT TRY_CAST(c_custkey AS INTEGER) AS c_custkey, c_name, TRY_CAST(c_nationkey AS TINYINT) AS c_nationkey,
  TRY_CAST(c_acctbal AS FLOAT) AS c_acctbal, c_mktsegment FROM customer""")
def q_convert_columns(spark, d):
    c = Tables(spark, d).customer
    return cv.convert_columns(c, {"c_custkey": "int", "c_name": "text", "c_nationkey": "tinyint",
                                  "c_acctbal": "float"})


@register("query_params_file", """
SELECT o.o_orderkey, o.o_totalprice FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment = 'MACHINERY'""")
def q_query_params_file(spark, d):
    """The ``query`` command: a parameter file (written here from customer) and a
    query text with a marker, typed by the query and run once per line."""
    from ringcast.operators.fanout import infer_markers, query_fanout

    t = Tables(spark, d)
    keys = t.customer.filter(F.col("c_mktsegment") == "MACHINERY")
    path = _write_lines(keys.select(F.to_json(F.struct(F.col("c_custkey").alias("custkey"))).alias("value")),
                        spark, "params-query")
    text = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = :custkey"
    params = read_params(spark, path, infer_markers(spark, text, {"orders": t.orders}))
    return query_fanout(spark, text, params, tables={"orders": t.orders})
