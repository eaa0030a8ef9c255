"""Further forms of the inventory: scalar conversions (C6, C7, C14, C16), the
remaining parameter types (P6-P8, P12), a handle read twice (S10), and the join,
set, hash, series and approximate forms of Q8, Q10, Q12, Q15, Q26 and Q27."""

from __future__ import annotations

from pyspark.sql import functions as F

from ringcast.functions import convert as cv
from ringcast.operators.transform import transform
from ringcast.plans.catalog import _sql_pair, register
from ringcast.plans.catalog_params import _uuid_of, _write_lines
from ringcast.sources.params import read_params
from ringcast.sources.table import Tables


@register("convert_scalars", """
SELECT event_id, value AS as_double, CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS as_bool,
  '10.0.' || CAST(event_id % 256 AS VARCHAR) || '.7' AS ip,
  CAST(CAST(user_id - 20 AS DECIMAL(20,3)) AS VARCHAR) AS dec_text
FROM events""")
def q_convert_scalars(spark, d):
    eid = F.col("event_id")
    raw = Tables(spark, d).events.select(
        "event_id", F.col("value").cast("string").alias("as_double"),
        F.when(eid % 3 == 0, "true").when(eid % 3 == 1, "false").otherwise("maybe").alias("as_bool"),
        F.format_string("10.0.%d.7", eid % 256).alias("ip"),
        (F.col("user_id") - 20).cast("decimal(20,3)").alias("dec"))
    out = cv.convert_columns(raw, {"as_double": "double", "as_bool": "boolean", "ip": "inet"})
    return out.select("event_id", "as_double", "as_bool", "ip", cv.decimal_text("dec").alias("dec_text"))


@register("params_inet_uuid", """
SELECT event_id AS eid, CASE event_id % 4 WHEN 0 THEN '10.1.2.' || CAST(event_id % 256 AS VARCHAR)
    WHEN 1 THEN CASE WHEN event_id % 16 = 1 THEN '2001:db8::1:1' ELSE '2001:db8::' || lower(to_hex(event_id % 16)) || ':1' END
    WHEN 2 THEN '::ffff:192.0.2.128' ELSE '1:0:2:3::' END AS ip,
  regexp_replace(md5(CAST(event_id AS VARCHAR)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS tu,
  event_type AS kind, CAST(event_id % 1000 + 0.5 AS FLOAT) AS f
FROM events""")
def q_params_inet_uuid(spark, d):
    """Other spellings of an address bind as its canonical text; any UUID is a timeuuid."""
    eid = F.col("event_id")
    ip = (F.when(eid % 4 == 0, F.format_string("10.1.2.%d", eid % 256))
          .when(eid % 4 == 1, F.format_string("2001:0DB8:0:0:0:0:%04X:0001", eid % 16))
          .when(eid % 4 == 2, F.lit("0:0:0:0:0:FFFF:192.0.2.128")).otherwise(F.lit("1:0:2:3:0:0:0:0")))
    line = F.to_json(F.struct(eid.alias("eid"), ip.alias("ip"), _uuid_of(eid.cast("string")).alias("tu"),
                              F.col("event_type").alias("kind"), (eid % 1000 + F.lit(0.5)).alias("f")))
    path = _write_lines(Tables(spark, d).events.select(line.alias("value")), spark, "params-inet")
    markers = {"eid": "bigint", "ip": "inet", "tu": "timeuuid", "kind": "ascii", "f": "float"}
    return read_params(spark, path, markers, on_error="collect")[0].select(*markers)


@register("params_unsupported", """
SELECT event_id AS eid, 'x' AS name, 'unsupported type duration' AS reason FROM events""")
def q_params_unsupported(spark, d):
    line = F.format_string('{"eid":%d,"x":"1h"}', F.col("event_id"))
    path = _write_lines(Tables(spark, d).events.select(line.alias("value")), spark, "params-unsupported")
    errors = read_params(spark, path, {"eid": "bigint", "x": "duration"}, on_error="collect")[1]
    return errors.select(F.get_json_object("text", "$.eid").cast("bigint").alias("eid"), "name", "reason")


@register("source_handle", """
SELECT o_orderstatus AS status, COUNT(*) AS cnt, MAX(o_totalprice) AS top FROM orders GROUP BY 1
UNION ALL SELECT 'all', COUNT(*), MAX(o_totalprice) FROM orders""")
def q_source_handle(spark, d):
    """One handle (S10) read by two transforms."""
    handle = Tables(spark, d).orders
    per = transform(spark, handle, "SELECT o_orderstatus AS status, COUNT(*) AS cnt, MAX(o_totalprice) AS top "
                                   "FROM source GROUP BY o_orderstatus")
    total = transform(spark, handle, "SELECT 'all' AS status, COUNT(*) AS cnt, MAX(o_totalprice) AS top FROM source")
    return per.unionAll(total)


_sql_pair("sql_hash", "customer", """
SELECT c_custkey, md5(c_name) AS m, sha2(c_name, 256) AS s, base64(CAST(c_name AS BINARY)) AS b, hex(c_name) AS h
FROM source""", """
SELECT c_custkey, md5(c_name) AS m, sha256(c_name) AS s, base64(encode(c_name)) AS b, hex(c_name) AS h
FROM customer""")
_sql_pair("sql_left_join", "customer", """
SELECT c_custkey, o_orderkey FROM source LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F'""",
          extra_tables=("orders",))
_sql_pair("sql_right_join", "orders", """
SELECT o_orderkey, c_custkey FROM source RIGHT JOIN customer ON o_custkey = c_custkey AND o_totalprice > 400000""",
          extra_tables=("customer",))
_sql_pair("sql_except_all", "orders", """
SELECT o_custkey AS k FROM source EXCEPT ALL SELECT o_custkey FROM source WHERE o_orderstatus = 'F'""")
_sql_pair("sql_intersect_all", "orders", """
SELECT o_custkey AS k FROM source WHERE o_orderstatus = 'O'
INTERSECT ALL SELECT o_custkey FROM source WHERE o_orderstatus = 'F'""")
_sql_pair("sql_series", "nation", """
SELECT n_nationkey, k FROM source LATERAL VIEW explode(sequence(1, CAST(n_nationkey AS INT) + 1)) v AS k""", """
SELECT n_nationkey, CAST(unnest(range(1, n_nationkey + 2)) AS INTEGER) AS k FROM nation""")
# Estimates within five standard errors (5 %) of the exact figure. Each figure is
# grouped by itself: beside a COUNT(DISTINCT) Spark keeps one sketch (13 KB) per
# group and distinct key.
_sql_pair("sql_approx_bound", "lineitem", """
SELECT e.l_returnflag, ABS(a.estimate - e.exact) <= 0.05 * e.exact AS within_bound
FROM (SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS exact FROM source GROUP BY l_returnflag) e
JOIN (SELECT l_returnflag, approx_count_distinct(l_orderkey, 0.01) AS estimate FROM source GROUP BY l_returnflag) a
  ON e.l_returnflag <=> a.l_returnflag""", "SELECT DISTINCT l_returnflag, true AS within_bound FROM lineitem")
