"""Named queries over the test tables, each with a DuckDB oracle.

Every query reads whole tables (or data Spark derives from them). Queries
that write ("round trips") write into a fresh folder under the shared
checkpoint folder and return a DataFrame that reads the written files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringcast.functions.tokens import MULTIPLICATIVE_TOKEN_FACTOR, range_bounds, ring_step
from ringcast.operators import fanout as fo
from ringcast.operators import ring
from ringcast.operators.transform import transform
from ringcast.sources.table import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

SPLITS = 16
STEP16 = ring_step(SPLITS)


def round_text(col, digits: int):
    """ROUND of a double's decimal text, as the SQL texts here do: both engines
    then round the same decimal number (rounding the binary value differs
    between engines at exact halves such as 69.195)."""
    return F.round(col.cast("string").try_cast("decimal(38,18)"), digits).cast("double")


def register(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


# ---------------------------------------------------------------- oracle helpers
def tok_sql(expr: str) -> str:
    """DuckDB form of the multiplicative token of an integral expression."""
    m = "'18446744073709551616'::HUGEINT"
    prod = f"(({expr})::HUGEINT * {MULTIPLICATIVE_TOKEN_FACTOR}::HUGEINT)"
    return f"CAST((({prod} % {m}) + {m}) % {m} - '9223372036854775808'::HUGEINT AS BIGINT)"


def split_sql(token: str, splits: int = SPLITS) -> str:
    step = ring_step(splits)
    return (f"CAST(LEAST({splits - 1}, (({token})::HUGEINT + '9223372036854775808'::HUGEINT) "
            f"// {step}::HUGEINT) AS INTEGER)")


ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


# ---------------------------------------------------------------- ring
@register("token_full_scan", f"""
SELECT {ORDERS_COLS}, {tok_sql('o_orderkey')} AS token, {split_sql(tok_sql('o_orderkey'))} AS split_id
FROM orders""")
def q_token_full_scan(spark, d):
    scanned = ring.token_scan(Tables(spark, d).orders, "o_orderkey", SPLITS,
                              token_method="multiplicative")
    return scanned.filter(F.col("split_id").between(0, SPLITS - 1))


@register("token_split_counts", f"""
SELECT {split_sql(tok_sql('o_orderkey'))} AS split_id, COUNT(*) AS rows
FROM orders GROUP BY 1""")
def q_token_split_counts(spark, d):
    return ring.split_counts(Tables(spark, d).orders, "o_orderkey", SPLITS,
                             token_method="multiplicative")


@register("token_split_bounds", f"""
WITH b AS (
  SELECT CAST(range AS INTEGER) AS split_id,
         CAST(range::HUGEINT * {STEP16}::HUGEINT - '9223372036854775808'::HUGEINT AS BIGINT) AS token_start,
         CASE WHEN range = {SPLITS - 1} THEN 9223372036854775807
              ELSE CAST((range + 1)::HUGEINT * {STEP16}::HUGEINT - '9223372036854775808'::HUGEINT AS BIGINT) END
           AS token_end
  FROM range({SPLITS})),
c AS (SELECT {split_sql(tok_sql('o_orderkey'))} AS split_id, COUNT(*) AS rows FROM orders GROUP BY 1)
SELECT b.split_id, b.token_start, b.token_end, COALESCE(c.rows, 0) AS rows
FROM b LEFT JOIN c ON b.split_id = c.split_id""")
def q_token_split_bounds(spark, d):
    return ring.split_counts(Tables(spark, d).orders, "o_orderkey", SPLITS,
                             token_method="multiplicative", include_empty=True)


_ONE = range_bounds(SPLITS)[5]


@register("token_one_range", f"""
SELECT {ORDERS_COLS}, {tok_sql('o_orderkey')} AS token FROM orders
WHERE {tok_sql('o_orderkey')} >= {_ONE[1]} AND {tok_sql('o_orderkey')} < {_ONE[2]}""")
def q_token_one_range(spark, d):
    return ring.scan_split(Tables(spark, d).orders, "o_orderkey", SPLITS, 5,
                           token_method="multiplicative")


@register("token_composite", f"""
WITH t AS (SELECT {tok_sql('l_orderkey * 8 + l_linenumber')} AS token FROM lineitem)
SELECT {split_sql('token')} AS split_id, COUNT(*) AS rows, MIN(token) AS min_token, MAX(token) AS max_token
FROM t GROUP BY 1""")
def q_token_composite(spark, d):
    li = Tables(spark, d).lineitem
    packed = li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pk"))
    return ring.split_stats(packed, "pk", SPLITS, token_method="multiplicative")


@register("split_row_total", "SELECT COUNT(*) AS split_rows, COUNT(*) AS table_rows FROM lineitem")
def q_split_row_total(spark, d):
    # Composite key, real ring hash, reference-sized split count (2400).
    scanned = ring.token_scan(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"], 2400,
                              columns=[])
    return scanned.agg(F.count_if(F.col("split_id").between(0, 2399)).alias("split_rows"),
                       F.count(F.lit(1)).alias("table_rows"))


# ---------------------------------------------------------------- projections
@register("select_columns", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def q_select_columns(spark, d):
    return ring.token_scan(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"], 2400,
                           columns=["l_orderkey", "l_linenumber", "l_extendedprice"],
                           keep_token=False).drop("split_id")


@register("count_only", "SELECT COUNT(*) AS cnt FROM lineitem")
def q_count_only(spark, d):
    return Tables(spark, d).lineitem.agg(F.count(F.lit(1)).alias("cnt"))


# ---------------------------------------------------------------- queries
@register("query_plain",
          "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def q_query_plain(spark, d):
    return fo.run_query(spark, "SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
                               "WHERE o_totalprice > 300000", tables={"orders": Tables(spark, d).orders})


@register("query_one_param", "SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY'")
def q_query_one_param(spark, d):
    return fo.run_query(spark, "SELECT * FROM customer WHERE c_mktsegment = :seg",
                        args={"seg": "MACHINERY"}, tables={"customer": Tables(spark, d).customer})


@register("query_positional", "SELECT * FROM customer WHERE c_nationkey = 7 AND c_acctbal > 5000")
def q_query_positional(spark, d):
    return fo.run_query(spark, "SELECT * FROM customer WHERE c_nationkey = ? AND c_acctbal > ?",
                        args=[7, 5000.0], tables={"customer": Tables(spark, d).customer})


@register("query_time_range", """
SELECT * FROM events WHERE user_id = 7
  AND ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'""")
def q_query_time_range(spark, d):
    return fo.run_query(
        spark,
        "SELECT * FROM events WHERE user_id = :uid "
        "AND ts >= CAST(:t0 AS TIMESTAMP_NTZ) AND ts < CAST(:t1 AS TIMESTAMP_NTZ)",
        args={"uid": 7, "t0": "2024-01-15 00:00:00", "t1": "2024-01-20 00:00:00"},
        tables={"events": Tables(spark, d).events})


# ---------------------------------------------------------------- fan-out
EV_COLS = "e.event_id, e.ts, e.user_id, e.event_type, e.value, e.props"


def _params(spark, rows, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


@register("fanout_equality", f"""
SELECT {EV_COLS} FROM events e
JOIN (VALUES (7, 'click'), (8, 'view'), (42, 'purchase'), (99, 'error')) p(user_id, event_type)
  ON e.user_id = p.user_id AND e.event_type = p.event_type""")
def q_fanout_equality(spark, d):
    params = _params(spark, [(7, "click"), (8, "view"), (42, "purchase"), (99, "error")],
                     "user_id bigint, event_type string")
    return fo.fanout(Tables(spark, d).events, params, on=["user_id", "event_type"])


@register("fanout_duplicates", f"""
SELECT {EV_COLS} FROM events e JOIN (VALUES (7, 'click')) p(user_id, event_type)
  ON e.user_id = p.user_id AND e.event_type = p.event_type
UNION ALL
SELECT {EV_COLS} FROM events e JOIN (VALUES (7, 'click')) p(user_id, event_type)
  ON e.user_id = p.user_id AND e.event_type = p.event_type
UNION ALL
SELECT {EV_COLS} FROM events e JOIN (VALUES (9, 'view')) p(user_id, event_type)
  ON e.user_id = p.user_id AND e.event_type = p.event_type""")
def q_fanout_duplicates(spark, d):
    params = _params(spark, [(7, "click"), (7, "click"), (9, "view")],
                     "user_id bigint, event_type string")
    return fo.fanout(Tables(spark, d).events, params, on=["user_id", "event_type"])


@register("fanout_residual", f"""
SELECT {EV_COLS} FROM events e
JOIN (VALUES (7, 50.0), (8, 10.0), (9, 90.0), (10, 0.0)) p(user_id, min_value)
  ON e.user_id = p.user_id AND e.value > p.min_value""")
def q_fanout_residual(spark, d):
    params = _params(spark, [(7, 50.0), (8, 10.0), (9, 90.0), (10, 0.0)],
                     "user_id bigint, min_value double")
    return fo.fanout(Tables(spark, d).events, params, on="user_id",
                     condition="s.value > p.min_value")


@register("fanout_key_and_range", f"""
SELECT {EV_COLS} FROM events e
JOIN (VALUES (7, TIMESTAMP '2024-01-15 00:00:00', TIMESTAMP '2024-01-20 00:00:00'),
             (11, TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-03 12:00:00'),
             (7, TIMESTAMP '2024-01-18 00:00:00', TIMESTAMP '2024-01-25 00:00:00')) p(user_id, t0, t1)
  ON e.user_id = p.user_id AND e.ts >= p.t0 AND e.ts < p.t1""")
def q_fanout_key_and_range(spark, d):
    rows = [(7, dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 20)),
            (11, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3, 12)),
            (7, dt.datetime(2024, 1, 18), dt.datetime(2024, 1, 25))]
    params = _params(spark, rows, "user_id bigint, t0 timestamp_ntz, t1 timestamp_ntz")
    return fo.fanout(Tables(spark, d).events, params, on="user_id",
                     condition="s.ts >= p.t0 AND s.ts < p.t1")


@register("fanout_limit_per_set", f"""
WITH j AS (
  SELECT {EV_COLS}, p.param_set,
         ROW_NUMBER() OVER (PARTITION BY p.param_set ORDER BY e.ts DESC NULLS LAST, e.event_id NULLS FIRST) AS rn
  FROM events e JOIN (VALUES (1, 7), (2, 7), (3, 8), (4, 9), (5, 123456)) p(param_set, user_id)
    ON e.user_id = p.user_id)
SELECT event_id, ts, user_id, event_type, value, props, CAST(param_set AS BIGINT) AS param_set
FROM j WHERE rn <= 3""")
def q_fanout_limit_per_set(spark, d):
    params = _params(spark, [(1, 7), (2, 7), (3, 8), (4, 9), (5, 123456)],
                     "param_set bigint, user_id bigint")
    return fo.fanout_limit(Tables(spark, d).events, params, 3,
                           order_by=[F.col("ts").desc(), F.col("event_id")], on="user_id")


@register("fanout_count_per_set", """
SELECT CAST(p.param_set AS BIGINT) AS param_set, CAST(p.user_id AS BIGINT) AS user_id,
       p.event_type, COUNT(e.event_id) AS cnt
FROM (VALUES (1, 7, 'click'), (2, 7, 'click'), (3, 8, 'view'), (4, 123456, 'view'), (5, 9, 'nope'))
     p(param_set, user_id, event_type)
LEFT JOIN events e ON e.user_id = p.user_id AND e.event_type = p.event_type
GROUP BY p.param_set, p.user_id, p.event_type""")
def q_fanout_count_per_set(spark, d):
    params = _params(spark, [(1, 7, "click"), (2, 7, "click"), (3, 8, "view"),
                             (4, 123456, "view"), (5, 9, "nope")],
                     "param_set bigint, user_id bigint, event_type string")
    return fo.fanout_count(Tables(spark, d).events, params, on=["user_id", "event_type"],
                           count_col="event_id")


@register("fanout_empty", "SELECT * FROM events WHERE false")
def q_fanout_empty(spark, d):
    params = _params(spark, [], "user_id bigint")
    return fo.fanout(Tables(spark, d).events, params, on="user_id")


@register("fanout_from_table", f"""
SELECT o.* FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment = 'MACHINERY'""")
def q_fanout_from_table(spark, d):
    t = Tables(spark, d)
    params = t.customer.filter(F.col("c_mktsegment") == "MACHINERY").select("c_custkey")
    return fo.fanout(t.orders, params, on={"c_custkey": "o_custkey"})


@register("latest_per_key", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id NULLS FIRST) AS rn FROM events)
WHERE rn = 1""")
def q_latest_per_key(spark, d):
    return fo.latest_per_key(Tables(spark, d).events, "user_id",
                             [F.col("ts").desc(), F.col("event_id")])


# ---------------------------------------------------------------- SQL transforms (Q1-Q27)
def _sql_pair(name: str, table: str, sql: str, oracle: str | None = None,
              extra_tables: tuple[str, ...] = (), exact: bool = True):
    """Register a transform: ``sql`` over ``source`` = ``table`` on Spark; the
    oracle is the same text with ``source`` bound by a CTE (or ``oracle``)."""
    if oracle is None:
        body = sql.strip()
        if body.upper().startswith("WITH RECURSIVE "):
            oracle = f"WITH RECURSIVE source AS (SELECT * FROM {table}), " + body[len("WITH RECURSIVE "):]
        elif body.upper().startswith("WITH "):
            oracle = f"WITH source AS (SELECT * FROM {table}), " + body[len("WITH "):]
        else:
            oracle = f"WITH source AS (SELECT * FROM {table}) " + body

    def fn(spark, d, _t=table, _sql=sql, _extra=extra_tables):
        t = Tables(spark, d)
        return transform(spark, getattr(t, _t), _sql, {n: getattr(t, n) for n in _extra})

    register(name, oracle if exact else None)(fn)


_sql_pair("sql_group_avg", "events", """
SELECT event_type, COUNT(*) AS cnt, CAST(ROUND(TRY_CAST(CAST(AVG(value) AS STRING) AS DECIMAL(38,18)), 6) AS DOUBLE) AS avg_value FROM source GROUP BY event_type""")
_sql_pair("sql_distinct", "events", "SELECT DISTINCT event_type FROM source")
_sql_pair("sql_order_limit", "events", """
SELECT event_id, user_id, value FROM source ORDER BY value DESC NULLS LAST, event_id NULLS FIRST LIMIT 10""")
_sql_pair("sql_having", "events", """
SELECT user_id, COUNT(*) AS cnt FROM source GROUP BY user_id HAVING COUNT(*) > 70""")
_sql_pair("sql_filter_agg", "events", """
SELECT user_id, COUNT(*) FILTER (WHERE event_type = 'click') AS clicks, COUNT(*) AS total,
       CAST(ROUND(TRY_CAST(CAST(SUM(value) FILTER (WHERE value > 50) AS STRING) AS DECIMAL(38,18)), 4) AS DOUBLE) AS big_sum
FROM source GROUP BY user_id""")
_sql_pair("sql_rollup", "orders", """
SELECT o_orderstatus, o_orderpriority, COUNT(*) AS cnt, CAST(ROUND(TRY_CAST(CAST(SUM(o_totalprice) AS STRING) AS DECIMAL(38,18)), 2) AS DOUBLE) AS total
FROM source GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""")
_sql_pair("sql_cube", "orders", """
SELECT o_orderstatus, o_orderpriority, COUNT(*) AS cnt FROM source
GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
_sql_pair("sql_grouping_sets", "lineitem", """
SELECT l_returnflag, l_linestatus, COUNT(*) AS cnt, CAST(ROUND(TRY_CAST(CAST(SUM(l_quantity) AS STRING) AS DECIMAL(38,18)), 2) AS DOUBLE) AS qty FROM source
GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())""")
_sql_pair("sql_self_join", "orders", """
WITH best AS (SELECT o_custkey, MAX(o_totalprice) AS mx FROM source GROUP BY o_custkey)
SELECT s.o_orderkey, s.o_custkey, s.o_totalprice FROM source s
JOIN best b ON s.o_custkey = b.o_custkey AND s.o_totalprice = b.mx""")
_sql_pair("sql_semi", "orders", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM source WHERE o_orderstatus = 'F')""",
          extra_tables=("customer",))
_sql_pair("sql_anti", "orders", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM source o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')""",
          extra_tables=("customer",))
_sql_pair("sql_outer", "orders", """
WITH a AS (SELECT o_custkey AS k, COUNT(*) AS n_f FROM source WHERE o_orderstatus = 'F' GROUP BY o_custkey),
     b AS (SELECT o_custkey AS k, COUNT(*) AS n_p FROM source WHERE o_orderstatus = 'P' GROUP BY o_custkey)
SELECT COALESCE(a.k, b.k) AS custkey, a.n_f, b.n_p FROM a FULL OUTER JOIN b ON a.k = b.k""")
_sql_pair("sql_theta", "orders", """
WITH bands AS (SELECT * FROM VALUES (0, 0.0, 100000.0), (1, 100000.0, 250000.0),
                                   (2, 250000.0, 400000.0), (3, 400000.0, 1.0E9) AS v(band, lo, hi))
SELECT s.o_orderkey, b.band FROM source s JOIN bands b
  ON s.o_totalprice >= b.lo AND s.o_totalprice < b.hi""", oracle="""
WITH bands AS (SELECT * FROM (VALUES (0, 0.0::DOUBLE, 100000.0::DOUBLE), (1, 100000.0, 250000.0),
                                     (2, 250000.0, 400000.0), (3, 400000.0, 1.0E9)) v(band, lo, hi))
SELECT s.o_orderkey, b.band FROM orders s JOIN bands b
  ON s.o_totalprice >= b.lo AND s.o_totalprice < b.hi""")
_sql_pair("sql_scalar_subquery", "orders", """
SELECT o_orderkey, o_totalprice FROM source
WHERE o_totalprice >= (SELECT MAX(o_totalprice) FROM source) * 0.9""")
_sql_pair("sql_exists", "orders", """
SELECT c_custkey FROM customer c
WHERE EXISTS (SELECT 1 FROM source o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000)""",
          extra_tables=("customer",))
_sql_pair("sql_correlated_scalar", "orders", """
SELECT c_custkey, (SELECT COUNT(*) FROM source o WHERE o.o_custkey = c.c_custkey) AS n_orders
FROM customer c""", extra_tables=("customer",))
_sql_pair("sql_cte", "orders", """
WITH t AS (SELECT o_custkey, SUM(o_totalprice) AS total FROM source GROUP BY o_custkey)
SELECT o_custkey, CAST(ROUND(TRY_CAST(CAST(total AS STRING) AS DECIMAL(38,18)), 2) AS DOUBLE) AS total FROM t WHERE total > 1000000""")
_sql_pair("sql_recursive", "region", """
WITH RECURSIVE chain(k, depth) AS (
  SELECT r_regionkey, 0 FROM source WHERE r_regionkey = 0
  UNION ALL
  SELECT s.r_regionkey, c.depth + 1 FROM chain c JOIN source s ON s.r_regionkey = c.k + 1)
SELECT k, depth FROM chain""")
_sql_pair("sql_union", "orders", """
SELECT o_custkey AS k FROM source WHERE o_orderstatus = 'F'
UNION SELECT o_custkey FROM source WHERE o_totalprice > 400000""")
_sql_pair("sql_union_all", "orders", """
SELECT o_custkey AS k FROM source WHERE o_orderstatus = 'F'
UNION ALL SELECT o_custkey FROM source WHERE o_totalprice > 400000""")
_sql_pair("sql_intersect", "orders", """
SELECT o_custkey AS k FROM source WHERE o_orderstatus = 'F'
INTERSECT SELECT o_custkey FROM source WHERE o_totalprice > 400000""")
_sql_pair("sql_except", "orders", """
SELECT o_custkey AS k FROM source WHERE o_orderstatus = 'F'
EXCEPT SELECT o_custkey FROM source WHERE o_totalprice > 400000""")
_sql_pair("sql_rank", "orders", """
SELECT o_orderkey, o_custkey,
  CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey NULLS FIRST) AS BIGINT) AS rn,
  CAST(RANK() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus NULLS FIRST) AS BIGINT) AS rnk,
  CAST(DENSE_RANK() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus NULLS FIRST) AS BIGINT) AS drnk,
  CAST(NTILE(4) OVER (PARTITION BY o_custkey ORDER BY o_totalprice NULLS FIRST, o_orderkey NULLS FIRST) AS BIGINT) AS quart,
  CAST(ROUND(TRY_CAST(CAST(PERCENT_RANK() OVER (PARTITION BY o_custkey ORDER BY o_totalprice NULLS FIRST, o_orderkey NULLS FIRST) AS STRING) AS DECIMAL(38,18)), 6) AS DOUBLE) AS prank,
  CAST(ROUND(TRY_CAST(CAST(CUME_DIST() OVER (PARTITION BY o_custkey ORDER BY o_totalprice NULLS FIRST, o_orderkey NULLS FIRST) AS STRING) AS DECIMAL(38,18)), 6) AS DOUBLE) AS cdist
FROM source""")
_sql_pair("sql_lag_lead", "orders", """
SELECT o_orderkey, o_custkey,
  LAG(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS prev_price,
  LEAD(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS next2,
  FIRST_VALUE(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS first_key,
  LAST_VALUE(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_key,
  NTH_VALUE(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second_key
FROM source""")
_sql_pair("sql_frame", "events", """
SELECT event_id, user_id,
  CAST(ROUND(TRY_CAST(CAST(SUM(value) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST
        ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS STRING) AS DECIMAL(38,18)), 4) AS DOUBLE) AS sum3,
  COUNT(*) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running,
  CAST(ROUND(TRY_CAST(CAST(AVG(value) OVER (PARTITION BY user_id ORDER BY event_id NULLS FIRST
        RANGE BETWEEN 100 PRECEDING AND CURRENT ROW) AS STRING) AS DECIMAL(38,18)), 4) AS DOUBLE) AS avg_range
FROM source""")
_sql_pair("sql_string", "customer", """
SELECT c_custkey, UPPER(c_name) AS up, LOWER(c_mktsegment) AS low, SUBSTRING(c_name, 10, 9) AS tail,
  CAST(LENGTH(c_name) AS BIGINT) AS len, REPLACE(c_name, 'Customer#', 'C-') AS rep,
  c_mktsegment || '/' || CAST(c_nationkey AS STRING) AS cat, LPAD(CAST(c_nationkey AS STRING), 3, '0') AS pad,
  TRIM('  ' || c_mktsegment || '  ') AS trimmed, c_name LIKE '%00%' AS has00,
  SPLIT_PART(c_name, '#', 2) AS num, REGEXP_REPLACE(c_mktsegment, '[AEIOU]', '') AS noval
FROM source""", oracle="""
SELECT c_custkey, UPPER(c_name) AS up, LOWER(c_mktsegment) AS low, SUBSTRING(c_name, 10, 9) AS tail,
  CAST(LENGTH(c_name) AS BIGINT) AS len, REPLACE(c_name, 'Customer#', 'C-') AS rep,
  c_mktsegment || '/' || CAST(c_nationkey AS VARCHAR) AS cat, LPAD(CAST(c_nationkey AS VARCHAR), 3, '0') AS pad,
  TRIM('  ' || c_mktsegment || '  ') AS trimmed, c_name LIKE '%00%' AS has00,
  SPLIT_PART(c_name, '#', 2) AS num, REGEXP_REPLACE(c_mktsegment, '[AEIOU]', '', 'g') AS noval
FROM customer""")
_sql_pair("sql_date", "orders", """
SELECT o_orderkey, CAST(YEAR(o_orderdate) AS INT) AS y, CAST(MONTH(o_orderdate) AS INT) AS m,
  CAST(EXTRACT(DAY FROM o_orderdate) AS INT) AS dd, MAKE_DATE(YEAR(o_orderdate), MONTH(o_orderdate), 1) AS month_start,
  CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS due, CAST(DAYOFWEEK(o_orderdate) AS INT) AS dow,
  DATE_FORMAT(o_orderdate, 'yyyy-MM') AS ym
FROM source""", oracle="""
SELECT o_orderkey, CAST(YEAR(o_orderdate) AS INT) AS y, CAST(MONTH(o_orderdate) AS INT) AS m,
  CAST(EXTRACT(DAY FROM o_orderdate) AS INT) AS dd, MAKE_DATE(YEAR(o_orderdate), MONTH(o_orderdate), 1) AS month_start,
  CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS due, CAST(DAYOFWEEK(o_orderdate) + 1 AS INT) AS dow,
  STRFTIME(o_orderdate, '%Y-%m') AS ym
FROM orders""")
_sql_pair("sql_time_bin", "events", """
SELECT CAST(HOUR(ts) AS INT) AS hr, COUNT(*) AS cnt, CAST(ROUND(TRY_CAST(CAST(SUM(value) AS STRING) AS DECIMAL(38,18)), 4) AS DOUBLE) AS total
FROM source GROUP BY HOUR(ts)""", oracle="""
SELECT CAST(HOUR(ts) AS INT) AS hr, COUNT(*) AS cnt, CAST(ROUND(TRY_CAST(CAST(SUM(value) AS STRING) AS DECIMAL(38,18)), 4) AS DOUBLE) AS total
FROM events GROUP BY HOUR(ts)""")
_sql_pair("sql_math", "orders", """
SELECT o_orderkey, CAST(ROUND(TRY_CAST(CAST(o_totalprice / 1000 AS STRING) AS DECIMAL(38,18)), 2) AS DOUBLE) AS k, CAST(FLOOR(o_totalprice / 1000) AS BIGINT) AS fl,
  CAST(CEIL(o_totalprice / 1000) AS BIGINT) AS ce, ABS(o_totalprice - 200000) AS dist,
  CAST(ROUND(TRY_CAST(CAST(SQRT(GREATEST(o_totalprice, 0)) AS STRING) AS DECIMAL(38,18)), 6) AS DOUBLE) AS sq, CAST(ROUND(TRY_CAST(CAST(LN(GREATEST(o_totalprice, 0) + 1) AS STRING) AS DECIMAL(38,18)), 6) AS DOUBLE) AS lg, POWER(o_orderkey % 7, 2) AS p2,
  o_orderkey % 7 AS md, CAST(ROUND(TRY_CAST(CAST(SIN(o_orderkey) AS STRING) AS DECIMAL(38,18)), 6) AS DOUBLE) AS sn
FROM source""")
_sql_pair("sql_array", "embeddings", """
SELECT vec_id, CAST(SIZE(embedding) AS BIGINT) AS n, CAST(ROUND(TRY_CAST(CAST(CAST(try_element_at(embedding, 1) AS DOUBLE) AS STRING) AS DECIMAL(38,18)), 5) AS DOUBLE) AS first,
  ARRAY_CONTAINS(TRANSFORM(embedding, x -> x > 0.9), true) AS any_high,
  CAST(ROUND(TRY_CAST(CAST(AGGREGATE(embedding, CAST(0 AS DOUBLE), (acc, x) -> acc + CAST(x AS DOUBLE)) AS STRING) AS DECIMAL(38,18)), 4) AS DOUBLE) AS total
FROM source""", oracle="""
SELECT vec_id, CAST(LEN(embedding) AS BIGINT) AS n, CAST(ROUND(TRY_CAST(CAST(CAST(embedding[1] AS DOUBLE) AS STRING) AS DECIMAL(38,18)), 5) AS DOUBLE) AS first,
  LIST_CONTAINS(LIST_TRANSFORM(embedding, lambda x: x > 0.9), true) AS any_high,
  CAST(ROUND(TRY_CAST(CAST(LIST_REDUCE(LIST_TRANSFORM(embedding, lambda x: CAST(x AS DOUBLE)), lambda acc, x: acc + x, 0.0::DOUBLE) AS STRING) AS DECIMAL(38,18)), 4) AS DOUBLE) AS total
FROM embeddings""")
_sql_pair("sql_unnest", "embeddings", """
SELECT label, COUNT(*) AS n, CAST(ROUND(TRY_CAST(CAST(MAX(CAST(x AS DOUBLE)) AS STRING) AS DECIMAL(38,18)), 5) AS DOUBLE) AS mx
FROM (SELECT label, explode(embedding) AS x FROM source) GROUP BY label""", oracle="""
SELECT label, COUNT(*) AS n, CAST(ROUND(TRY_CAST(CAST(MAX(CAST(x AS DOUBLE)) AS STRING) AS DECIMAL(38,18)), 5) AS DOUBLE) AS mx
FROM (SELECT label, UNNEST(embedding) AS x FROM embeddings) GROUP BY label""")
_sql_pair("sql_map", "events", """
SELECT event_id, try_element_at(map_keys(m), 1) AS first_key, CAST(m['k'] AS INT) AS k
FROM (SELECT event_id, from_json(props, 'map<string,string>') AS m FROM source)""", oracle="""
SELECT event_id, json_keys(props)[1] AS first_key, CAST(json_extract_string(props, '$.k') AS INT) AS k
FROM events""")
_sql_pair("sql_json", "events", """
SELECT event_id, CAST(get_json_object(props, '$.k') AS INT) AS k, props LIKE '%"k"%' AS has_k
FROM source""", oracle="""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, props LIKE '%"k"%' AS has_k
FROM events""")
_sql_pair("sql_null", "orders", """
SELECT o_orderkey, NULLIF(o_orderstatus, 'F') AS st, COALESCE(NULLIF(o_orderstatus, 'F'), 'x') AS st2,
  GREATEST(o_totalprice, 100000.0) AS g, LEAST(o_totalprice, 100000.0) AS l,
  CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'low' END AS band,
  NULLIF(o_orderstatus, 'F') IS NULL AS was_f
FROM source""")
_sql_pair("sql_stats", "lineitem", """
SELECT l_returnflag, CAST(ROUND(TRY_CAST(CAST(STDDEV_SAMP(l_quantity) AS STRING) AS DECIMAL(38,18)), 6) AS DOUBLE) AS sd, CAST(ROUND(TRY_CAST(CAST(VAR_POP(l_extendedprice) AS STRING) AS DECIMAL(38,18)), 2) AS DOUBLE) AS vp,
  CAST(ROUND(TRY_CAST(CAST(CORR(l_quantity, l_extendedprice) AS STRING) AS DECIMAL(38,18)), 6) AS DOUBLE) AS cr, MIN(l_discount) AS mn, MAX(l_tax) AS mx,
  COUNT(DISTINCT l_suppkey) AS suppliers, CAST(ROUND(TRY_CAST(CAST(MEDIAN(l_quantity) AS STRING) AS DECIMAL(38,18)), 2) AS DOUBLE) AS med,
  BOOL_AND(l_quantity > 0) AS all_pos, BOOL_OR(l_discount > 0.09) AS any_big
FROM source GROUP BY l_returnflag""")
_sql_pair("sql_string_agg", "nation", """
SELECT n_regionkey, ARRAY_JOIN(ARRAY_SORT(COLLECT_LIST(n_name)), ',') AS names, COUNT(*) AS n
FROM source GROUP BY n_regionkey""", oracle="""
SELECT n_regionkey, ARRAY_TO_STRING(LIST_SORT(LIST(n_name)), ',') AS names, COUNT(*) AS n
FROM nation GROUP BY n_regionkey""")
_sql_pair("sql_values", "region", """
SELECT r.r_name, v.code FROM source r JOIN (VALUES (0, 'AF'), (1, 'AM'), (2, 'AS'), (3, 'EU'), (4, 'ME')) AS v(k, code)
  ON r.r_regionkey = v.k""", oracle="""
SELECT r.r_name, v.code FROM region r JOIN (VALUES (0, 'AF'), (1, 'AM'), (2, 'AS'), (3, 'EU'), (4, 'ME')) AS v(k, code)
  ON r.r_regionkey = v.k""")
_sql_pair("sql_offset", "orders", """
SELECT o_orderkey, o_totalprice FROM source ORDER BY o_totalprice DESC NULLS LAST, o_orderkey NULLS FIRST LIMIT 5 OFFSET 5""")
_sql_pair("sql_double_quoted", "customer", """
SELECT "c_mktsegment", COUNT(*) AS cnt FROM source GROUP BY "c_mktsegment\"""", oracle="""
SELECT c_mktsegment, COUNT(*) AS cnt FROM customer GROUP BY c_mktsegment""")
_sql_pair("sql_approx", "lineitem", """
SELECT l_returnflag, approx_count_distinct(l_partkey) AS parts,
       percentile_approx(l_extendedprice, 0.5) AS median_price
FROM source GROUP BY l_returnflag""", exact=False)


# ---------------------------------------------------------------- flagship
def _flagship(spark, d):
    from ringcast.plans.flagship import flagship

    return flagship(spark, d)


def _register_flagship():
    from ringcast.plans.flagship import FLAGSHIP_ORACLE

    register("flagship_export", FLAGSHIP_ORACLE)(_flagship)


_register_flagship()


def all_queries() -> dict[str, tuple[QueryFn, str | None]]:
    """Every registered query; importing the other catalogs registers theirs."""
    from ringcast.plans import catalog_forms, catalog_io, catalog_more, catalog_params  # noqa: F401

    return dict(REGISTRY)


# ---------------------------------------------------------------- query text per parameter set
@register("query_fanout_text", f"""
SELECT {EV_COLS} FROM events e
JOIN (VALUES (7, 50.0), (8, 10.0), (7, 50.0)) p(uid, v) ON e.user_id = p.uid AND e.value > p.v""")
def q_query_fanout_text(spark, d):
    params = _params(spark, [(7, 50.0), (8, 10.0), (7, 50.0)], "uid bigint, v double")
    return fo.query_fanout(spark, "SELECT * FROM events WHERE user_id = :uid AND value > :v", params,
                           tables={"events": Tables(spark, d).events})


@register("query_fanout_limit", """
SELECT event_id, ts, user_id, event_type, value, props, param_set FROM (
  SELECT e.*, CAST(p.param_set AS BIGINT) AS param_set,
         ROW_NUMBER() OVER (PARTITION BY p.param_set ORDER BY e.ts DESC NULLS LAST, e.event_id NULLS FIRST) AS rn
  FROM events e JOIN (VALUES (1, 7), (2, 7), (3, 12), (4, 123456)) p(param_set, uid) ON e.user_id = p.uid)
WHERE rn <= 4""")
def q_query_fanout_limit(spark, d):
    params = _params(spark, [(1, 7), (2, 7), (3, 12), (4, 123456)], "param_set bigint, uid bigint")
    return fo.query_fanout(spark, "SELECT * FROM events WHERE user_id = :uid ORDER BY ts DESC, event_id LIMIT 4",
                           params, tables={"events": Tables(spark, d).events}, set_col="param_set")


@register("query_fanout_count", """
SELECT CAST(p.param_set AS BIGINT) AS param_set, COUNT(e.user_id) AS cnt, CAST(ROUND(TRY_CAST(CAST(SUM(e.value) AS STRING) AS DECIMAL(38,18)), 4) AS DOUBLE) AS total
FROM (VALUES (1, 7, 'click'), (2, 7, 'click'), (3, 8, 'view'), (4, 123456, 'view')) p(param_set, uid, kind)
LEFT JOIN events e ON e.user_id = p.uid AND e.event_type = p.kind
GROUP BY p.param_set""")
def q_query_fanout_count(spark, d):
    params = _params(spark, [(1, 7, "click"), (2, 7, "click"), (3, 8, "view"), (4, 123456, "view")],
                     "param_set bigint, uid bigint, kind string")
    return fo.query_fanout(
        spark, "SELECT COUNT(*) AS cnt, CAST(ROUND(TRY_CAST(CAST(SUM(value) AS STRING) AS DECIMAL(38,18)), 4) AS DOUBLE) AS total FROM events "
               "WHERE user_id = :uid AND event_type = :kind",
        params, tables={"events": Tables(spark, d).events}, set_col="param_set")


@register("query_fanout_positional", """
SELECT c.* FROM customer c JOIN (VALUES (7, 5000.0), (3, 9000.0)) p(p0, p1)
  ON c.c_nationkey = p.p0 AND c.c_acctbal > p.p1""")
def q_query_fanout_positional(spark, d):
    params = _params(spark, [(7, 5000.0), (3, 9000.0)], "p0 int, p1 double")
    return fo.query_fanout(spark, "SELECT * FROM customer WHERE c_nationkey = ? AND c_acctbal > ?",
                           params, tables={"customer": Tables(spark, d).customer})


# ---------------------------------------------------------------- dialect helpers (§2.9)
@register("sql_date_bin", """
SELECT time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01 00:00:00') AS bin, COUNT(*) AS cnt,
       CAST(ROUND(TRY_CAST(CAST(SUM(value) AS STRING) AS DECIMAL(38,18)), 4) AS DOUBLE) AS total
FROM events GROUP BY 1""")
def q_sql_date_bin(spark, d):
    from ringcast.functions.time import date_bin

    ev = Tables(spark, d).events
    return (ev.groupBy(date_bin(dt.timedelta(minutes=15), "ts").alias("bin"))
            .agg(F.count(F.lit(1)).alias("cnt"), round_text(F.sum("value"), 4).alias("total")))


@register("sql_trunc_month", """
SELECT date_trunc('month', o_orderdate) AS month, COUNT(*) AS cnt FROM orders GROUP BY 1""")
def q_sql_trunc_month(spark, d):
    from ringcast.functions.time import trunc_ntz

    o = Tables(spark, d).orders
    return o.groupBy(trunc_ntz("MONTH", "o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("cnt"))


@register("sql_distinct_on", """
SELECT DISTINCT ON (o_custkey) * FROM orders ORDER BY o_custkey, o_totalprice DESC NULLS LAST, o_orderkey NULLS FIRST""")
def q_sql_distinct_on(spark, d):
    from ringcast.functions.time import distinct_on

    return distinct_on(Tables(spark, d).orders, "o_custkey", [F.col("o_totalprice").desc(), "o_orderkey"])
