"""Forms that take more than one operator: a single ordered file, a range per set,
error places, a layout behind a shuffle, nested conversion, stored sketches, the
schema of a result (W5, S3, F6, P13, S1, C10, C18-C20, Q10, S8)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ringcast.functions import convert as cv
from ringcast.functions.tokens import multiplicative_token, range_bound
from ringcast.operators import fanout as fo
from ringcast.operators import ring, sketches
from ringcast.operators.transform import transform
from ringcast.plans.catalog import SPLITS, register, split_sql, tok_sql
from ringcast.plans.catalog_params import ERROR_MARKERS, FAULTS
from ringcast.plans.generate import EVENTS, events_of
from ringcast.session import materialize, scratch_path
from ringcast.sinks.writer import write
from ringcast.sources.params import read_params
from ringcast.sources.table import Tables


@register("write_single_ordered", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders""")
def q_write_single_ordered(spark, d):
    """An ORDER BY through one Parquet file: a row's place in the file is its place in the order."""
    ordered = transform(spark, Tables(spark, d).orders,
                        "SELECT o_orderkey, o_totalprice FROM source ORDER BY o_totalprice DESC, o_orderkey")
    path = write(ordered, scratch_path(spark, "w-ordered") + ".parquet", single_file=True)
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", (F.col("_metadata.row_index") + 1).alias("place"))


@register("fanout_range_only", """
SELECT c.c_custkey, o.o_orderkey, o.o_totalprice FROM orders o JOIN customer c
  ON o.o_totalprice >= abs(c.c_acctbal) * 20 AND o.o_totalprice < abs(c.c_acctbal) * 20 + c.c_nationkey * 10
WHERE c.c_mktsegment = 'MACHINERY'""")
def q_fanout_range_only(spark, d):
    """A query text whose sets, read from a table, bind a range and nothing else."""
    t = Tables(spark, d)
    low = F.abs("c_acctbal") * 20
    params = t.customer.filter("c_mktsegment = 'MACHINERY'").select(
        "c_custkey", low.alias("low"), (low + F.col("c_nationkey") * 10).alias("high"))
    return fo.query_fanout(spark, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= :low AND o_totalprice < :high",
                           params, tables={"orders": t.orders}, set_col="c_custkey")


@register("fanout_range_count", """
WITH p AS (SELECT n_nationkey AS param_set, n_nationkey * 20000.0 AS low,
                  CASE WHEN n_nationkey = 7 THEN 1e300 ELSE n_nationkey * 20000.0 + n_nationkey * n_nationkey END AS high FROM nation)
SELECT p.param_set, COUNT(o.o_orderkey) AS cnt FROM p LEFT JOIN orders o ON o.o_totalprice BETWEEN p.low AND p.high
GROUP BY p.param_set""")
def q_fanout_range_count(spark, d):
    """Ranges of every width, one of them without an end in sight, counted per set."""
    t = Tables(spark, d)
    key = F.col("n_nationkey")
    low = key * F.lit(20000.0)
    params = t.nation.select(key.alias("param_set"), low.alias("low"),
                             F.when(key == 7, F.lit(1e300)).otherwise(low + key * key).alias("high"))
    return fo.fanout_count(t.orders, params, between=("o_totalprice", "low", "high"), keep_params=False)


def _places_oracle() -> str:
    names = " ".join(f"WHEN {k} THEN {('NULL' if n is None else repr(n))}" for k, (n, _) in FAULTS.items())
    reasons = " ".join(f"WHEN {k} THEN '{r}'" for k, (_, r) in FAULTS.items())
    return f"""
WITH l AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS line,
                  row_number() OVER (ORDER BY event_type, event_id) AS param_set FROM events)
SELECT event_type AS file, line, param_set, CASE event_id % 10 {names} END AS name, CASE event_id % 10 {reasons} END AS reason
FROM l WHERE event_id % 10 BETWEEN 1 AND 8"""


@register("params_error_places", _places_oracle())
def q_params_error_places(spark, d):
    """File, line and set number of every error, over one file per event type."""
    eid, uid, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    small = (eid % 100).alias("small")

    def obj(*columns):
        return F.to_json(F.struct(*columns))

    e, u, k = eid.alias("eid"), uid.alias("uid"), kind.alias("kind")
    case = eid % 10
    line = (F.when(case == 1, obj(e, uid.cast("string").alias("uid"), k, small))
            .when(case == 2, obj(e, u, k, small, F.lit("x").alias("zone")))
            .when(case == 3, F.format_string('{"eid":%d,"uid":null,"kind":"%s","small":%d}', eid, kind, eid % 100))
            .when(case == 4, F.format_string('{"eid":%d,"uid":%d.0,"kind":"%s","small":%d}', eid, uid, kind, eid % 100))
            .when(case == 5, F.format_string("[%d]", eid)).when(case == 6, F.format_string("bad #%d", eid))
            .when(case == 7, obj(e, u, small)).when(case == 8, obj(e, u, k, F.lit(300).alias("small")))
            .when(case == 9, F.lit("")).otherwise(obj(e, u, k, small)))
    path = scratch_path(spark, "params-places")
    (Tables(spark, d).events.select(line.alias("value"), "event_type", "event_id")
     .repartition("event_type").sortWithinPartitions("event_type", "event_id")
     .drop("event_id").write.partitionBy("event_type").text(path))
    errors = read_params(spark, path, ERROR_MARKERS, on_error="collect")[1]
    return errors.select(F.regexp_extract("file", "event_type=([^/]+)/", 1).alias("file"), "line", "param_set", "name", "reason")


_RANGE3 = range_bound(SPLITS, 3)


@register("token_layout_shuffled", f"""
SELECT o_custkey, COUNT(*) AS orders, {tok_sql('o_custkey')} AS token FROM orders
WHERE {tok_sql('o_custkey')} >= {_RANGE3[1]} AND {tok_sql('o_custkey')} < {_RANGE3[2]} GROUP BY o_custkey""")
def q_token_layout_shuffled(spark, d):
    """A layout of rows that come out of a shuffle, and one range read from its files alone."""
    per_customer = Tables(spark, d).orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    path = ring.write_token_layout(per_customer, "o_custkey", scratch_path(spark, "layout-shuffled"), num_files=8,
                                   token_method="multiplicative")
    return ring.read_layout_split(spark, path, SPLITS, 3)


@register("token_layout_manifest", f"""
SELECT COUNT(*) AS rows, MIN({tok_sql('o_orderkey')}) AS min_token, MAX({tok_sql('o_orderkey')}) AS max_token,
       0 AS overlapping FROM orders""")
def q_token_layout_manifest(spark, d):
    """The manifest covers all rows, and files share no token but at their ends."""
    path = ring.write_token_layout(Tables(spark, d).orders, "o_orderkey", scratch_path(spark, "layout-manifest"),
                                   num_files=8, token_method="multiplicative")
    files = ring.layout_files(spark, path)
    before = F.lag("max_token").over(Window.orderBy("min_token", "max_token"))  # one row per file
    return files.withColumn("before", before).agg(
        F.sum("rows").alias("rows"), F.min("min_token").alias("min_token"), F.max("max_token").alias("max_token"),
        F.count_if(F.col("before") > F.col("min_token")).cast("int").alias("overlapping"))


@register("convert_timestamp_early", """
SELECT event_id, date_trunc('millisecond', ts - INTERVAL 80 YEAR) AS t_ms,
  (epoch_us(ts - INTERVAL 80 YEAR) - ((epoch_us(ts - INTERVAL 80 YEAR) % 1000) + 1000) % 1000) // 1000 AS ms FROM events""")
def q_convert_timestamp_early(spark, d):
    """Milliseconds before 1970 round down, not towards zero."""
    early = F.col("ts") - F.expr("INTERVAL 80 YEAR")
    micros = cv.epoch_micros_ntz(early)
    ms = F.call_function("div", micros - F.pmod(micros, F.lit(1000)), F.lit(1000))
    return Tables(spark, d).events.select("event_id", cv.floor_millis_ntz(early).alias("t_ms"), ms.alias("ms"))


@register("convert_nested", """
SELECT o_orderkey, '[{"a":[' || CASE WHEN o_custkey % 5 = 2 THEN '2' WHEN o_custkey % 5 < 2
  THEN CAST(o_custkey % 5 AS VARCHAR) || ',2' ELSE '2,' || CAST(o_custkey % 5 AS VARCHAR) END
  || ',null],"b":[' || CAST(o_orderkey % 1000 AS VARCHAR) || ']},{}]' AS nested,
  '{"1":[true,null],"2":null}' AS flags
FROM orders""")
def q_convert_nested(spark, d):
    """Three levels through convert_columns; what does not convert is null."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    texts = F.array((cust % 5).cast("string"), F.lit("x"), F.lit("2"), F.lit(" 2"))
    raw = Tables(spark, d).orders.select(
        "o_orderkey", F.array(F.create_map(F.lit("a"), texts, F.lit("b"), F.array((key % 1000).cast("string"))),
                              F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>"))).alias("nested"),
        F.create_map(F.lit("1"), F.array(F.lit("true"), F.lit("perhaps")), F.lit("2"), F.lit(None).cast("array<string>"),
                     F.lit("none"), F.array(F.lit("true"))).alias("flags"))
    out = cv.convert_columns(raw, {"nested": "list<map<text, frozen<set<int>>>>", "flags": "map<int,list<boolean>>"})
    return out.select("o_orderkey", F.to_json("nested").alias("nested"),
                      F.to_json("flags", {"ignoreNullFields": "false"}).alias("flags"))


@register("sketch_by_split", f"""
WITH t AS (SELECT {split_sql(tok_sql('l_orderkey * 8 + l_linenumber'))} AS split_id FROM lineitem)
SELECT CAST(split_id // 4 AS INTEGER) AS part, COUNT(*) AS rows, true AS distinct_ok, true AS median_ok, true AS tail_ok
FROM t GROUP BY 1""")
def q_sketch_by_split(spark, d):
    """Sketches per split, stored; figures of four splits each from merged sketches,
    held against the exact ones."""
    keyed = Tables(spark, d).lineitem.withColumn("pk", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    stored = materialize(sketches.sketch_by_split(keyed, "pk", SPLITS, "l_partkey", "l_extendedprice", "multiplicative"), "sketches")
    part = F.floor(F.col("split_id") / 4).cast("int")
    found = sketches.merged(stored, part.alias("part"), (0.5, 0.95))
    exact = ring.token_scan(keyed, "pk", SPLITS, token_method="multiplicative", keep_token=False).select(
        part.alias("part"), "l_partkey", "l_extendedprice")
    rank = {}
    for name, i, q in (("median_ok", 0, 0.5), ("tail_ok", 1, 0.95)):
        value, n = F.get("quantiles", F.lit(i)), F.count(F.lit(1))
        # the value's ranks, from its first to its last place, come within the bound of q
        rank[name] = ((F.count_if(F.col("l_extendedprice") < value) / n <= q + sketches.RANK_ERROR)
                      & (F.count_if(F.col("l_extendedprice") <= value) / n >= q - sketches.RANK_ERROR))
    off = F.abs(F.first("distinct") - F.count_distinct("l_partkey"))
    return exact.join(F.broadcast(found), "part").groupBy("part").agg(
        F.first("rows").alias("rows"), (off <= sketches.DISTINCT_ERROR * F.count_distinct("l_partkey")).alias("distinct_ok"),
        *[c.alias(name) for name, c in rank.items()])


@register("result_schema", """
SELECT 'o_orderkey' AS name, 'bigint' AS type, true AS nullable, COUNT(o_orderkey) AS filled FROM orders
UNION ALL SELECT 'half', 'double', true, COUNT(o_totalprice) FROM orders
UNION ALL SELECT 'day', 'date', true, COUNT(o_orderdate) FROM orders WHERE o_orderdate >= DATE '1995-01-01'
UNION ALL SELECT 'flag', 'boolean', true, COUNT(o_orderstatus) FROM orders""")
def q_result_schema(spark, d):
    """Names, types and nullability as a result's own schema has them, with the filled values of each."""
    out = transform(spark, Tables(spark, d).orders, """
SELECT o_orderkey, o_totalprice / 2 AS half, CASE WHEN o_orderdate >= DATE'1995-01-01' THEN CAST(o_orderdate AS DATE) END AS day,
  o_orderstatus = 'F' AS flag FROM source""")
    filled = out.agg(*[F.count(f.name).alias(f.name) for f in out.schema.fields])
    rows = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
                              F.lit(f.nullable).alias("nullable"), F.col(f.name).alias("filled")) for f in out.schema.fields])
    return filled.select(F.inline(rows))


def _pmod(x: str, m: int) -> str:
    return f"((({x}) % {m}) + {m}) % {m}"


@register("generate_events_rows", f"""
WITH t AS (SELECT {tok_sql('l_orderkey * 8 + l_linenumber')} AS r1, {tok_sql('l_partkey * 16 + l_linenumber')} AS r2 FROM lineitem),
h AS (SELECT r1, r2, lpad(lower(to_hex(r1)), 16, '0') AS a, lpad(lower(to_hex(r2)), 16, '0') AS b FROM t)
SELECT a[1:8] || '-' || a[9:12] || '-' || a[13:16] || '-' || b[1:4] || '-' || b[5:16] AS id,
  make_timestamp((1672531200000 + {_pmod('r1', 63072000000)}) * 1000) AS ts,
  'dev-' || lpad(CAST({_pmod('r1', 10000)} AS VARCHAR), 5, '0') AS device_id,
  'user-' || lpad(CAST({_pmod('r2', 100000)} AS VARCHAR), 6, '0') AS user_id,
  {EVENTS!r}[{_pmod('r1', 20)} + 1] AS event, ({_pmod('r1', 1000000)}) / 100.0 AS value,
  CAST({_pmod('r2', 10000)} AS INTEGER) AS count, {_pmod('r1', 2)} = 0 AS active
FROM h""")
def q_generate_events_rows(spark, d):
    """Every generated column, from numbers that both engines compute."""
    li = Tables(spark, d).lineitem
    base = li.select(multiplicative_token(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("r1"),
                     multiplicative_token(F.col("l_partkey") * 16 + F.col("l_linenumber")).alias("r2"))
    return events_of(base).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
