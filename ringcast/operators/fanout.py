"""Parameterised query fan-out.

The reference runs one query text once per parameter set and concatenates the
rows. On Spark the parameter sets are a DataFrame and the fan-out is a join:
every (row, set) pair that satisfies the set's predicate is one output row, so
equal or overlapping sets repeat rows exactly as repeated executions would.

Scale rules applied here:

* the sets are broadcast only after their size was measured
  (:func:`measure`); past the bound the join is left to Catalyst/AQE
  (sort-merge with skew splitting, or a runtime broadcast);
* at least one equality between a set column and a source column keeps the
  join a hash join; a range per set (``between``) without a key becomes an
  equality on buckets of the ranges' width (:mod:`ringcast.operators.ranges`).
  Any other predicate without an equality compares every row with every set;
* sets whose plan is more than a scan are stored once, then measured and joined;
* per-set ``LIMIT`` is a ``row_number`` filter, which Spark plans as a
  partial ``WindowGroupLimit`` before the shuffle: a hot set ships at most
  ``n`` rows per task;
* per-set aggregates are partially aggregated before their shuffle, and
  sets without rows are added back from the (small) set table with a count
  of zero.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringcast.functions.tokens import quoted
from ringcast.operators.parsed import compared_columns, table_places, tokens
from ringcast.operators.ranges import BOUNDS, range_join
from ringcast.session import materialize, stored

SET_COL = "param_set"
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024
# Fixed-size types take one 8-byte slot of an UnsafeRow (wide decimals 8 + 16).
FIXED_TYPES = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
               T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType)


@dataclass
class SetSize:
    rows: int
    bytes: int


def measure(params: DataFrame) -> SetSize:
    """Row count and the in-memory bytes of a parameter table, as UnsafeRows.

    Every field takes an 8-byte slot plus a null bit per field; strings and
    binaries add their length, nested values their JSON length. One
    aggregate job, partially aggregated per task (a row limit first would
    funnel the rows into one task).
    """
    nfields = len(params.schema.fields)
    fixed = 8 * nfields + 8 * ((nfields + 63) // 64)
    var_cols = []
    for f in params.schema.fields:
        c = F.col(quoted(f.name))
        if isinstance(f.dataType, FIXED_TYPES):
            continue
        if isinstance(f.dataType, T.DecimalType):
            fixed += 16 if f.dataType.precision > 18 else 0
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            var_cols.append(F.coalesce(F.sum(F.octet_length(c)), F.lit(0)))
        else:  # nested values: their JSON text bounds their size
            var_cols.append(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(c)))), F.lit(0)))
    exprs = [F.count(F.lit(1)).alias("n")]
    exprs += [c.alias(f"v{i}") for i, c in enumerate(var_cols)]
    row = params.agg(*exprs).first()
    n = int(row["n"])
    var_bytes = sum(int(row[f"v{i}"]) for i in range(len(var_cols)))
    return SetSize(n, n * fixed + var_bytes)


def maybe_broadcast(params: DataFrame, policy="auto",
                    max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Broadcast hint for ``params`` when its measured size is under ``max_bytes``."""
    if policy is False or policy == "never":
        return params, False
    size = measure(params)
    if size.bytes <= max_bytes:
        return F.broadcast(params), True
    return params, False


def with_set_ids(params: DataFrame, set_col: str = SET_COL, stable: bool = True) -> DataFrame:
    """Give every parameter row its own id, so repeated sets stay apart.

    An existing ``set_col`` is used as is: its values must be unique (rows
    sharing an id are one set for per-set limits and aggregates).

    Ids come from ``monotonically_increasing_id``; with ``stable`` the table
    is written to the shared checkpoint folder right after, so every later
    use (and every retried task) sees the same ids.
    """
    if set_col in params.columns:
        return params
    numbered = params.withColumn(set_col, F.monotonically_increasing_id())
    if stable:
        numbered = materialize(numbered, "sets")
    return numbered


def _key_pairs(on) -> list[tuple[str, str]]:
    if on is None:
        return []
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(k, k) for k in on]


def _join(source: DataFrame, params: DataFrame, on, condition, broadcast,
          max_broadcast_bytes, between=None) -> DataFrame:
    """Source (alias ``s``) joined with the sets (alias ``p``) on keys and condition."""
    pairs = _key_pairs(on)
    for pcol, scol in pairs:
        if pcol not in params.columns:
            raise ValueError(f"parameter column {pcol!r} missing")
        if scol not in source.columns:
            raise ValueError(f"source column {scol!r} missing")
    extra = F.expr(condition) if isinstance(condition, str) else condition
    params = stored(params, "sets")
    if between is not None:
        column, low, high, *bounds = between
        bounds = bounds[0] if bounds else "[]"
        if not pairs:  # a range per set: an equality on buckets, the predicate on top
            joined = range_join(source, params, column, low, high, bounds,
                                lambda sets: maybe_broadcast(sets, broadcast, max_broadcast_bytes)[0])
            return joined if extra is None else joined.filter(extra)
        over, under = BOUNDS[bounds]
        inside = F.expr(f"s.{quoted(column)} {over} p.{quoted(low)} AND s.{quoted(column)} {under} p.{quoted(high)}")
        extra = inside if extra is None else inside & extra
    p, _ = maybe_broadcast(params, broadcast, max_broadcast_bytes)
    cond = None
    for pcol, scol in pairs:
        eq = F.col("s." + quoted(scol)) == F.col("p." + quoted(pcol))
        cond = eq if cond is None else cond & eq
    if extra is not None:
        cond = extra if cond is None else cond & extra
    if cond is None:
        raise ValueError("a fan-out needs a key or a condition between set and source columns")
    return source.alias("s").join(p.alias("p"), cond, "inner")


def fanout(source: DataFrame, params: DataFrame, on=None, condition: str | Column | None = None,
           set_col: str | None = None, keep_params: bool = False, broadcast="auto",
           max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, between=None) -> DataFrame:
    """Rows of ``source`` matched by each parameter set (multiset union).

    ``on``: key column names shared by both sides, or ``{param_col: source_col}``.
    ``condition``: extra predicate in SQL over the aliases ``s`` (source) and
    ``p`` (parameters), e.g. ``"s.value > p.min_value"``.
    ``between``: ``(source column, low column, high column[, bounds])`` of each
    set's range, bounds one of ``[] [) (] ()``; without ``on`` it is joined by
    buckets, so it does not compare every row with every set.
    ``set_col``: a parameter column copied to the output (the set's id).
    """
    joined = _join(source, params, on, condition, broadcast, max_broadcast_bytes, between)
    cols = [F.col("s." + quoted(c)) for c in source.columns]
    if set_col is not None:
        if set_col in source.columns:
            raise ValueError(f"the source already has a column {set_col!r}; pass set_col=...")
        cols.append(F.col("p." + quoted(set_col)).alias(set_col))
    if keep_params:
        cols += [F.col("p." + quoted(c)).alias(f"p_{c}") for c in params.columns if c != set_col]
    return joined.select(*cols)


def _order_cols(order_by) -> list[Column]:
    if order_by is None:
        raise ValueError("order_by is required: a per-set limit needs a total order")
    items = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    return [F.col(c) if isinstance(c, str) else c for c in items]


def fanout_limit(source: DataFrame, params: DataFrame, n: int, order_by, on=None,
                 condition=None, set_col: str = SET_COL, **kw) -> DataFrame:
    """``LIMIT n`` applied per parameter set (F8), first ``n`` by ``order_by``."""
    if n < 0:
        raise ValueError("limit must be >= 0")
    numbered = with_set_ids(params, set_col)
    rows = fanout(source, numbered, on, condition, set_col=set_col, **kw)
    w = Window.partitionBy(set_col).orderBy(*_order_cols(order_by))
    return (rows.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") <= n).drop("__rn"))


def fanout_aggregate(source: DataFrame, params: DataFrame, aggs: Mapping[str, Column],
                     on=None, condition=None, set_col: str = SET_COL,
                     empty: Mapping[str, object] | None = None, keep_params: bool = True,
                     broadcast="auto", max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                     between=None) -> DataFrame:
    """Aggregates evaluated once per parameter set.

    ``aggs`` see the source columns by name and the set's columns as
    ``p_<name>`` (a per-set query sees the table and its bound values).
    Every set yields exactly one row, also when it matches nothing: its
    aggregates are then ``empty[name]`` (null when not given; use 0 for
    counts, as a per-set ``COUNT(*)`` would return).
    """
    numbered = with_set_ids(params, set_col)
    clash = [name for name in aggs if name in numbered.columns]
    if clash:
        raise ValueError(f"aggregate names {clash} are also parameter columns; rename them")
    joined = _join(source, numbered, on, condition, broadcast, max_broadcast_bytes, between)
    set_tmp = "__set"
    pcols = {f"p_{c}": c for c in numbered.columns if c != set_col}
    clash = [c for c in list(pcols) + [set_tmp] if c in source.columns]
    if clash:
        raise ValueError(f"source columns {clash} clash with the per-set names")
    rows = joined.select(*[F.col("s." + quoted(c)) for c in source.columns],
                         *[F.col("p." + quoted(c)).alias(alias) for alias, c in pcols.items()],
                         F.col("p." + quoted(set_col)).alias(set_tmp))
    per_set = (rows.groupBy(set_tmp).agg(*[expr.alias(name) for name, expr in aggs.items()])
               .withColumnRenamed(set_tmp, set_col))
    sets = numbered if keep_params else numbered.select(set_col)
    out = sets.join(per_set, set_col, "left")
    fills = {k: v for k, v in (empty or {}).items() if v is not None}
    cols = [F.col(quoted(c)) for c in sets.columns]
    for name in aggs:
        c = F.col(quoted(name))
        if name in fills:
            c = F.coalesce(c, F.lit(fills[name]))
        cols.append(c.alias(name))
    return out.select(*cols)


def fanout_count(source: DataFrame, params: DataFrame, on=None, condition=None,
                 count_col: str | None = None, set_col: str = SET_COL, name: str = "cnt",
                 broadcast="auto", max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                 keep_params: bool = True, between=None) -> DataFrame:
    """``SELECT COUNT(*)`` (or ``COUNT(col)``) per parameter set; 0 when empty.

    With key equality only, the source is counted per key first (partial
    aggregation: a hot key ships one row per task) and the per-key counts are
    joined to the sets, so overlapping or repeated sets never multiply source
    rows. When the sets are small enough to broadcast, a semi join with their
    distinct keys drops other rows before counting. With a residual condition
    the rows are joined and counted per set.
    """
    pairs = _key_pairs(on)
    if condition is None and between is None and pairs:
        return _count_per_key(source, params, pairs, count_col, set_col, name, keep_params,
                              broadcast, max_broadcast_bytes)
    expr = F.count(F.lit(1)) if count_col is None else F.count(F.col(quoted(count_col)))
    return fanout_aggregate(source, params, {name: expr}, on, condition, set_col,
                            empty={name: 0}, keep_params=keep_params, broadcast=broadcast,
                            max_broadcast_bytes=max_broadcast_bytes, between=between)


def _count_per_key(source, params, pairs, count_col, set_col, name, keep_params,
                   broadcast, max_broadcast_bytes):
    numbered = with_set_ids(params, set_col)
    if name in numbered.columns:
        raise ValueError(f"count name {name!r} is also a parameter column; pass name=...")
    scols = [s for _, s in pairs]
    key_rows = numbered.select(*[F.col(quoted(p)).alias(s) for p, s in pairs])
    # the key columns of all sets bound their distinct keys: no extra distinct job
    _, is_b = maybe_broadcast(key_rows, broadcast, max_broadcast_bytes)
    keys = key_rows.distinct()
    keys = F.broadcast(keys) if is_b else keys
    rows = source.join(keys, scols, "left_semi") if is_b else source
    counted = F.count(F.lit(1)) if count_col is None else F.count(F.col(quoted(count_col)))
    per_key = rows.groupBy(*[F.col(quoted(c)) for c in scols]).agg(counted.alias("__n"))
    cond = None
    for pcol, scol in pairs:
        eq = F.col("p." + quoted(pcol)) == F.col("k." + quoted(scol))
        cond = eq if cond is None else cond & eq
    joined = numbered.alias("p").join(per_key.alias("k"), cond, "left")
    keep = [F.col("p." + quoted(c)) for c in (numbered.columns if keep_params else [set_col])]
    return joined.select(*keep, F.coalesce(F.col("k.__n"), F.lit(0)).cast("bigint").alias(name))


def latest_per_key(df: DataFrame, keys, order_by, n: int = 1) -> DataFrame:
    """First ``n`` rows per key in ``order_by`` order (F11, clustering order)."""
    key_cols = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*key_cols).orderBy(*_order_cols(order_by))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def param_table(spark: SparkSession, rows: Sequence, schema) -> DataFrame:
    """A parameter table from literal sets (library callers, positional or named)."""
    return spark.createDataFrame(list(rows), schema)


def run_query(spark: SparkSession, sql: str, args=None,
              tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One query, optionally with one parameter set.

    ``args`` is a dict for named markers (``:name``) or a list for positional
    markers (``?``); Spark binds them as literals.
    """
    from ringcast.operators.transform import transform

    return transform(spark, None, sql, tables, args=args)


PARAMS_VIEW = "__params"
# In a query text with a range per set: the sets' id, and the ends of a row's own set.
SET_ID, LOW_END, HIGH_END = "__ring_set", "__ring_low", "__ring_high"


def bind_markers(sql: str, params_alias: str = PARAMS_VIEW) -> tuple[str, list[str]]:
    """Replace markers by columns of the parameter row: ``:uid`` becomes
    ``__params.uid`` and the i-th ``?`` becomes ``__params.p{i}``. Returns the
    text and the parameter columns it uses. Markers are what Spark's lexer cuts as
    ``?``, or as ``:`` right before a word and not right after one."""
    used: list[str] = []
    out: list[str] = []
    position, at = 0, 0
    found = tokens(sql)
    for i, t in enumerate(found):
        name, stop = None, t.stop
        if t.hidden:
            continue
        if t.text == "?":
            name, position = f"p{position}", position + 1
        elif t.text == ":" and i + 1 < len(found):
            word, before = found[i + 1].text, sql[t.start - 1:t.start]
            if (word[0].isalpha() or word[0] == "_") and not (before.isalnum() or before in ("_", ":") and before):
                name, stop = word, found[i + 1].stop
        if name is None:
            continue
        if name not in used:
            used.append(name)
        out += [sql[at:t.start], f"{params_alias}.`{name}`"]
        at = stop
    return "".join(out) + sql[at:], used


def _lateral_text(body: str, set_col: str | None = None) -> str:
    head = f"{PARAMS_VIEW}.`{set_col}` AS `{set_col}`, " if set_col else ""
    return f"SELECT {head}__q.* FROM {PARAMS_VIEW} AS {PARAMS_VIEW}, LATERAL ({body}\n) AS __q"


def infer_markers(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame] | None = None,
                  declared: Mapping[str, str] | None = None) -> dict[str, str]:
    """Parameter-file types of a text's markers, as a prepared statement would
    have them: the text is analysed with untyped markers, and each one gets the
    type of what it is compared with. A marker without a type, or with more than
    one, is an error that names it, unless ``declared`` states its type; declared
    markers that the text does not use are kept."""
    from ringcast.operators.parsed import marker_types
    from ringcast.operators.transform import check_query_text, transform
    from ringcast.sources.params import marker_type

    body, used = bind_markers(check_query_text(sql))
    declared = dict(declared or {})
    if not set(used) - set(declared):
        return declared
    found: dict[str, set[str]] = {}
    # the analyzer drops an untyped marker that is compared with text, so comparisons
    # with text are read off a second pass, in which every marker is text
    for kind in ("void", "string"):
        row = spark.range(1).select(*[F.lit(None).cast(kind).alias(name) for name in used])
        seen = marker_types(transform(spark, None, _lateral_text(body), {PARAMS_VIEW: row, **dict(tables or {})}))
        for name, types in seen.items():
            types = types if kind == "void" else types & {"string"}
            if types:
                found.setdefault(name, set()).update(types)
    found = {name: types for name, types in found.items() if name not in declared}
    none = [name for name in used if name not in found and name not in declared]
    if none:
        raise ValueError(f"no type to be read from the query for markers {none}; declare them")
    many = {name: sorted(found[name]) for name in found if len({marker_type(t) for t in found[name]}) > 1}
    if many:
        raise ValueError(f"ambiguous markers, compared with several types: {many}; declare them")
    return {name: declared.get(name) or marker_type(min(found[name])) for name in used} | declared


def _reduced(spark: SparkSession, body: str, params: DataFrame, tables: Mapping[str, DataFrame], found,
             broadcast, max_broadcast_bytes) -> tuple[str, DataFrame, dict[str, DataFrame]]:
    """The text, sets and tables of a per-set query with each table cut to what
    its sets can ask for (``found``: the query's marker predicates).

    * A column that must equal a marker, below a LIMIT or aggregate: the table is
      semi-joined with the sets' distinct values, before anything is ranked or
      counted. Rows without an asked key pass the query's own filter for no set.
    * A column between two markers, each named once, and no equality: the table is
      range-joined with the sets by buckets, its rows keep their set's two ends,
      and the text asks for its own set's rows: an equality in the place of a
      comparison of every row with every set.
    """
    tables, params = dict(tables), stored(params, "sets")
    names = {name.lower(): name for name in tables}
    equal, ranged = {}, {}
    for c in found:
        name = names.get(c.table.lower())
        if name is None:
            continue
        if c.operator == "=":
            equal.setdefault(name, {}).setdefault(c.column, (c.marker, c.cut))
        else:
            low = c.operator in (">", ">=")
            ranged.setdefault(name, {}).setdefault(c.column, {}).setdefault("low" if low else "high", c)
    for name, columns in equal.items():
        if any(cut for _, cut in columns.values()):
            pairs = list(columns.items())
            keys = params.select(*[F.col(quoted(marker)).alias(f"__k{i}") for i, (_, (marker, _)) in enumerate(pairs)])
            small = maybe_broadcast(keys, broadcast, max_broadcast_bytes)[1]
            keys = F.broadcast(keys.distinct()) if small else keys.distinct()
            same = [F.col("s." + quoted(column)) == F.col(f"k.__k{i}") for i, (column, _) in enumerate(pairs)]
            tables[name] = tables[name].alias("s").join(keys.alias("k"), same, "left_semi")
    for name, columns in ranged.items():
        ends = [(column, e["low"], e["high"]) for column, e in columns.items() if len(e) == 2]
        if name in equal or not ends:
            continue
        column, low, high = ends[0]
        places = table_places(spark, body, name)
        ends = [f"{PARAMS_VIEW}.`{c.marker}`" for c in (low, high)]
        if len(places) != 1 or {SET_ID, LOW_END, HIGH_END} & set(tables[name].columns) or any(body.count(e) != 1 for e in ends):
            continue
        bounds = ("[" if low.operator == ">=" else "(") + ("]" if high.operator == "<=" else ")")
        sets = params if SET_ID in params.columns else with_set_ids(params, SET_ID)
        try:
            joined = range_join(tables[name], sets, column, low.marker, high.marker, bounds,
                                lambda some: maybe_broadcast(some, broadcast, max_broadcast_bytes)[0])
        except ValueError:  # a text column, or types that only the query's own casts compare
            continue
        params = sets
        tables[name] = joined.select(*[F.col("s." + quoted(c)) for c in tables[name].columns], F.col("p." + SET_ID),
                                     F.col("p." + quoted(low.marker)).alias(LOW_END), F.col("p." + quoted(high.marker)).alias(HIGH_END))
        start, stop, aliased = places[0]
        own = f"(SELECT * EXCEPT ({SET_ID}) FROM `{name}` WHERE `{name}`.{SET_ID} = {PARAMS_VIEW}.{SET_ID})"
        body = body[:start] + own + ("" if aliased else f" AS `{name}`") + body[stop:]
        body = body.replace(ends[0], LOW_END).replace(ends[1], HIGH_END)
        break  # one range per text; places of further tables have moved
    return body, params, tables


def query_fanout(spark: SparkSession, sql: str, params: DataFrame,
                 tables: Mapping[str, DataFrame] | None = None,
                 set_col: str | None = None, broadcast="auto",
                 max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Run a query text once per parameter row and concatenate the rows.

    The text keeps the reference's markers (``:name``, or ``?`` bound to
    columns ``p0, p1, ...``) and is evaluated as a LATERAL subquery per
    parameter row. Catalyst decorrelates it: equality on a marker becomes a
    hash join (broadcast when the parameter table is small), ``LIMIT`` a
    per-set ``WindowGroupLimit``, aggregates a per-set aggregate that keeps
    sets without rows (``COUNT(*)`` = 0). Repeated sets repeat their rows.

    Before that the analysed text is asked which columns of ``tables`` its markers
    bind. Below a ``LIMIT`` or an aggregate a table is semi-joined with the sets'
    distinct keys, so only asked keys are ranked or counted; a table whose rows are
    only bound by a range per set is range-joined by buckets (:func:`_reduced`).
    ``broadcast`` and ``max_broadcast_bytes`` govern these two joins; the strategy of
    the final join is Spark's size-based choice, since join hints do not survive the
    decorrelation of a LATERAL subquery. Markers in other predicates only compare
    every set with every row.
    """
    from ringcast.operators.transform import check_query_text, transform

    body, used = bind_markers(check_query_text(sql))
    have = {c.lower() for c in params.columns}
    missing = [c for c in used if c.lower() not in have]
    if missing:
        raise ValueError(f"parameter columns missing for markers: {missing}")
    tables = dict(tables or {})
    out = transform(spark, None, _lateral_text(body, set_col), {PARAMS_VIEW: params, **tables})
    found = compared_columns(out) if tables else []
    if any(c.cut or c.operator != "=" for c in found):
        reduced, sets, cut = _reduced(spark, body, params, tables, found, broadcast, max_broadcast_bytes)
        try:
            out = transform(spark, None, _lateral_text(reduced, set_col), {PARAMS_VIEW: sets, **cut}).drop(LOW_END, HIGH_END)
        except AnalysisException:  # the ends have no place in the text's shape: as it was
            if reduced == body:
                raise
    return out
