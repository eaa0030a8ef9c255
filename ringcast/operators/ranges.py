"""Range join: rows whose value lies in each set's range (a range per set).

A join on ``value BETWEEN low AND high`` alone compares every row with every set.
Here the ranges are dealt to width classes (powers of four): a range of class k
covers three to nine buckets of its class's width, of which it fills all but the
two at its ends, so the pairs compared are hardly more than the pairs found; a row
lies in one bucket of every class present. Rows and sets join on (class, bucket), an
equality that Spark broadcasts or sorts like any other, and the exact predicate
stays on top. Ranges without an end are one class of a single bucket. A row is
repeated once per class present (at most about sixty, typically a few), a set once
per bucket, and no row once per set.

Beside broadcast sets the rows are dealt to four tasks a core and sorted by their
value in each, since a range join often makes many times the rows it reads: the
tasks finish together, and neighbours find the same sets. Other sets are joined by
sorting; Spark would broadcast them by a size that leaves the buckets out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringcast.functions.convert import epoch_micros_ntz
from ringcast.session import is_repeatable

UNBOUNDED = 10_000
FINER = 3  # log2 of the buckets in the widest range of a class
BOUNDS = {"[]": (">=", "<="), "[)": (">=", "<"), "(]": (">", "<="), "()": (">", "<")}
TIMES = (T.TimestampType, T.TimestampNTZType)


def _number(c: Column, kind: T.DataType, all_ntz: bool) -> Column:
    """A double that never falls where the value rises."""
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, TIMES):
        return (epoch_micros_ntz(c) if all_ntz else F.unix_micros(c.cast("timestamp"))).cast("double")
    raise ValueError(f"a range join needs numbers, dates or timestamps, not {kind.simpleString()}")


def _family(kind: T.DataType) -> str:
    return "time" if isinstance(kind, TIMES) else "date" if isinstance(kind, T.DateType) else \
        "number" if isinstance(kind, T.NumericType) else kind.simpleString()


def _bucket(c: Column, width_class: Column) -> Column:
    return F.when(width_class == UNBOUNDED, F.lit(0).cast("long")).otherwise(F.floor(c * F.pow(F.lit(2.0), -width_class)))


def _spread(source: DataFrame) -> DataFrame:
    """A scan dealt in turn to four tasks a core, unless it has as many splits. (Row
    numbers to deal by would not do: a LATERAL text may hold nothing like them.)"""
    tasks = 4 * source.sparkSession.sparkContext.defaultParallelism
    if not is_repeatable(source) or source._jdf.queryExecution().toRdd().getNumPartitions() >= tasks:
        return source
    return source.repartition(tasks)


def range_join(source: DataFrame, sets: DataFrame, column: str, low: str, high: str, bounds: str = "[]",
               place=lambda sets: sets) -> DataFrame:
    """``source`` (alias s) joined with the rows of ``sets`` (alias p) whose range
    ``low`` .. ``high`` holds ``column``; null ends match nothing. ``sets`` should
    be a stored table: its width classes are read first. ``place`` may return the
    sets with a broadcast hint."""
    if bounds not in BOUNDS:
        raise ValueError(f"bounds must be one of {tuple(BOUNDS)}, got {bounds!r}")
    kinds = [df.schema[c].dataType for df, c in ((source, column), (sets, low), (sets, high))]
    if len({_family(k) for k in kinds}) > 1:
        raise ValueError(f"a range join cannot compare {[k.simpleString() for k in kinds]}")
    all_ntz = all(isinstance(k, T.TimestampNTZType) for k in kinds)
    names = {*source.columns, *sets.columns}
    k, b = "__class", "__bucket"
    if names & {k, b}:
        raise ValueError(f"columns {sorted(names & {k, b})} are reserved")

    def quoted(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    lo, hi = (_number(F.col(quoted(c)), kind, all_ntz) for c, kind in zip((low, high), kinds[1:]))
    # whole values need no bucket below 1; others none below a millionth
    least = 0 if all(isinstance(x, (T.IntegralType, T.DateType, *TIMES)) for x in kinds) else -20
    width = hi - lo
    open_ended = F.isnan(lo) | F.isnan(hi) | (width == float("inf")) | F.isnan(width)
    width_class = F.when(open_ended, F.lit(UNBOUNDED)).otherwise(
        F.greatest(F.coalesce(F.ceil(F.log2(F.when(width > 0, width)) / 2).cast("int") * 2 - FINER, F.lit(least)), F.lit(least)))
    holds = F.col(quoted(low)) <= F.col(quoted(high)) if bounds == "[]" else F.col(quoted(low)) < F.col(quoted(high))
    ranged = sets.filter(holds).withColumn(k, width_class)
    classes = sorted(r[0] for r in ranged.select(k).distinct().collect())
    ranged = ranged.withColumn(b, F.explode(F.sequence(_bucket(lo, F.col(k)), _bucket(hi, F.col(k)))))
    value = _number(F.col(quoted(column)), kinds[0], all_ntz)
    places = F.array(*[F.struct(F.lit(c).alias(k), _bucket(value, F.lit(c)).alias(b)) for c in classes]) if classes \
        else F.array().cast(f"array<struct<{k}: int, {b}: bigint>>")
    placed = place(ranged)
    if placed is ranged:
        placed = ranged.hint("merge")
    else:
        source = _spread(source).sortWithinPartitions(quoted(column))
    rows = source.filter(F.col(quoted(column)).isNotNull()).select("*", F.inline(places))
    over, under = BOUNDS[bounds]
    exact = F.expr(f"s.{quoted(column)} {over} p.{quoted(low)} AND s.{quoted(column)} {under} p.{quoted(high)}")
    same = (F.col(f"s.{k}") == F.col(f"p.{k}")) & (F.col(f"s.{b}") == F.col(f"p.{b}"))
    return rows.alias("s").join(placed.alias("p"), same & exact)
