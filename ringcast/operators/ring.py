"""Token-range scan (S1, T1-T6): split a table over the token ring.

The reference issues one range query per split. On Spark the splits are a
column: one scan hashes the partition key and assigns ``split_id``; parallelism
comes from the input splits, not from the ring. Reading a single range is a
filter on the token, which prunes row groups once the data is laid out in token
order (:func:`write_token_layout`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringcast.functions.tokens import (
    quoted,
    MAX_TOKEN,
    MIN_TOKEN,
    _big,
    check_splits,
    in_range,
    make_token,
    range_bound,
    ring_step,
    split_id,
)
from ringcast.session import is_repeatable, materialize

TOKEN_COL = "token"
SPLIT_COL = "split_id"


def default_splits(spark: SparkSession) -> int:
    """Reference sizing rule: 300 splits per core (T5)."""
    return 300 * max(1, spark.sparkContext.defaultParallelism)


def _check_free(df: DataFrame, *names: str) -> None:
    """The computed columns must not replace data columns of the same name."""
    taken = [n for n in names if n in df.columns]
    if taken:
        raise ValueError(f"the data already has column(s) {taken}; pass other names "
                         "(token_col=..., split_col=...)")


def _all_columns(columns) -> bool:
    return columns is None or columns == "*" or (not isinstance(columns, str)
                                                 and list(columns) == ["*"])


def _column_list(columns) -> list:
    """A projection as a list (one name given as a string is one column)."""
    return [columns] if isinstance(columns, str) else list(columns)


def with_token(df: DataFrame, partition_keys, token_method: str = "xxhash64",
               token_col: str = TOKEN_COL) -> DataFrame:
    return df.withColumn(token_col, make_token(partition_keys, token_method))


def token_scan(df: DataFrame, partition_keys, splits: int | None = None,
               columns=None, token_method: str = "xxhash64",
               keep_token: bool = True, token_col: str = TOKEN_COL,
               split_col: str = SPLIT_COL) -> DataFrame:
    """All rows of ``df`` with their ring token and split (one pass).

    ``columns`` is the projection (default all). Rows with a null key get a
    token from the remaining key columns (xxhash64 skips nulls), so no row is
    lost; the union over all splits is the whole table.
    """
    if splits is None:
        splits = default_splits(df.sparkSession)
    check_splits(splits)
    _check_free(df, token_col, split_col)
    token = make_token(partition_keys, token_method)
    if _all_columns(columns):
        out = df.withColumn(token_col, token)
    else:
        out = df.select(*_column_list(columns), token.alias(token_col))
    out = out.withColumn(split_col, split_id(F.col(token_col), splits))
    return out if keep_token else out.drop(token_col)


def scan_range(df: DataFrame, partition_keys, start: int, end: int,
               end_inclusive: bool = False, columns=None,
               token_method: str = "xxhash64", token_col: str = TOKEN_COL) -> DataFrame:
    """Rows whose token lies in ``[start, end)`` (``[start, end]`` if inclusive).

    With ``token_method="column"`` the partition key is a stored token column
    (as written by :func:`write_token_layout`), so the filter reaches the scan
    and prunes row groups; otherwise the token is computed as ``token_col``.
    """
    if not (MIN_TOKEN <= start <= MAX_TOKEN and MIN_TOKEN <= end <= MAX_TOKEN):
        raise ValueError("token bounds must be signed 64-bit integers")
    if (token_method == "column" and isinstance(partition_keys, (list, tuple))
            and len(partition_keys) == 1 and isinstance(partition_keys[0], str)):
        partition_keys = partition_keys[0]
    token = make_token(partition_keys, token_method)
    if token_method == "column" and isinstance(partition_keys, str):
        token_col = partition_keys  # the stored token column itself
        out = df.filter(in_range(token, start, end, end_inclusive))
    else:
        _check_free(df, token_col)
        out = (df.withColumn(token_col, token)
               .filter(in_range(F.col(quoted(token_col)), start, end, end_inclusive)))
    if not _all_columns(columns):
        cols = _column_list(columns)
        picked = [F.col(quoted(c)) if isinstance(c, str) else c for c in cols]
        out = out.select(*picked, *([] if token_col in cols else [F.col(quoted(token_col))]))
    return out


def scan_split(df: DataFrame, partition_keys, splits: int, index: int, **kw) -> DataFrame:
    """Rows of split ``index`` out of ``splits`` (T3 with T2's bounds)."""
    _, start, end, inclusive = range_bound(check_splits(splits), index)
    return scan_range(df, partition_keys, start, end, inclusive, **kw)


def split_bounds(spark: SparkSession, splits: int, split_col: str = SPLIT_COL) -> DataFrame:
    """One row per split: ``split_id, token_start, token_end, end_inclusive``.

    Built by ``spark.range`` with decimal arithmetic, so it scales to any
    number of splits without a driver-side list.
    """
    splits = check_splits(splits)
    step = ring_step(splits)
    k = F.col("id")
    start = (k.cast("decimal(20,0)") * _big(step, 20) + F.lit(MIN_TOKEN).cast("decimal(20,0)"))
    last = k == F.lit(splits - 1)
    end = F.when(last, F.lit(MAX_TOKEN).cast("decimal(20,0)")).otherwise(start + _big(step, 20))
    return spark.range(splits).select(
        k.cast("int").alias(split_col),
        start.cast("bigint").alias("token_start"),
        end.cast("bigint").alias("token_end"),
        last.alias("end_inclusive"),
    )


def split_counts(df: DataFrame, partition_keys, splits: int, token_method: str = "xxhash64",
                 include_empty: bool = False, split_col: str = SPLIT_COL) -> DataFrame:
    """Rows per split (T4). Only the key columns are read (column pruning);
    the count is partially aggregated before the shuffle, so a hot split costs
    one row per task, not its rows."""
    counted = (df.select(make_token(partition_keys, token_method).alias(TOKEN_COL))
               .select(split_id(F.col(TOKEN_COL), splits).alias(split_col))
               .groupBy(split_col).agg(F.count(F.lit(1)).alias("rows")))
    if not include_empty:
        return counted
    bounds = split_bounds(df.sparkSession, splits, split_col)
    return (bounds.join(counted, split_col, "left")
            .select(split_col, "token_start", "token_end",
                    F.coalesce(F.col("rows"), F.lit(0).cast("bigint")).alias("rows")))


def split_stats(df: DataFrame, partition_keys, splits: int, token_method: str = "xxhash64",
                split_col: str = SPLIT_COL) -> DataFrame:
    """Per split: rows, min and max token (balance check of the ring)."""
    tok = make_token(partition_keys, token_method)
    return (df.select(tok.alias(TOKEN_COL))
            .withColumn(split_col, split_id(F.col(TOKEN_COL), splits))
            .groupBy(split_col)
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.min(TOKEN_COL).alias("min_token"),
                 F.max(TOKEN_COL).alias("max_token")))


MANIFEST = "_ring_manifest"  # a folder that Spark's readers of the layout do not list


def write_token_layout(df: DataFrame, partition_keys, path: str, num_files: int,
                       token_method: str = "xxhash64", mode: str = "errorifexists",
                       token_col: str = TOKEN_COL) -> str:
    """Lay a table out in token order so range reads open only the files of their range.

    ``repartitionByRange`` samples ``(token, row hash, salt)`` to cut
    ``num_files`` balanced ranges. The row hash breaks ties: a partition key
    holding a third of the rows is one token, and without the tiebreaker its rows
    would all land in one range (one task, one huge file); the salt splits rows
    that are equal altogether. A salt must not change when a task runs again: a
    plan that only selects from files numbers its rows alike each time; any other
    plan's rows are stored with their salt first. ``sortWithinPartitions`` gives
    each file tight row-group statistics on the token, and a manifest beside the
    files keeps each one's rows, smallest and largest token.
    """
    if mode not in ("errorifexists", "error", "overwrite"):
        raise ValueError(f"a token layout is written as a whole, not with mode {mode!r}")
    _check_free(df, token_col)
    salt, tie = "__ring_salt", "__ring_tie"
    _check_free(df, salt, tie)
    salted = df.withColumn(salt, F.xxhash64(F.monotonically_increasing_id()))
    salted = salted if is_repeatable(df) else materialize(salted, "salted")
    hashable = [F.to_json(F.struct(quoted(f.name))) if _holds_map(f.dataType) else F.col(quoted(f.name)) for f in df.schema.fields]
    tokens = (salted.withColumn(token_col, make_token(partition_keys, token_method))
              .withColumn(tie, F.xxhash64(*hashable)))
    (tokens.repartitionByRange(num_files, F.col(quoted(token_col)), tie, salt)
     .sortWithinPartitions(token_col).drop(salt, tie)
     .write.mode(mode).parquet(path))
    spark = df.sparkSession
    token = F.col(quoted(token_col))
    per_file = (spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file"))
                .agg(F.count(F.lit(1)).alias("rows"), F.min(token).alias("min_token"), F.max(token).alias("max_token")))
    per_file.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{MANIFEST}")
    return path


def _holds_map(kind) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_holds_map(f.dataType) for f in kind.fields)


def layout_files(spark: SparkSession, path: str) -> DataFrame:
    """The layout's manifest: ``file, rows, min_token, max_token`` (null where all tokens are)."""
    return spark.read.parquet(f"{path.rstrip('/')}/{MANIFEST}")


def read_layout_range(spark: SparkSession, path: str, start: int, end: int, end_inclusive: bool = False,
                      columns=None, token_col: str = TOKEN_COL) -> DataFrame:
    """Rows of a token layout whose token lies in the range. Only the files whose
    tokens meet it are listed and opened (the manifest says which)."""
    meets = (F.col("max_token") >= start) & (F.col("min_token") <= end if end_inclusive else F.col("min_token") < end)
    files = [r.file for r in layout_files(spark, path).filter(meets).select("file").collect()]
    root = path.rstrip("/")
    if files:
        rows = spark.read.parquet(*[f"{root}/{f}" for f in files])
    else:
        rows = spark.read.parquet(root).limit(0)
    return scan_range(rows, token_col, start, end, end_inclusive, columns=columns, token_method="column")


def read_layout_split(spark: SparkSession, path: str, splits: int, index: int, **kw) -> DataFrame:
    """Split ``index`` of ``splits`` of a token layout."""
    _, start, end, inclusive = range_bound(check_splits(splits), index)
    return read_layout_range(spark, path, start, end, inclusive, **kw)


def token_column(partition_keys, token_method: str = "xxhash64") -> Column:
    return make_token(partition_keys, token_method)


__all__ = [
    "TOKEN_COL", "SPLIT_COL", "default_splits", "with_token", "token_scan", "scan_range",
    "scan_split", "split_bounds", "split_counts", "split_stats", "write_token_layout",
    "layout_files", "read_layout_range", "read_layout_split",
    "token_column",
]
