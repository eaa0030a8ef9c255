"""Live database sources (optional; need a connector on the cluster).

Two Spark-native ways to read a wide-column table directly:

* the Cassandra connector data source (``org.apache.spark.sql.cassandra``),
  which already splits the scan by token ranges of the database's own ring;
* JDBC with one predicate per ring range (``spark.read.jdbc(predicates=...)``),
  one Spark partition per range, for databases that expose ``TOKEN()`` through
  a JDBC driver.

Neither connector is installed here, so these are not exercised end to end;
the predicate builder is tested on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ringcast.functions.tokens import range_bounds
from ringcast.sources.table import split_table_name

CASSANDRA_FORMAT = "org.apache.spark.sql.cassandra"


class ConnectorMissing(RuntimeError):
    pass


def read_cassandra(spark: SparkSession, name: str, columns=None, options: dict | None = None) -> DataFrame:
    """``keyspace.table`` through the Cassandra connector (token-range splits,
    column pruning and key predicates are pushed to the database by it)."""
    keyspace, table = split_table_name(name)
    try:
        df = (spark.read.format(CASSANDRA_FORMAT).options(keyspace=keyspace, table=table)
              .options(**(options or {})).load())
    except Exception as exc:  # the data source is not on the classpath
        if "DATA_SOURCE_NOT_FOUND" in str(exc) or "ClassNotFound" in str(exc):
            raise ConnectorMissing("the Cassandra connector is not installed on this cluster") from exc
        raise
    return df.select(*columns) if columns else df


def token_range_predicates(partition_keys, splits: int) -> list[str]:
    """One ``TOKEN(pk) >= lo AND TOKEN(pk) < hi`` predicate per ring range (the
    last range closed), for ``spark.read.jdbc(predicates=...)``."""
    keys = [partition_keys] if isinstance(partition_keys, str) else list(partition_keys)
    if not keys:
        raise ValueError("at least one partition key column is required")
    tok = f"TOKEN({', '.join(keys)})"
    out = []
    for _, start, end, inclusive in range_bounds(splits):
        out.append(f"{tok} >= {start} AND {tok} {'<=' if inclusive else '<'} {end}")
    return out


def read_jdbc_ranges(spark: SparkSession, url: str, name: str, partition_keys, splits: int,
                     properties: dict | None = None) -> DataFrame:
    """A table read over JDBC as ``splits`` partitions, one per token range."""
    keyspace, table = split_table_name(name)
    return spark.read.jdbc(url, f"{keyspace}.{table}",
                           predicates=token_range_predicates(partition_keys, splits),
                           properties=properties or {})
