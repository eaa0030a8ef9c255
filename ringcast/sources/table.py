"""Addressing a source table and the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed names of the test tables.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def split_table_name(name: str) -> tuple[str, str]:
    """``keyspace.table`` split at the first dot; no dot is an error."""
    if "." not in name:
        raise ValueError(f"table must be given as {{keyspace}}.{{table}}, got {name!r}")
    keyspace, table = name.split(".", 1)
    if not keyspace or not table:
        raise ValueError(f"table must be given as {{keyspace}}.{{table}}, got {name!r}")
    return keyspace, table


def load_table(spark: SparkSession, name: str, root: str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """A ``keyspace.table`` source: a catalog table, or ``{root}/{keyspace}/{table}``."""
    keyspace, table = split_table_name(name)
    if root is None:
        return spark.table(f"`{keyspace}`.`{table}`")
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{keyspace}/{table}")


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_test_table(self._spark, self._dir, name)

    def register(self, *names: str) -> None:
        for n in names or TABLES:
            read_test_table(self._spark, self._dir, n).createOrReplaceTempView(n)
