"""Give the executors' Python workers this package's source."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

from ringcast.sinks.writer import remove_path

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the workers once per application (``addPyFile``), so
    tasks import it wherever it is installed on the driver."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="ringcast-src-"), "ringcast_src.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def drop(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete stored tables (of ``materialize``) that nothing reads any more."""
    for table in tables:
        remove_path(spark, table.stored_at)


def let_go(spark: SparkSession, *tables: DataFrame) -> None:
    """After a step is stored: delete the stored tables that only it read, and have
    the driver collect what it no longer refers to, so that Spark's cleaner drops
    that step's shuffle files now, not some time later."""
    drop(spark, *tables)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
