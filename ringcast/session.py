"""Session defaults and the shared scratch folder.

Settings are the ones the export semantics rely on: UTC session time, ANSI
arithmetic, AQE with skew-join splitting. ``scratch_path`` hands out a fresh
folder under the cluster's shared ``spark.checkpoint.dir``; a folder of our own
is set only when the session has none (as in tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # per-set LIMIT n keeps its partial (pre-shuffle) limit up to this n
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "ringcast", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Settings that can change on a running session (the rest need a new JVM).
STATIC_CONF = ("spark.ui.enabled",)


def apply_defaults(spark: SparkSession) -> None:
    """Apply the session-level defaults to an existing session (spark-submit)."""
    for key, value in DEFAULT_CONF.items():
        if key not in STATIC_CONF:
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder from the session's settings.

    A machine-local folder is created only in local mode (tests, one
    machine); on a cluster an unset ``spark.checkpoint.dir`` is an error,
    since executors and driver must see the same files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="ringcast-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str = "out") -> str:
    """A fresh, unused path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/ringcast-{label}-{uuid.uuid4().hex[:12]}"


def materialize(df, label: str = "table"):
    """Cut lineage: write ``df`` as Parquet under the shared checkpoint folder
    and return the written table. One job; later reads are columnar and never
    recompute ``df`` (a lost executor re-reads files, it does not re-run the
    plan)."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    table = spark.read.parquet(path)
    table.stored_at = path
    return table


# Plan nodes over files or literal rows that read the same rows on every run.
_REPEATABLE = ("Project", "Filter", "LogicalRelation", "LocalRelation", "Range", "OneRowRelation")


def is_repeatable(df) -> bool:
    """True when ``df`` only selects from files or literal rows, so that running it
    again gives the same rows in the same partitions at no more than a scan's cost."""
    def visit(node) -> bool:
        if node.getClass().getSimpleName().rstrip("$") not in _REPEATABLE or not node.deterministic():
            return False
        children = node.children()
        return all(visit(children.apply(i)) for i in range(children.length()))

    return visit(df._jdf.queryExecution().optimizedPlan())


def stored(df, label: str = "table"):
    """``df`` itself where it is repeatable, else written once and read back."""
    return df if is_repeatable(df) else materialize(df, label)


def dealt(df, by: str | None = None):
    """Rows dealt evenly to as many tasks as there are cores at least. A scan with
    as many splits stays as it is; one with fewer is dealt by a hash of its row
    numbers (``by``, if it has them), which a repeated task numbers alike; any
    other plan in turn, which Spark makes repeatable by sorting each task's rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if by is None and not is_repeatable(df):
        return df.repartition(cores)
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return df
    if by is not None:
        return df.repartition(cores, by)
    return df.withColumn("__dealt", F.monotonically_increasing_id()).repartition(cores, "__dealt").drop("__dealt")


def cluster_conf(total_cores: int, input_bytes: int | None = None) -> dict[str, str]:
    """Settings for a large export cluster (pass to ``build_session(extra=...)``
    or ``spark-submit --conf``).

    * file splits of 256 MB: fewer, larger scan tasks, and part files of a
      similar size after compression;
    * shuffle partitions: about 3 per core, at least enough for ~256 MB per
      partition of the input when its size is known; AQE coalesces small ones;
    * rebalance/skew targets of 256 MB, so Hive partitions get files of that
      order and a hot value is split into pieces of that size;
    * skew-join splitting on, broadcast threshold kept at 32 MB, the same bound
      the fan-out applies after measuring parameter sets.
    """
    parts = 3 * max(1, total_cores)
    if input_bytes:
        # ~256 MB per partition if the whole input were shuffled
        parts = max(parts, int(input_bytes // (256 * 1024 * 1024)) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    }


def cleanup_scratch(spark: SparkSession) -> int:
    """Delete this application's ``ringcast-*`` folders under the checkpoint
    folder (parsed parameter tables, set ids, staged outputs). Call it when the
    job's outputs are written: DataFrames still reading those folders break.
    Returns the number of folders removed."""
    base = spark.sparkContext.getCheckpointDir()
    if not base:
        return 0
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return 0
    removed = 0
    for status in fs.listStatus(root):
        if status.getPath().getName().startswith("ringcast-"):
            fs.delete(status.getPath(), True)
            removed += 1
    return removed
