"""The flagship job: token-range scan → SQL transform → Parquet → read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ringcast.operators.ring import token_scan
from ringcast.plans.export import export
from ringcast.session import scratch_path
from ringcast.sinks.writer import read_back
from ringcast.sources.table import Tables

FLAGSHIP_SQL = """
SELECT event_type, COUNT(*) AS cnt, CAST(ROUND(TRY_CAST(CAST(AVG(value) AS STRING) AS DECIMAL(38,18)), 6) AS DOUBLE) AS avg_value,
       COUNT(DISTINCT split_id) AS splits_touched
FROM source GROUP BY event_type"""

FLAGSHIP_ORACLE = """
SELECT event_type, COUNT(*) AS cnt, CAST(ROUND(TRY_CAST(CAST(AVG(value) AS STRING) AS DECIMAL(38,18)), 6) AS DOUBLE) AS avg_value,
       COUNT(DISTINCT CAST(LEAST(15, (CAST(((((event_id)::HUGEINT * 6364136223846793005::HUGEINT)
             % '18446744073709551616'::HUGEINT) + '18446744073709551616'::HUGEINT)
             % '18446744073709551616'::HUGEINT - '9223372036854775808'::HUGEINT AS BIGINT)::HUGEINT
             + '9223372036854775808'::HUGEINT) // 1152921504606846975::HUGEINT) AS INTEGER)) AS splits_touched
FROM events GROUP BY event_type"""


def flagship(spark: SparkSession, sf_dir: str, splits: int = 16) -> DataFrame:
    events = Tables(spark, sf_dir).events
    scanned = token_scan(events, "event_id", splits, token_method="multiplicative",
                         keep_token=False)
    out = scratch_path(spark, "flagship") + ".parquet"
    export(spark, scanned, out, transform=FLAGSHIP_SQL, single_file=True)
    return read_back(spark, out)
