import pytest

from ringcast.functions.tokens import MAX_TOKEN, MIN_TOKEN
from ringcast.sources.database import ConnectorMissing, read_cassandra, token_range_predicates
from ringcast.sources.table import load_table


def test_token_range_predicates():
    preds = token_range_predicates(["a", "b"], 4)
    assert len(preds) == 4
    assert preds[0].startswith(f"TOKEN(a, b) >= {MIN_TOKEN} AND TOKEN(a, b) < ")
    assert preds[-1].endswith(f"<= {MAX_TOKEN}")


def test_cassandra_connector_missing_is_clear(spark):
    with pytest.raises(ConnectorMissing):
        read_cassandra(spark, "ks.tbl")


def test_load_table_from_root(spark, tmp_out):
    spark.range(5).write.parquet(tmp_out + "/ks/t")
    assert load_table(spark, "ks.t", root=tmp_out).count() == 5
    with pytest.raises(ValueError):
        load_table(spark, "nodot", root=tmp_out)


def test_file_sources_are_all_nullable(spark, tmp_out):
    # Every field nullable, keys included; Spark's file sources read that way.
    spark.range(3).write.parquet(tmp_out + "/p")
    assert all(f.nullable for f in spark.read.parquet(tmp_out + "/p").schema.fields)
