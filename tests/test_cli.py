import json

import pytest

from ringcast.cli import build_parser, main
from ringcast.sources.table import Tables

from conftest import SF_SMALL


def test_token_range_command(spark, tmp_out, capsys):
    Tables(spark, SF_SMALL).orders.write.parquet(tmp_out + "/data/ks/orders")
    main(["-o", tmp_out + "/o.parquet", "-s", "token-range", "ks.orders", "-K", "o_orderkey",
          "-c", "o_orderkey,o_totalprice", "-S", "64", "-C", "24", "--root", tmp_out + "/data"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows"] == Tables(spark, SF_SMALL).orders.count()
    assert spark.read.parquet(tmp_out + "/o.parquet").columns == ["o_orderkey", "o_totalprice"]


def test_query_command_with_params_and_transform(spark, tmp_out, capsys):
    with open(tmp_out + "/p.ndjson", "w") as f:
        f.write('{"st":"F"}\n{"st":"O"}\n')
    main(["-o", tmp_out + "/q.ndjson", "-T", "SELECT COUNT(*) AS n FROM source", "query",
          "SELECT * FROM orders WHERE o_orderstatus = :st", "--params", tmp_out + "/p.ndjson",
          "--markers", "st:text", "--table", f"orders={SF_SMALL}/orders.parquet"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows"] == 1 and out["format"] == "ndjson"
    n = spark.read.json(tmp_out + "/q.ndjson").first().n
    assert n == Tables(spark, SF_SMALL).orders.filter("o_orderstatus IN ('F', 'O')").count()


def test_single_file_and_partitions_conflict():
    with pytest.raises(SystemExit):
        build_parser().parse_args(["-o", "x", "-s", "-b", "a", "token-range", "k.t", "-K", "id"])
