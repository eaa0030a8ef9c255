from ringcast.sources.table import Tables
from ringcast.streaming.incremental import incremental_export, stream_source

from conftest import SF_SMALL


def test_incremental_export_resumes(spark, tmp_out):
    orders = Tables(spark, SF_SMALL).orders
    src, out, ckpt = tmp_out + "/src", tmp_out + "/out.parquet", tmp_out + "/ckpt"
    orders.filter("o_orderkey % 2 = 0").write.parquet(src + "/a")
    schema = orders.schema

    def run():
        stream = stream_source(spark, src + "/*", schema)
        return incremental_export(spark, stream, out, ckpt,
                                  transform="SELECT o_orderkey, o_totalprice FROM source")

    first = run()
    assert first["rows"] == orders.filter("o_orderkey % 2 = 0").count()
    orders.filter("o_orderkey % 2 = 1").write.parquet(src + "/b")
    second = run()
    assert second["rows"] == orders.filter("o_orderkey % 2 = 1").count()
    back = spark.read.parquet(out)
    assert back.count() == orders.count()
    assert back.select("o_orderkey").distinct().count() == orders.count()
