import pytest

from ringcast.operators.transform import TransformError, check_query_text, transform


@pytest.mark.parametrize("sql", ["DROP TABLE x", "CREATE TEMP VIEW v AS SELECT 1", "INSERT INTO t VALUES (1)",
                                 "  ", "-- only a comment", "SET x=1"])
def test_non_queries_refused(sql):
    with pytest.raises(TransformError):
        check_query_text(sql)


@pytest.mark.parametrize("sql", ["SELECT 1", "with a as (select 1) select * from a", "VALUES (1)",
                                 "(SELECT 1)", "/* c */ SELECT 1;", "FROM source SELECT *", "TABLE source"])
def test_queries_accepted(sql):
    assert check_query_text(sql)


def test_source_dropped_and_restored(spark):
    before = spark.range(3)
    before.createOrReplaceTempView("source")
    out = transform(spark, spark.range(10), "SELECT COUNT(*) AS n FROM source")
    assert out.first().n == 10
    assert spark.table("source").count() == 3
    spark.catalog.dropTempView("source")
    out2 = transform(spark, spark.range(4), "SELECT id FROM source")
    assert not any(t.name == "source" for t in spark.catalog.listTables())
    assert out2.count() == 4  # the plan was resolved before the view was dropped


def test_double_quoted_identifiers(spark):
    df = spark.createDataFrame([("a",)], "r_name string")
    assert transform(spark, df, 'SELECT "r_name" AS v FROM source').first().v == "a"
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == "false"


def test_extra_tables_and_none(spark):
    src = spark.range(5)
    other = spark.range(3)
    out = transform(spark, src, "SELECT COUNT(*) AS n FROM source s JOIN other o ON s.id = o.id",
                    tables={"other": other})
    assert out.first().n == 3
    assert transform(spark, src, None) is src


def test_concurrent_transforms_keep_their_source(spark):
    from concurrent.futures import ThreadPoolExecutor

    def job(n):
        out = transform(spark, spark.range(n), "SELECT COUNT(*) AS c FROM source")
        return n, out.first().c

    with ThreadPoolExecutor(4) as pool:
        results = list(pool.map(job, [3, 5, 7, 11, 13, 17, 19, 23]))
    assert all(n == c for n, c in results)


def test_with_dml_refused_but_quoted_words_allowed():
    with pytest.raises(TransformError):
        check_query_text("WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a")
    assert check_query_text("WITH a AS (SELECT 'insert' AS x, `update` FROM b) SELECT * FROM a")


def test_nested_comments_and_quotes(spark):
    assert check_query_text("/* outer /* inner */ still comment */ SELECT 1") == "SELECT 1"
    assert check_query_text("SELECT 'it''s -- not a comment' AS a /* x /* y */ */") == \
        "SELECT 'it''s -- not a comment' AS a"
    out = transform(spark, spark.range(1), "/* a /* b */ c */ SELECT 'x--y' AS v FROM source")
    assert out.first().v == "x--y"
