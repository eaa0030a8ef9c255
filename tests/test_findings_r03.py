"""Steps that grew faster than their input: what their plans and tasks hold."""

import random

from pyspark.sql import functions as F

from ringcast.operators.ranges import range_join
from ringcast.operators.transform import transform
from ringcast.plans.catalog import all_queries
from ringcast.sinks.writer import read_back, write


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_estimate_bound_keeps_no_sketch_per_key(spark, tmp_out):
    rng = random.Random(2)
    rows = [(rng.choice(["A", "N", "R", None]), rng.choice([None, *range(400)])) for _ in range(5000)] + [("X", None)] * 3
    spark.createDataFrame(rows, "l_returnflag string, l_orderkey bigint").write.parquet(f"{tmp_out}/lineitem.parquet")
    got = all_queries()["sql_approx_bound"][0](spark, tmp_out)
    one = transform(spark, spark.read.parquet(f"{tmp_out}/lineitem.parquet"), """
        SELECT l_returnflag, ABS(approx_count_distinct(l_orderkey, 0.01) - COUNT(DISTINCT l_orderkey))
          <= 0.05 * COUNT(DISTINCT l_orderkey) AS within_bound FROM source GROUP BY l_returnflag""")
    assert got.schema == one.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, one.collect())) and got.count() == 5

    def sketch_per_key(df):
        return [line for line in _plan(df).splitlines()
                if "approx_count_distinct" in line and "l_orderkey" in line.split("functions=")[0]]

    assert sketch_per_key(one) and not sketch_per_key(got)


def test_range_join_compares_hardly_more_than_it_finds(spark):
    rng = random.Random(3)
    rows = spark.createDataFrame([(i, rng.uniform(0, 1000)) for i in range(2000)], "i int, x double")
    sets = spark.createDataFrame([(j, lo, lo + w) for j, (lo, w) in enumerate(
        (rng.uniform(0, 1000), rng.choice([0.0, 3.0, 20.0, 65.0, 120.0])) for _ in range(300))], "j int, lo double, hi double")
    want = rows.alias("s").join(sets.alias("p"), F.expr("s.x >= p.lo AND s.x < p.hi")).select("i", "j")
    for place in (lambda some: some, F.broadcast):
        joined = range_join(rows, sets, "x", "lo", "hi", "[)", place)
        assert sorted(joined.select("i", "j").collect()) == sorted(want.collect())
    # the same buckets without the exact predicate: the pairs compared
    places = rows.crossJoin(joined.select("s.__class").distinct()).select(
        "i", "__class", F.floor(F.col("x") * F.pow(F.lit(2.0), -F.col("__class"))).alias("__bucket"))
    pairs = places.join(joined.select("p.j", "p.__class", "p.__bucket").distinct(), ["__class", "__bucket"]).count()
    assert pairs < 1.6 * want.count()


ODD_TEXTS = ["", None, "plain", 'a "quoted" word', '"', '""', 'x"\ny', "line\nbreak", "\n", "\n\n", "a\r\nb", "\r", "lone\rreturn",
             "comma, inside", ' led and "trailed" ', "tab\t", "\\", '\\"', 'end\n"', '"\n"\n"', "é, 漢字\n𝄞", "x\x00y", "#c", "'",
             "<a href=\"x\">\n<b class='y'>\n\n</b>\n</a>", "long " * 300 + "\n" + '"' * 301]


def test_single_csv_is_read_in_splits(spark, tmp_out):
    rng = random.Random(1)
    rows = [(i, rng.choice(ODD_TEXTS), rng.choice(ODD_TEXTS)) for i in range(3000)]
    schema = "page_id bigint, url string, html string"
    df = spark.createDataFrame(rows, schema)
    path = write(df.orderBy("page_id"), f"{tmp_out}/pages.csv", single_file=True)
    whole = read_back(spark, path, schema=df.schema)
    assert whole.rdd.getNumPartitions() == 1
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("300", "4000", "65536"):  # bytes: splits inside a value, inside a record, of many records
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            if size == "300":  # more splits than a test needs: fewer rows
                few = write(df.filter("page_id < 60").orderBy("page_id"), f"{tmp_out}/few.csv", single_file=True)
                got, want = read_back(spark, few, schema=schema), whole.filter("page_id < 60")
            else:
                got, want = read_back(spark, path, schema=df.schema), whole
            assert got.schema == want.schema
            assert got.collect() == want.collect() and want.count() in (60, 3000)
        # a task reads a split, not the file
        assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 4
        assert "Scan csv" in _plan(whole) and "Scan csv" not in _plan(got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
