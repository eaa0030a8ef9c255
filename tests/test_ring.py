import pytest
from pyspark.sql import functions as F

from ringcast.functions.tokens import (MAX_TOKEN, MIN_TOKEN, range_bounds, ring_step, split_id,
                                       split_id_decimal)
from ringcast.operators import ring
from ringcast.sources.table import Tables, split_table_name

from conftest import SF_SMALL

SPLITS = [1, 2, 3, 16, 255, 256, 2400]


@pytest.mark.parametrize("splits", SPLITS)
def test_bounds_cover_ring_without_gaps(splits):
    bounds = range_bounds(splits)
    assert len(bounds) == splits
    assert bounds[0][1] == MIN_TOKEN
    assert bounds[-1][2] == MAX_TOKEN and bounds[-1][3]
    for (_, _, end, incl), (_, start, _, _) in zip(bounds, bounds[1:]):
        assert not incl and end == start


@pytest.mark.parametrize("splits", SPLITS)
def test_split_bounds_frame_matches_python(spark, splits):
    rows = ring.split_bounds(spark, splits).orderBy("split_id").collect()
    assert [(r.split_id, r.token_start, r.token_end, r.end_inclusive) for r in rows] == range_bounds(splits)


@pytest.mark.parametrize("splits", SPLITS + [7, 4801])
def test_split_id_exact_on_edges(spark, splits):
    step = ring_step(splits)
    toks = {MIN_TOKEN, -1, 0, 1, MAX_TOKEN, MAX_TOKEN - 16, MAX_TOKEN - 17}
    for k in range(0, splits, max(1, splits // 50)):
        s = MIN_TOKEN + k * step
        toks |= {s, s - 1, s + 1}
    toks = sorted(t for t in toks if MIN_TOKEN <= t <= MAX_TOKEN)
    df = spark.createDataFrame([(t,) for t in toks], "t long")
    got = df.select("t", split_id("t", splits).alias("a"), split_id_decimal("t", splits).alias("b")).collect()
    for r in got:
        expected = min((r.t - MIN_TOKEN) // step, splits - 1)
        assert r.a == expected and r.b == expected, (splits, r)


@pytest.mark.parametrize("splits", SPLITS)
def test_rows_per_split_sum_to_table(spark, splits):
    li = Tables(spark, SF_SMALL).lineitem
    counts = ring.split_counts(li, ["l_orderkey", "l_linenumber"], splits, include_empty=True)
    assert counts.count() == splits
    assert counts.agg(F.sum("rows")).first()[0] == li.count()


def test_ranges_are_disjoint_and_union_is_table(spark):
    o = Tables(spark, SF_SMALL).orders
    total = 0
    for k in range(16):
        part = ring.scan_split(o, "o_orderkey", 16, k)
        total += part.count()
        # every row of range k is assigned split k, so ranges do not overlap
        again = ring.token_scan(part.drop("token"), "o_orderkey", 16)
        assert again.filter(F.col("split_id") != k).count() == 0
    assert total == o.count()
    scanned = ring.token_scan(o, "o_orderkey", 16)
    bad = scanned.filter((F.col("split_id") < 0) | (F.col("split_id") > 15)).count()
    assert bad == 0


def test_null_keys_are_kept(spark):
    df = spark.createDataFrame([(1, None), (None, None), (2, 3)], "a bigint, b bigint")
    out = ring.token_scan(df, ["a", "b"], 4)
    assert out.count() == 3
    assert out.filter(F.col("split_id").isNull()).count() == 0


def test_splits_must_be_positive(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        ring.token_scan(df, "id", 0)
    with pytest.raises(ValueError):
        ring.scan_split(df, "id", 4, 4)


def test_projection_and_count_only(spark):
    li = Tables(spark, SF_SMALL).lineitem
    cols = ring.token_scan(li, ["l_orderkey"], 8, columns=["l_orderkey", "l_quantity"]).columns
    assert cols == ["l_orderkey", "l_quantity", "token", "split_id"]
    empty = ring.token_scan(li, ["l_orderkey"], 8, columns=[], keep_token=False).drop("split_id")
    assert empty.columns == [] and empty.count() == li.count()


def test_column_pruning_reaches_scan(spark):
    li = Tables(spark, SF_SMALL).lineitem
    plan = ring.split_counts(li, ["l_orderkey", "l_linenumber"], 16)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def test_table_name_split_at_first_dot():
    assert split_table_name("ks.tbl.x") == ("ks", "tbl.x")
    with pytest.raises(ValueError):
        split_table_name("nodot")


def test_token_layout_prunes(spark, tmp_out):
    o = Tables(spark, SF_SMALL).orders
    path = tmp_out + "/layout"
    ring.write_token_layout(o, "o_orderkey", path, 4)
    laid = spark.read.parquet(path)
    part = ring.scan_split(laid, "token", 16, 3, token_method="column")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(token), GreaterThanOrEqual(token," in plan
    assert part.count() == ring.scan_split(o, "o_orderkey", 16, 3).count()


def test_token_layout_splits_a_hot_key(spark, tmp_out):
    li = Tables(spark, SF_SMALL).lineitem
    hot = li.withColumn("k", F.when(F.col("l_orderkey") % 3 == 0, F.lit(42)).otherwise(F.col("l_orderkey")))
    path = tmp_out + "/hot"
    ring.write_token_layout(hot, "k", path, 6)
    per_file = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    biggest = max(r["count"] for r in per_file)
    assert len(per_file) == 6 and biggest < hot.count() / 3


def test_split_id_random_tokens(spark):
    import random

    rng = random.Random(7)
    with pytest.raises(ValueError):
        split_id("t", 2 ** 31)
    for splits in [rng.randint(1, 10 ** 6) for _ in range(6)] + [2 ** 31 - 1, 2 ** 31 - 2]:
        toks = [rng.randint(MIN_TOKEN, MAX_TOKEN) for _ in range(2000)]
        df = spark.createDataFrame([(t,) for t in toks], "t long")
        step = ring_step(splits)
        got = df.select("t", split_id("t", splits).alias("s")).collect()
        assert all(r.s == min((r.t - MIN_TOKEN) // step, splits - 1) for r in got), splits


def test_ring_expressions_stay_in_whole_stage_codegen(spark):
    li = Tables(spark, SF_SMALL).lineitem
    scanned = ring.token_scan(li, ["l_orderkey", "l_linenumber"], 2400,
                              columns=["l_orderkey", "l_quantity"]).filter("l_quantity > 40")
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    lines = [ln for ln in plan.splitlines() if "xxhash64" in ln or "least(" in ln]
    assert lines and all(ln.lstrip(" :+-").startswith("*(") for ln in lines), plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_default_splits_rule(spark):
    # Reference sizing: 300 splits per core when no split count is given.
    n = ring.default_splits(spark)
    assert n == 300 * spark.sparkContext.defaultParallelism
    li = Tables(spark, SF_SMALL).lineitem
    out = ring.token_scan(li, ["l_orderkey", "l_linenumber"])
    assert out.agg(F.max("split_id")).first()[0] < n
