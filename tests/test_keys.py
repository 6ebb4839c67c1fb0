"""Dense keys: equal to a global row_number, skew-safe, no single-partition exchange over data."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from starhouse.operators.keys import assign_dense_key


def _frame(spark, n=5000, hot=0):
    df = spark.range(n).select(
        F.when(F.col("id") % 97 == 0, F.lit(None)).otherwise((F.col("id") * 7919) % 1013).alias("k"),
        F.col("id").cast("string").alias("tie"))
    if hot:
        df = df.withColumn("k", F.when(F.col("tie").cast("long") < hot, F.lit(5)).otherwise(F.col("k")))
    return df


def test_equals_row_number(spark):
    df = _frame(spark)
    got = assign_dense_key(df, ["k", "tie"], "sk", start=10)
    want = df.withColumn("sk", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_first(), "tie")) + 10)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_dense_and_unique_under_hot_key(spark):
    df = _frame(spark, n=6000, hot=2000)       # one key holds a third of all rows
    got = assign_dense_key(df, ["k", "tie"], "sk", num_partitions=8)
    stats = got.agg(F.min("sk"), F.max("sk"), F.countDistinct("sk"), F.count("*")).first()
    assert tuple(stats) == (1, 6000, 6000, 6000)
    # the hot key is split over several ranges by the trailing order column
    from starhouse.operators.keys import frozen_bounds, range_of, sampled
    keys = df.select("k", "tie")
    bounds = frozen_bounds(sampled(keys, 8), 8)
    sizes = keys.groupBy(range_of(F.struct("k", "tie"), bounds, keys.schema).alias("r")).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2000


def test_ranges_follow_the_bounds(spark):
    """The binary search counts the bounds that are not greater, nulls first, for every number of bounds."""
    from starhouse.operators.keys import frozen_bounds, range_of
    df = spark.createDataFrame([(None, "a"), (None, "b"), (1, None), (1, "b"), (2, "a"), (5, "\"q"), (5, "é"), (9, "")], "k int, tie string")
    rows = sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))
    for n in range(1, 10):
        bounds = frozen_bounds(df, n)
        got = {(r.k, r.tie): r.r for r in df.select("k", "tie", range_of(F.struct("k", "tie"), bounds, df.schema).alias("r")).collect()}
        assert [got[r] for r in rows] == sorted(got.values()) and set(got.values()) <= set(range(len(bounds) + 1))
    assert range_of(F.struct("k"), [], df.schema) is not None


def test_input_runs_once(spark):
    """After the plan has run: one exchange by range, used twice; no exchange besides over rows; one scan of the input."""
    from starhouse.session import scratch_path
    path = scratch_path(spark, "t-keys-input")
    _frame(spark).write.parquet(path)
    got = assign_dense_key(spark.read.parquet(path), ["k", "tie"], "sk", num_partitions=4)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1 and plan.count("FileScan") == 1
    assert "rangepartitioning" not in plan.lower() and plan.count("SinglePartition") == 1     # offsets, a row a range


def test_empty_input(spark):
    df = _frame(spark).limit(0)
    assert assign_dense_key(df, ["k"], "sk").count() == 0


def test_nothing_is_written(spark):
    from starhouse.session import scratch_scope
    with scratch_scope(spark) as created:
        assert assign_dense_key(_frame(spark, n=100), ["k", "tie"], "sk").count() == 100
        assert not created


def test_fact_keys_do_not_depend_on_partitioning(spark):
    """The same rows get the same sales_key whatever the number of range partitions."""
    from conftest import SF_SMALL
    from starhouse.operators.gold import fact_sales
    from starhouse.plans import pipeline as P
    items, orders = P.items_silver(spark, SF_SMALL), P.orders_silver(spark, SF_SMALL)
    runs = []
    for n in (1, 3, 16):
        f = fact_sales(items, orders, "2025-03-06 00:00:00", num_partitions=n)
        runs.append({r.order_item_natural_key: r.sales_key
                     for r in f.select("order_item_natural_key", "sales_key").collect()})
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 6000
