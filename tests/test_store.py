"""Storage paths: staged SCD2 store, failure mid-merge, re-runs, idempotent append, CSV batches."""

import pytest
from pyspark.sql import functions as F

from starhouse.operators import scd2
from starhouse.session import scratch_path
from starhouse.sinks.scd2_store import Scd2Store
from starhouse.sinks.transactions import append_new, read_transactions
from starhouse.sinks.versioned import VersionedTable
from starhouse.sources.bronze import read_bronze, write_bronze
from starhouse.sources.schemas import BRONZE, CUSTOMERS

T1, T2 = "2025-03-03 00:00:00", "2025-03-06 00:00:00"


def cust(spark, rows):
    return scd2.standardize(spark.createDataFrame(rows, BRONZE["customers"]), CUSTOMERS)


def rows(phone):
    return [(i, "n", "e", phone, "a", "c") for i in range(20)]


def test_store_first_load_merge_and_rerun(spark):
    store = Scd2Store(spark, scratch_path(spark, "t-store"), CUSTOMERS)
    assert store.last_run() is None
    s1 = store.apply(cust(spark, rows("1")), T1, profile=True)
    assert s1.first_load and s1.max_key == 20 and s1.profile == {"new": (20, 20)}
    s2 = store.apply(cust(spark, rows("2")), T2, profile=True)
    assert not s2.first_load and s2.max_key == 40
    assert s2.profile == {"changed": (20, 20), "current": (20, 20)}
    full = store.read()
    assert full.count() == 40 and full.filter("is_current").count() == 20
    store.apply(cust(spark, rows("2")), T2)                     # same batch again
    assert store.read().count() == 40


def test_failure_mid_merge_keeps_target(spark):
    store = Scd2Store(spark, scratch_path(spark, "t-fail"), CUSTOMERS)
    store.apply(cust(spark, rows("1")), T1)
    before = sorted(map(tuple, store.read().collect()))
    bad = cust(spark, rows("2")).withColumn("phone", F.raise_error(F.lit("injected")))
    bad = scd2.standardize(bad.drop("hash_key"), CUSTOMERS)
    with pytest.raises(Exception):
        store.apply(bad, T2)
    assert store.last_run()["version"] == 1
    assert sorted(map(tuple, store.read().collect())) == before
    store.apply(cust(spark, rows("2")), T2)                     # the retried run succeeds
    assert store.read().count() == 40


def test_versioned_publish_ignores_uncommitted(spark):
    t = VersionedTable(spark, scratch_path(spark, "t-ver"))
    t.publish(spark.range(5), as_of=T1)
    with pytest.raises(Exception):
        t.publish(spark.range(5).select(F.raise_error(F.lit("boom")).alias("id")))
    assert t.version() == 1 and t.read().count() == 5


def test_append_twice_is_idempotent(spark):
    path = scratch_path(spark, "t-append")
    df = spark.createDataFrame([(i, str(20250300 + i % 3)) for i in range(30)], "order_id bigint, partition_date string")
    append_new(df, path, "order_id")
    append_new(df, path, "order_id")
    back = read_transactions(spark, path, df.schema)
    assert back.count() == 30
    assert dict(back.dtypes)["partition_date"] == "string"


def test_bronze_csv_dated_glob(spark):
    root = scratch_path(spark, "t-bronze")
    df = spark.createDataFrame([(1, " A ", "e", None, "x", "c"), (2, "b", "e", "p", "y", "c")], BRONZE["customers"])
    write_bronze(df, root, "customers", "20250303", part="0001")
    write_bronze(df, root, "customers", "20250303", part="0002")
    write_bronze(df, root, "customers", "20250304", part="0001")
    got = read_bronze(spark, root, "customers", "20250303")
    assert got.count() == 4 and got.filter(F.col("phone").isNull()).count() == 2


def test_unreadable_target_is_not_a_first_load(spark):
    """D2: only a missing target means first load; any other read failure surfaces."""
    root = scratch_path(spark, "t-bad")
    spark.range(3).selectExpr("CAST(id AS STRING) AS value").write.text(root + "/_commits")  # not a commit log
    with pytest.raises(Exception):
        Scd2Store(spark, root, CUSTOMERS).apply(cust(spark, rows("1")), T1)


def test_inferred_schema_changes_hash_inputs(spark):
    """Why bronze is read with a declared schema: inference makes 10 an int in one batch and 10.0 a double in another."""
    from starhouse.sources.schemas import PRODUCTS
    root = scratch_path(spark, "t-infer")
    a = spark.createDataFrame([(1, "p", "10", 1, "c")], "product_id bigint, product_name string, price string, stock_quantity int, category string")
    b = spark.createDataFrame([(1, "p", "10.0", 1, "c")], "product_id bigint, product_name string, price string, stock_quantity int, category string")
    write_bronze(a, root, "products", "20250303")
    write_bronze(b, root, "products", "20250306")
    h = lambda d, infer: scd2.standardize(read_bronze(spark, root, "products", d, infer=infer), PRODUCTS).first().hash_key
    assert h("20250303", True) != h("20250306", True)        # inferred: int 10 vs double 10.0
    assert h("20250303", False) == h("20250306", False)      # declared double: no false change
