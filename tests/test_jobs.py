"""End to end: dated CSV drops -> silver (SCD2 + appends) -> gold versions -> star tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from starhouse.plans.jobs import Lake, build_gold, entity_batch, load_star, order_items_batch, orders_batch, silver
from starhouse.session import scratch_path
from starhouse.sources.bronze import write_bronze
from starhouse.sources.fixtures import bronze

T1, T2 = "2025-03-03 00:00:00", "2025-03-06 00:00:00"


def test_pipeline_end_to_end(spark):
    lake = Lake(scratch_path(spark, "t-lake"))
    broot = lake.path("bronze")
    write_bronze(bronze(spark, SF_SMALL, "customers_b1"), broot, "customers", "20250303")
    write_bronze(bronze(spark, SF_SMALL, "customers_b2"), broot, "customers", "20250306")
    write_bronze(bronze(spark, SF_SMALL, "products_b1"), broot, "products", "20250303")
    write_bronze(bronze(spark, SF_SMALL, "products_b2"), broot, "products", "20250306")
    write_bronze(bronze(spark, SF_SMALL, "orders"), broot, "orders", "20250302")
    write_bronze(bronze(spark, SF_SMALL, "order_items"), broot, "order_items", "20250301")

    assert entity_batch(spark, lake, "customers", "20250303", T1).first_load
    entity_batch(spark, lake, "customers", "20250306", T2)
    entity_batch(spark, lake, "products", "20250303", T1)
    entity_batch(spark, lake, "products", "20250306", T2)
    orders_batch(spark, lake, "20250302", T1)
    orders_batch(spark, lake, "20250302", T1)                  # re-run: nothing appended twice
    order_items_batch(spark, lake, "20250301", T1, gate=True)

    assert silver(spark, lake, "customers").count() == 165      # 1.1 n, n = 150
    assert silver(spark, lake, "products").count() == 240       # 1.2 n, n = 200
    assert silver(spark, lake, "orders").count() == 1500

    report = build_gold(spark, lake, T2, verify=True)
    assert report["fact_sales"]["rows"] == 6000 and report["fact_sales"]["columns"] == 17
    assert report["dim_customer"]["rows"] == 150
    db = "t_lake_" + lake.root.rsplit("-", 1)[-1]
    load_star(spark, lake, db)
    assert spark.table(f"{db}.dim_customer").count() == 150
    assert spark.table(f"{db}.dim_product").count() == 200
    fact = spark.table(f"{db}.fact_sales")
    assert fact.count() == 6000
    assert fact.columns[-1] == "order_date_key"
    # every fact date has a date-dimension row
    dd = spark.table(f"{db}.dim_date").select("date_key")
    assert fact.join(dd, fact.order_date_key == dd.date_key, "left_anti").count() == 0
    assert fact.agg(F.countDistinct("sales_key")).first()[0] == 6000


def test_refresh_fact_replaces_only_the_date_range(spark):
    import os
    from starhouse.plans.jobs import refresh_fact
    from starhouse.sinks.versioned import VersionedTable
    lake = Lake(scratch_path(spark, "t-refresh"))
    broot = lake.path("bronze")
    for name, entity, day in (("customers_b1", "customers", "20250303"), ("products_b1", "products", "20250303"),
                              ("orders", "orders", "20250302"), ("order_items", "order_items", "20250301")):
        write_bronze(bronze(spark, SF_SMALL, name), broot, entity, day)
    entity_batch(spark, lake, "customers", "20250303", T1)
    entity_batch(spark, lake, "products", "20250303", T1)
    orders_batch(spark, lake, "20250302", T1)
    order_items_batch(spark, lake, "20250301", T1)
    build_gold(spark, lake, T1)
    table = VersionedTable(spark, lake.path("gold", "fact_sales"))
    base = table.version_path(table.version()).replace("file:", "", 1)
    before = {d: os.listdir(os.path.join(base, d)) for d in os.listdir(base) if d.startswith("order_date_key=")}
    n_before = spark.read.parquet(table.version_path(1)).count()
    refresh_fact(spark, lake, ("19950101", "19950131"), T2)
    after = {d: os.listdir(os.path.join(base, d)) for d in os.listdir(base) if d.startswith("order_date_key=")}
    jan = {d for d in before if d.startswith("order_date_key=199501")}
    assert jan and all(set(after[d]) != set(before[d]) for d in jan)              # rewritten
    assert all(after[d] == before[d] for d in before if d not in jan)             # untouched
    fact = spark.read.parquet(table.version_path(1))
    assert fact.count() == n_before
    assert fact.agg(F.countDistinct("sales_key")).first()[0] == n_before          # keys stay unique
    refreshed = fact.filter(F.col("order_date_key") < 19950201)
    assert refreshed.filter(F.col("etl_processed_date") != F.lit(T2).cast("timestamp_ntz")).count() == 0
