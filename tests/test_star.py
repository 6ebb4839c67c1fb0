"""Star tables: DDL re-runnable, positional load, VARCHAR limits, constraint audit."""

import pytest

from starhouse.operators.audit import audit
from starhouse.session import scratch_path
from starhouse.sinks.star import create_star, load_table
from starhouse.sources.schemas import DIM_CUSTOMER


def _dim_rows(spark, name="ann"):
    return spark.createDataFrame(
        [("1", "10", name, "e", "p", "a", "c", None, None, True, None),
         ("1", "11", "bob", "e", None, "a", "c", None, None, True, None)],
        "customer_key string, customer_natural_key string, customer_name string, email string, "
        "phone string, address string, city string, row_effective_date timestamp_ntz, "
        "row_expiration_date timestamp_ntz, current_row_flag boolean, etl_processed_date timestamp_ntz")


def test_create_star_twice_and_load_by_position(spark):
    root = scratch_path(spark, "t-star")
    db = "t_star_" + root.rsplit("-", 1)[-1]
    create_star(spark, db, root + "/tables")
    create_star(spark, db, root + "/tables")            # IF NOT EXISTS: no error
    files = root + "/files/dim_customer"
    _dim_rows(spark).write.parquet(files)
    load_table(spark, files, f"{db}.dim_customer")
    assert spark.table(f"{db}.dim_customer").count() == 2


def test_varchar_limit_enforced_on_load(spark):
    root = scratch_path(spark, "t-star2")
    db = "t_star_" + root.rsplit("-", 1)[-1]
    create_star(spark, db, root + "/tables")
    files = root + "/files/dim_customer"
    _dim_rows(spark, name="x" * 256).write.parquet(files)
    with pytest.raises(Exception):
        load_table(spark, files, f"{db}.dim_customer")


def test_audit_reports_violations(spark):
    df = _dim_rows(spark, name="x" * 256)
    got = {(r.check_name, r.column_name): r.violations for r in audit(df, DIM_CUSTOMER).collect()}
    assert got[("primary_key", "customer_key")] == 2
    assert got[("unique", "customer_natural_key")] == 0
    assert got[("max_bytes", "customer_name")] == 1
    assert got[("not_null", "customer_key")] == 0


def test_bucketed_fact_and_product_join_without_exchange(spark):
    root = scratch_path(spark, "t-star3")
    db = "t_star_" + root.rsplit("-", 1)[-1]
    create_star(spark, db, root + "/tables", buckets=4)
    spark.sql(f"""INSERT INTO {db}.fact_sales
        SELECT id, CAST(id AS STRING), CAST(id AS STRING), CAST(id % 7 AS STRING), CAST(id % 20 AS STRING),
               1, 1.00, 0.00, 1.00, 1.00, 0.10, 1.00, 'O', 'card', TIMESTAMP_NTZ '2025-03-06 00:00:00',
               20250101 + CAST(id % 3 AS INT)
        FROM range(200)""")
    spark.sql(f"""INSERT INTO {db}.dim_product
        SELECT CAST(id AS STRING), CAST(id AS STRING), 'p', 1.00, 1, 'c', NULL, NULL, true, NULL
        FROM range(20)""")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table(f"{db}.fact_sales").join(spark.table(f"{db}.dim_product"), "product_natural_key")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        assert j.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
