"""Silver transforms: decimal money path, null discount, bad dates."""

from decimal import Decimal

import pytest
from pyspark.sql import types as T

from starhouse.operators.silver import silver_order_items, silver_orders

ITEM_SCHEMA = T.StructType([
    T.StructField("order_item_id", T.StringType()), T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()), T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DecimalType(18, 3)), T.StructField("discount_pct", T.DecimalType(5, 2)),
    T.StructField("subtotal", T.DecimalType(18, 2)),
])


def test_half_cent_amounts_round_half_up(spark):
    rows = [(str(i), 1, 1, 1, Decimal(v), Decimal("0"), Decimal("0")) for i, v in
            enumerate(["0.125", "1.005", "2.675", "-0.125"])]
    out = silver_order_items(spark.createDataFrame(rows, ITEM_SCHEMA), "20250301", "2025-03-03 00:00:00")
    got = sorted((r.order_item_id, r.net_amount) for r in out.collect())
    assert [v for _, v in got] == [Decimal("0.13"), Decimal("1.01"), Decimal("2.68"), Decimal("-0.13")]


def test_null_discount_gives_null_net(spark):
    rows = [("a", 1, 1, 2, Decimal("10"), None, Decimal("20"))]
    out = silver_order_items(spark.createDataFrame(rows, ITEM_SCHEMA), "20250301", "2025-03-03 00:00:00")
    assert out.first().net_amount is None


def _orders(spark, date):
    schema = "order_id bigint, customer_id bigint, order_date string, status string, " \
             "payment_method string, shipping_cost double, order_total double"
    return spark.createDataFrame([(1, 2, date, "O", "card", 1.5, 10.0)], schema)


def test_bad_date_errors_by_default(spark):
    with pytest.raises(Exception):
        silver_orders(_orders(spark, "bad"), "2025-03-03 00:00:00").collect()


def test_bad_date_null_on_request(spark):
    out = silver_orders(_orders(spark, "bad"), "2025-03-03 00:00:00", on_bad="null").first()
    assert out.order_date is None and out.partition_date is None


def test_orders_columns(spark):
    out = silver_orders(_orders(spark, "2024-02-29 10:00:00"), "2025-03-03 00:00:00").first()
    assert (out.partition_date, out.order_year_month, out.order_day_of_week) == ("20240229", "2024-02", "Thursday")
    assert out.order_amount == Decimal("10.00")


def test_results_do_not_depend_on_session_zone(spark):
    """D14: wall-clock timestamps (timestamp_ntz) give the same partition, month and weekday in any zone."""
    before = spark.conf.get("spark.sql.session.timeZone")
    out = []
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = silver_orders(_orders(spark, "2024-12-31 23:30:00"), "2025-03-03 00:00:00").first()
            out.append((r.order_date, r.partition_date, r.order_year_month, r.order_day_of_week,
                        r.processing_timestamp))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert out[0] == out[1] == out[2] and out[0][1] == "20241231"
