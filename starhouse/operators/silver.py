"""Silver transaction tables: typed projections of the bronze order batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_timestamp
from ..functions.money import net_amount, to_money, to_pct


def _ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


def silver_orders(df: DataFrame, as_of: str, on_bad: str = "error", keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed orders: ``order_total`` becomes ``order_amount``; partition date, month, weekday added.

    ``keep``: further columns of the batch that pass through.
    """
    typed = df.select(
        F.col("order_id"),
        F.col("customer_id"),
        as_timestamp(F.col("order_date"), on_bad).alias("order_date"),
        F.col("status"),
        F.col("payment_method"),
        to_money("shipping_cost").alias("shipping_cost"),
        to_money("order_total").alias("order_amount"),
        *keep,
    )
    return typed.withColumns({
        "partition_date": F.date_format("order_date", "yyyyMMdd"),
        "order_year_month": F.date_format("order_date", "yyyy-MM"),
        "order_day_of_week": F.date_format("order_date", "EEEE"),
        "processing_timestamp": _ts(as_of),
    })


def silver_order_items(df: DataFrame, batch_date, as_of: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed order items with ``net_amount``; partitioned by the batch date.

    ``batch_date`` is a ``yyyyMMdd`` string or a Column (e.g. taken from the file name).
    ``keep``: further columns of the batch that pass through.
    """
    batch = F.lit(batch_date) if isinstance(batch_date, str) else batch_date
    quantity = F.col("quantity").cast("int")
    unit_price = to_money("unit_price")
    discount = to_pct("discount_pct")
    return df.select(
        F.col("order_item_id"),
        F.col("order_id"),
        F.col("product_id"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
        discount.alias("discount_pct"),
        to_money("subtotal").alias("subtotal"),
        net_amount(unit_price, quantity, discount).alias("net_amount"),
        _ts(as_of).alias("processing_timestamp"),
        batch.alias("partition_date"),
        *keep,
    )
