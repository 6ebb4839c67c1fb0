"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, gold, quality, scd2, scd2_fold
from ..operators.keys import assign_dense_key
from ..operators.silver import silver_order_items, silver_orders
from ..session import staged
from ..sources.fixtures import AS_OF_1, AS_OF_2, AS_OF_3, AS_OF_4, ITEMS_BATCH_DATE, bronze
from ..sources.schemas import CUSTOMERS, DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, FACT_SALES, PRODUCTS
from . import pipeline as P

Query = Callable[[SparkSession, str], DataFrame]


def q_silver_orders(spark, sf):
    return P.orders_silver(spark, sf)


def q_silver_order_items(spark, sf):
    return P.items_silver(spark, sf)


def _standardize(spec):
    def q(spark, sf):
        return P.entity_batch(spark, sf, spec, "all")
    return q


def _initial(spec):
    def q(spark, sf):
        return scd2.initial(P.entity_batch(spark, sf, spec, "all"), spec, AS_OF_1)
    return q


def _classify(spec):
    def q(spark, sf):
        v1 = P.entity_v1(spark, sf, spec)
        current = v1.filter(F.col("is_current") == True)  # noqa: E712
        return scd2.classify(P.entity_batch(spark, sf, spec, 2), current, spec)
    return q


def _merge(spec):
    def q(spark, sf):
        return P.entity_v2(spark, sf, spec)
    return q


def q_scd2_backfill_customers(spark, sf):
    """Three batches merged at once into the history of the first; the same as three single merges."""
    drops = [(P.entity_batch(spark, sf, CUSTOMERS, n), t) for n, t in ((2, AS_OF_2), (3, AS_OF_3), (4, AS_OF_4))]
    return scd2_fold.backfill(P.entity_v1(spark, sf, CUSTOMERS), drops, CUSTOMERS)


def q_scd2_back_dated_customers(spark, sf):
    """Batches 1, 2 and 4, then batch 3 late, between the last two; apart from keys the same as in order."""
    later = P.entity_batch(spark, sf, CUSTOMERS, 4)
    known = staged(P.entity_v2(spark, sf, CUSTOMERS), "entity-v2")      # read several times, and so is the next
    known = staged(scd2_fold.backfill(known, [(later, AS_OF_4)], CUSTOMERS), "entity-known")
    out = scd2_fold.back_dated(known, P.entity_batch(spark, sf, CUSTOMERS, 3), AS_OF_3, [(later, AS_OF_4)], CUSTOMERS)
    return out.drop(CUSTOMERS.sk)


def _profile(spec):
    def q(spark, sf):
        v1 = P.entity_v1(spark, sf, spec)
        current = v1.filter(F.col("is_current") == True)  # noqa: E712
        classified = scd2.classify(P.entity_batch(spark, sf, spec, 2), current, spec)
        return scd2.profile(classified, current, spec)
    return q


def q_assign_sk(spark, sf):
    """Dense item keys from 1001 in (product_id, order_item_id) order."""
    items = P.items_silver(spark, sf).select("order_item_id", "product_id")
    return assign_dense_key(items, ["product_id", "order_item_id"], "item_key", start=1000)


def q_dim_customer(spark, sf):
    return gold.dim_customer(P.entity_v2(spark, sf, CUSTOMERS), AS_OF_2)


def q_dim_product(spark, sf):
    return gold.dim_product(P.entity_v2(spark, sf, PRODUCTS), AS_OF_2)


def q_dim_date(spark, sf):
    """Date dimension over whole years spanning every order date."""
    return gold.dim_date_covering(P.orders_silver(spark, sf), "order_date", AS_OF_2)


def q_fact_sales(spark, sf):
    return P.fact(spark, sf)


def q_quality_gate_items(spark, sf):
    flagged = quality.flag(P.items_silver(spark, sf), quality.item_rules())
    return flagged.select("order_item_id", "failed_rules",
                          (F.col("failed_rules") == "").alias("passed"))


def q_quality_gate_orders(spark, sf):
    flagged = quality.flag(P.orders_silver(spark, sf), quality.order_rules())
    return flagged.select("order_id", "failed_rules",
                          (F.col("failed_rules") == "").alias("passed"))


def _split(df, rules, *keep):
    """Both outputs of the gate in one frame."""
    good, rejected = quality.quality_gate(df, rules)
    return good.select(*keep, F.lit("").alias("failed_rules"), F.lit(True).alias("accepted")).unionByName(
        rejected.select(*keep, "failed_rules", F.lit(False).alias("accepted")))


def q_quality_split_items(spark, sf):
    """The gate's good and rejected rows over items of which some break each rule."""
    items = silver_order_items(bronze(spark, sf, "order_items_faulty"), ITEMS_BATCH_DATE, AS_OF_1)
    return _split(items, quality.item_rules(), "order_item_id", "order_id", "product_id", "quantity")


def q_quality_split_orders(spark, sf):
    """The gate's good and rejected rows over orders of which some break each rule."""
    orders = silver_orders(bronze(spark, sf, "orders_faulty"), AS_OF_1)
    return _split(orders, quality.order_rules(), "order_id", "customer_id", "order_amount")


def _damaged(df, number, **cases):
    """``df`` with columns replaced where ``number`` modulo m leaves r; cases: column -> [(m, r, new value)]."""
    def value(col, changes):
        out = F.col(col)
        for m, r, new in changes:
            out = F.when(F.expr(number) % m == r, F.expr(new)).otherwise(out)
        return out
    return df.withColumns({c: value(c, changes) for c, changes in cases.items()})


def q_audit_fact_faulty(spark, sf):
    """The audit over a fact that breaks every kind of declared constraint."""
    bad = _damaged(P.fact(spark, sf), "sales_key",
                   sales_key=[(19, 1, "CAST(NULL AS BIGINT)"), (19, 3, "sales_key - 1")],
                   order_natural_key=[(11, 1, "CAST(NULL AS STRING)"), (11, 2, "repeat(order_natural_key, 300)")],
                   order_item_natural_key=[(13, 1, "CAST(NULL AS STRING)"), (13, 2, "repeat(order_item_natural_key, 40)")],
                   order_date_key=[(17, 1, "CAST(NULL AS INT)")],
                   customer_natural_key=[(31, 1, "repeat(customer_natural_key, 300)")],
                   product_natural_key=[(37, 1, "repeat(product_natural_key, 300)")],
                   order_status=[(29, 1, "repeat(order_status, 60)")],
                   payment_method=[(23, 1, "repeat(payment_method, 20)")])
    return audit.audit(bad, FACT_SALES)


def q_audit_dim_faulty(spark, sf):
    """The audit over a customer dimension with repeated and missing keys and an over-long address."""
    dim = gold.dim_customer(P.entity_v2(spark, sf, CUSTOMERS), AS_OF_2)
    bad = _damaged(dim, "CAST(customer_natural_key AS BIGINT)",
                   customer_key=[(10, 7, "CAST(NULL AS STRING)"), (10, 0, "'0'")],
                   customer_natural_key=[(10, 6, "CAST(NULL AS STRING)"), (10, 4, "CAST(CAST(customer_natural_key AS BIGINT) - 1 AS STRING)")],
                   address=[(10, 5, "repeat(address, 200)")])
    return audit.audit(bad, DIM_CUSTOMER)


def q_audit_fact(spark, sf):
    return audit.audit(P.fact(spark, sf), FACT_SALES)


def q_audit_dims(spark, sf):
    parts = [
        audit.audit(gold.dim_customer(P.entity_v2(spark, sf, CUSTOMERS), AS_OF_2), DIM_CUSTOMER),
        audit.audit(gold.dim_product(P.entity_v2(spark, sf, PRODUCTS), AS_OF_2), DIM_PRODUCT),
        audit.audit(gold.dim_date_covering(P.orders_silver(spark, sf), "order_date", AS_OF_2), DIM_DATE),
    ]
    return reduce(DataFrame.unionByName, parts)


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        "silver_orders": q_silver_orders,
        "silver_order_items": q_silver_order_items,
    }
    for spec in (CUSTOMERS, PRODUCTS):
        q[f"standardize_{spec.name}"] = _standardize(spec)
        q[f"scd2_initial_{spec.name}"] = _initial(spec)
        q[f"scd2_classify_{spec.name}"] = _classify(spec)
        q[f"scd2_merge_{spec.name}"] = _merge(spec)
        q[f"scd2_profile_{spec.name}"] = _profile(spec)
    q.update({
        "scd2_backfill_customers": q_scd2_backfill_customers,
        "scd2_back_dated_customers": q_scd2_back_dated_customers,
        "assign_sk": q_assign_sk,
        "dim_customer": q_dim_customer,
        "dim_product": q_dim_product,
        "dim_date": q_dim_date,
        "fact_sales": q_fact_sales,
        "quality_gate_items": q_quality_gate_items,
        "quality_gate_orders": q_quality_gate_orders,
        "quality_split_items": q_quality_split_items,
        "quality_split_orders": q_quality_split_orders,
        "audit_fact": q_audit_fact,
        "audit_fact_faulty": q_audit_fact_faulty,
        "audit_dim_faulty": q_audit_dim_faulty,
        "audit_dims": q_audit_dims,
    })
    from .io_queries import registry as io_registry
    q.update(io_registry())
    return q
