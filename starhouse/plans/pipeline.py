"""The retail model as lazy DataFrames over the driver tables (bronze fixture → silver → gold).

Each builder reads the whole driver tables of one scale-factor folder. Run
times are fixed literals so results are reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import gold, scd2
from ..operators.silver import silver_order_items, silver_orders
from ..session import staged
from ..sources.fixtures import AS_OF_1, AS_OF_2, ITEMS_BATCH_DATE, bronze
from ..sources.schemas import EntitySpec


def orders_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_orders(bronze(spark, sf_dir, "orders"), AS_OF_1)


def items_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_order_items(bronze(spark, sf_dir, "order_items"), ITEMS_BATCH_DATE, AS_OF_1)


def entity_batch(spark: SparkSession, sf_dir: str, spec: EntitySpec, n: int | str) -> DataFrame:
    """Batch 1 or 2 of the fixture, standardised; ``all``: every customer or part."""
    if n == "all":
        return scd2.standardize(bronze(spark, sf_dir, f"{spec.name}_all"), spec)
    return scd2.standardize(bronze(spark, sf_dir, f"{spec.name}_b{n}"), spec)


def entity_v1(spark: SparkSession, sf_dir: str, spec: EntitySpec) -> DataFrame:
    """History after the first batch (initial load), written once: what follows reads it several times."""
    return staged(scd2.initial(entity_batch(spark, sf_dir, spec, 1), spec, AS_OF_1), "entity-v1")


def entity_v2(spark: SparkSession, sf_dir: str, spec: EntitySpec) -> DataFrame:
    """History after the second batch is merged into the first."""
    v1 = entity_v1(spark, sf_dir, spec)
    return scd2.merge(v1, entity_batch(spark, sf_dir, spec, 2), spec, AS_OF_2)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_sales(items_silver(spark, sf_dir), orders_silver(spark, sf_dir), AS_OF_2)
