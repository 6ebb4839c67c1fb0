"""Bronze batches derived from the driver's read-only tables.

The recipe SQL is shared verbatim with the DuckDB oracle (FIXTURES.md §B):
table names are ``{placeholders}``. Spark binds them to DataFrames through
``spark.sql(text, **frames)``; the oracle formats them to its view names.
Change groups by ``key % 10``: 1 and 2 edits, 3 cosmetic, 8 missing from
batch 2, 9 first seen in batch 2.
The ``_all`` recipes hold every customer and part, as batch 1 would without the late ones.
The ``_faulty`` recipes hold every order and item, damaged by ``order_id % 97`` so that each quality
rule is broken by some rows, and two rules at once by others.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Batch run times and bronze batch dates of the fixture.
AS_OF_1 = "2025-03-03 00:00:00"
AS_OF_2 = "2025-03-06 00:00:00"
AS_OF_3 = "2025-03-09 00:00:00"
AS_OF_4 = "2025-03-12 00:00:00"
ITEMS_BATCH_DATE = "20250301"

RECIPES = {
    "customers_b1": """
SELECT c_custkey AS customer_id,
       concat('  ', c_name, ' ') AS name,
       concat(c_name, '@Example.com') AS email,
       CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE concat('555-', cast(c_custkey AS varchar(20))) END AS phone,
       concat(cast(c_custkey AS varchar(20)), ' ', c_mktsegment, ' St') AS address,
       n_name AS city
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
WHERE c_custkey % 10 <> 9
""",
    "customers_b2": """
SELECT c_custkey AS customer_id,
       CASE WHEN c_custkey % 10 = 3 THEN upper(c_name) ELSE concat('  ', c_name, ' ') END AS name,
       concat(c_name, '@Example.com') AS email,
       CASE WHEN c_custkey % 50 = 0 THEN NULL
            WHEN c_custkey % 10 = 1 THEN concat('777-', cast(c_custkey AS varchar(20)))
            ELSE concat('555-', cast(c_custkey AS varchar(20))) END AS phone,
       CASE WHEN c_custkey % 10 = 2 THEN 'moved' ELSE concat(cast(c_custkey AS varchar(20)), ' ', c_mktsegment, ' St') END AS address,
       n_name AS city
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
WHERE c_custkey % 10 <> 8
""",
    "products_b1": """
SELECT p_partkey AS product_id, concat(' ', p_name) AS product_name, p_retailprice AS price,
       p_size AS stock_quantity, p_type AS category
FROM {part} WHERE p_partkey % 10 <> 9
""",
    "products_b2": """
SELECT p_partkey AS product_id, concat(' ', p_name) AS product_name,
       CASE WHEN p_partkey % 10 = 1 THEN p_retailprice + 1 ELSE p_retailprice END AS price,
       CASE WHEN p_partkey % 10 = 2 THEN p_size + 1 ELSE p_size END AS stock_quantity,
       CASE WHEN p_partkey % 10 = 3 THEN lower(p_type) ELSE p_type END AS category
FROM {part} WHERE p_partkey % 10 <> 8
""",
    "orders": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
       o_orderstatus AS status, o_orderpriority AS payment_method,
       cast(cast(o_totalprice AS decimal(18,2)) * 0.01 AS decimal(18,2)) AS shipping_cost,
       cast(o_totalprice AS decimal(18,2)) AS order_total
FROM {orders}
""",
    "order_items": """
SELECT concat_ws('-', cast(l_orderkey AS varchar(20)), cast(l_linenumber AS varchar(20)),
                 cast(l_partkey AS varchar(20)), cast(l_suppkey AS varchar(20)),
                 cast(cast(l_extendedprice AS decimal(18,2)) AS varchar(30))) AS order_item_id,
       l_orderkey AS order_id, l_partkey AS product_id, cast(l_quantity AS int) AS quantity,
       cast(p_retailprice AS decimal(18,2)) AS unit_price,
       cast(round(l_discount * 100) AS decimal(5,2)) AS discount_pct,
       cast(cast(p_retailprice AS decimal(18,2)) * cast(l_quantity AS int) AS decimal(18,2)) AS subtotal
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
""",
}

# Batch 3 takes batch 2's phones (1) back, edits others (4) and misses 5; batch 4 repeats batch 3's edits, edits 5 and takes 4 back for every
# other key.
RECIPES["customers_b3"] = RECIPES["customers_b1"].replace(
    "ELSE concat('555-', cast(c_custkey AS varchar(20))) END AS phone",
    "WHEN c_custkey % 10 = 4 THEN concat('888-', cast(c_custkey AS varchar(20))) ELSE concat('555-', cast(c_custkey AS varchar(20))) END AS phone") \
    .replace("c_custkey % 10 <> 9", "c_custkey % 10 <> 5")
RECIPES["customers_b4"] = RECIPES["customers_b1"].replace(
    "ELSE concat('555-', cast(c_custkey AS varchar(20))) END AS phone",
    "WHEN c_custkey % 20 = 4 OR c_custkey % 10 = 5 THEN concat('888-', cast(c_custkey AS varchar(20))) "
    "ELSE concat('555-', cast(c_custkey AS varchar(20))) END AS phone").replace("c_custkey % 10 <> 9", "c_custkey % 10 <> 6")
RECIPES["customers_all"] = RECIPES["customers_b1"].replace("WHERE c_custkey % 10 <> 9", "")
RECIPES["products_all"] = RECIPES["products_b1"].replace("WHERE p_partkey % 10 <> 9", "")
RECIPES["orders_faulty"] = """
SELECT CASE WHEN order_id % 97 = 1 THEN NULL ELSE order_id END AS order_id,
       CASE WHEN order_id % 97 IN (2, 7) THEN NULL ELSE customer_id END AS customer_id,
       CASE WHEN order_id % 97 = 3 THEN NULL ELSE order_date END AS order_date,
       status, payment_method, shipping_cost,
       CASE WHEN order_id % 97 = 4 THEN cast(0 AS decimal(18,2)) WHEN order_id % 97 = 5 THEN NULL
            WHEN order_id % 97 IN (6, 7) THEN cast(-5 AS decimal(18,2)) ELSE order_total END AS order_total
FROM (""" + RECIPES["orders"] + ") AS o"
RECIPES["order_items_faulty"] = """
SELECT CASE WHEN order_id % 97 = 1 THEN NULL ELSE order_item_id END AS order_item_id,
       CASE WHEN order_id % 97 = 2 THEN NULL ELSE order_id END AS order_id,
       CASE WHEN order_id % 97 = 3 THEN NULL ELSE product_id END AS product_id,
       CASE WHEN order_id % 97 = 4 THEN 0 WHEN order_id % 97 = 5 THEN NULL ELSE quantity END AS quantity,
       CASE WHEN order_id % 97 = 6 THEN cast(-1 AS decimal(18,2)) ELSE unit_price END AS unit_price,
       CASE WHEN order_id % 97 IN (7, 9) THEN cast(101 AS decimal(5,2)) ELSE discount_pct END AS discount_pct,
       CASE WHEN order_id % 97 IN (8, 9) THEN cast(-1 AS decimal(18,2)) ELSE subtotal END AS subtotal
FROM (""" + RECIPES["order_items"] + ") AS i"


def _tables_of(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One bronze batch as a lazy DataFrame over the driver tables."""
    text = RECIPES[name]
    frames = {t: driver_table(spark, sf_dir, t) for t in _tables_of(text)}
    return spark.sql(text, **frames)


def recipe_sql(name: str) -> str:
    """The same recipe as plain SQL over views named like the driver tables."""
    text = RECIPES[name]
    return text.format(**{t: t for t in _tables_of(text)}).strip()
