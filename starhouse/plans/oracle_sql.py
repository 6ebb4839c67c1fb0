"""DuckDB SQL oracles: the same results written independently as plain SQL.

Used only for verification (the driver runs them on the driver tables).
DuckDB differences handled here: ``dayofweek`` is Sunday = 0, calendar parts
are BIGINT, decimal ``/`` yields double (so the percentage is multiplied by
0.01 as a decimal) and ascending order puts nulls last unless told otherwise.
"""

from __future__ import annotations

from ..sources.fixtures import AS_OF_1, AS_OF_2, AS_OF_3, AS_OF_4, ITEMS_BATCH_DATE, recipe_sql
from ..sources.schemas import (CUSTOMERS, DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, FACT_SALES,
                               FAR_FUTURE, PRODUCTS, EntitySpec, TableRules)


def ts(v: str) -> str:
    return f"TIMESTAMP '{v}'"


def _cte(**parts: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS (\n{v}\n)" for k, v in parts.items())


# ---- silver ----

def orders_silver_sql(recipe: str = "orders") -> str:
    return f"""SELECT order_id, customer_id, CAST(order_date AS TIMESTAMP) AS order_date, status,
       payment_method, shipping_cost, order_total AS order_amount,
       strftime(order_date, '%Y%m%d') AS partition_date,
       strftime(order_date, '%Y-%m') AS order_year_month,
       dayname(order_date) AS order_day_of_week,
       {ts(AS_OF_1)} AS processing_timestamp
FROM ({recipe_sql(recipe)})"""


def items_silver_sql(recipe: str = "order_items") -> str:
    return f"""SELECT order_item_id, order_id, product_id, quantity, unit_price, discount_pct, subtotal,
       CAST(unit_price * quantity * CAST(1 - CAST(discount_pct * 0.01 AS DECIMAL(9,4)) AS DECIMAL(5,4))
            AS DECIMAL(18,2)) AS net_amount,
       {ts(AS_OF_1)} AS processing_timestamp,
       '{ITEMS_BATCH_DATE}' AS partition_date
FROM ({recipe_sql(recipe)})"""


# ---- SCD2 entities ----

def _std_sql(spec: EntitySpec, batch: int) -> str:
    cols = ", ".join(f"lower(trim({c})) AS {c}" if c in spec.text_cols else c for c in spec.columns)
    recipe = f"{spec.name}_all" if batch == "all" else f"{spec.name}_b{batch}"
    inner = f"SELECT {cols} FROM ({recipe_sql(recipe)})"
    hashed = ", ".join(spec.hash_cols)
    return f"SELECT *, sha256(concat_ws('|', {hashed})) AS hash_key FROM ({inner})"


def _merge_ctes(spec: EntitySpec, n: int, as_of: str, p: str = "") -> dict[str, str]:
    """CTEs of the merge of batch n into v{n-1}: s, cur, cls, chg, ins and v, all numbered n."""
    k, sk, old = spec.key, spec.sk, f"{p}v{n - 1}"
    cols = ", ".join(spec.columns)
    ccols = ", ".join(f"c.{c}" for c in spec.columns)
    return {
        f"{p}s{n}": _std_sql(spec, n),
        f"{p}cur{n}": f"SELECT * FROM {old} WHERE is_current",
        f"{p}cls{n}": f"""SELECT b.*,
       CASE WHEN NOT EXISTS (SELECT 1 FROM {p}cur{n} c WHERE c.{k} = b.{k}) THEN 'new'
            WHEN EXISTS (SELECT 1 FROM {p}cur{n} c WHERE c.{k} = b.{k} AND c.hash_key <> b.hash_key) THEN 'changed'
            ELSE 'unchanged' END AS change_type
FROM {p}s{n} b""",
        f"{p}chg{n}": f"SELECT DISTINCT {k} FROM {p}cls{n} WHERE change_type = 'changed'",
        f"{p}ins{n}": f"""SELECT {cols}, hash_key,
       (SELECT coalesce(max({sk}), 0) FROM {old})
         + row_number() OVER (ORDER BY CASE WHEN change_type = 'new' THEN 1 ELSE 0 END,
                                       {k} NULLS FIRST, hash_key) AS {sk},
       true AS is_current, {ts(as_of)} AS valid_from, {ts(FAR_FUTURE)} AS valid_to
FROM {p}cls{n} WHERE change_type <> 'unchanged'""",
        f"{p}v{n}": f"""SELECT {cols}, hash_key, {sk}, is_current, valid_from, valid_to FROM {old} WHERE is_current = false
UNION ALL
SELECT {ccols}, c.hash_key, c.{sk},
       CASE WHEN x.{k} IS NULL THEN c.is_current ELSE false END AS is_current,
       c.valid_from,
       CASE WHEN x.{k} IS NULL THEN c.valid_to ELSE {ts(as_of)} END AS valid_to
FROM {p}cur{n} c LEFT JOIN {p}chg{n} x ON c.{k} = x.{k}
UNION ALL
SELECT * FROM {p}ins{n}""",
    }


def _entity_ctes(spec: EntitySpec, p: str = "") -> dict[str, str]:
    """CTEs s1 (first batch), v1 (initial), those of the merge of batch 2, and cur, cls; names prefixed by ``p``."""
    cols = ", ".join(spec.columns)
    return {
        f"{p}s1": _std_sql(spec, 1),
        f"{p}v1": f"""SELECT {cols}, hash_key,
       row_number() OVER (ORDER BY {spec.key} NULLS FIRST, hash_key) AS {spec.sk},
       true AS is_current, {ts(AS_OF_1)} AS valid_from, {ts(FAR_FUTURE)} AS valid_to
FROM {p}s1""",
        **_merge_ctes(spec, 2, AS_OF_2, p),
        f"{p}cur": f"SELECT * FROM {p}cur2",
        f"{p}cls": f"SELECT * FROM {p}cls2",
    }


def in_order_sql(spec: EntitySpec, with_keys: bool) -> str:
    """The history after batches 1 to 4, merged one by one."""
    ctes = {**_entity_ctes(spec), **_merge_ctes(spec, 3, AS_OF_3), **_merge_ctes(spec, 4, AS_OF_4)}
    return _cte(**ctes) + "\nSELECT * FROM v4" if with_keys else _cte(**ctes) + f"\nSELECT * EXCLUDE ({spec.sk}) FROM v4"


def standardize_sql(spec: EntitySpec) -> str:
    return _std_sql(spec, "all")


def initial_sql(spec: EntitySpec) -> str:
    return _cte(**{**_entity_ctes(spec), "s1": _std_sql(spec, "all")}) + "\nSELECT * FROM v1"


def classify_sql(spec: EntitySpec) -> str:
    return _cte(**_entity_ctes(spec)) + "\nSELECT * FROM cls"


def merge_sql(spec: EntitySpec) -> str:
    return _cte(**_entity_ctes(spec)) + "\nSELECT * FROM v2"


def profile_sql(spec: EntitySpec) -> str:
    k = spec.key
    return _cte(**_entity_ctes(spec)) + f"""
SELECT change_type, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys FROM cls GROUP BY change_type
UNION ALL
SELECT 'current' AS change_type, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys FROM cur"""


# ---- gold ----

def _dim_customer_body(v2: str = "v2") -> str:
    return f"""SELECT CAST(customer_sk AS VARCHAR) AS customer_key,
       CAST(customer_id AS VARCHAR) AS customer_natural_key,
       name AS customer_name, email, phone, address, city,
       valid_from AS row_effective_date, valid_to AS row_expiration_date,
       is_current AS current_row_flag, {ts(AS_OF_2)} AS etl_processed_date
FROM {v2} WHERE is_current"""


def _dim_product_body(v2: str = "v2") -> str:
    return f"""SELECT CAST(product_sk AS VARCHAR) AS product_key,
       CAST(product_id AS VARCHAR) AS product_natural_key,
       product_name, CAST(price AS DECIMAL(18,2)) AS current_price,
       CAST(stock_quantity AS INTEGER) AS stock_quantity, category,
       valid_from AS row_effective_date, valid_to AS row_expiration_date,
       is_current AS current_row_flag, {ts(AS_OF_2)} AS etl_processed_date
FROM {v2} WHERE is_current"""


def dim_customer_sql() -> str:
    return _cte(**_entity_ctes(CUSTOMERS)) + "\n" + _dim_customer_body()


def dim_product_sql() -> str:
    return _cte(**_entity_ctes(PRODUCTS)) + "\n" + _dim_product_body()


def _dim_date_ctes() -> dict[str, str]:
    return {
        "so": orders_silver_sql(),
        "bounds": """SELECT make_date(CAST(year(min(order_date)) AS INTEGER), 1, 1) AS s,
       make_date(CAST(year(max(order_date)) AS INTEGER), 12, 31) AS e
FROM so HAVING min(order_date) IS NOT NULL""",
        "days": """SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP),
                                   INTERVAL 1 DAY)) AS DATE) AS dt FROM bounds""",
        "dd": f"""SELECT CAST(strftime(dt, '%Y%m%d') AS INTEGER) AS date_key,
       dt AS full_date,
       CAST(dayofweek(dt) + 1 AS INTEGER) AS day_of_week,
       dayname(dt) AS day_name,
       CAST(dayofmonth(dt) AS INTEGER) AS day_of_month,
       CAST(dayofyear(dt) AS INTEGER) AS day_of_year,
       CAST(weekofyear(dt) AS INTEGER) AS week_of_year,
       CAST(month(dt) AS INTEGER) AS month,
       monthname(dt) AS month_name,
       CAST(quarter(dt) AS INTEGER) AS quarter,
       CAST(year(dt) AS INTEGER) AS year,
       dayofweek(dt) IN (0, 6) AS is_weekend,
       false AS is_holiday,
       {ts(AS_OF_2)} AS etl_processed_date
FROM days""",
    }


def dim_date_sql() -> str:
    return _cte(**_dim_date_ctes()) + "\nSELECT * FROM dd"


def _fact_ctes() -> dict[str, str]:
    return {
        "si": items_silver_sql(),
        "so": orders_silver_sql(),
        "j": """SELECT si.order_item_id, si.order_id, si.product_id, si.quantity, si.unit_price,
       si.discount_pct, si.subtotal, si.net_amount, so.customer_id, so.order_date,
       so.shipping_cost, so.order_amount, so.status, so.payment_method,
       CAST(year(so.order_date) * 10000 + month(so.order_date) * 100 + day(so.order_date) AS INTEGER) AS dk
FROM si JOIN so ON si.order_id = so.order_id""",
        "fact": f"""SELECT row_number() OVER (ORDER BY dk NULLS FIRST, customer_id NULLS FIRST,
                                  order_id NULLS FIRST, order_item_id NULLS FIRST) AS sales_key,
       CAST(order_id AS VARCHAR) AS order_natural_key,
       order_item_id AS order_item_natural_key,
       dk AS order_date_key,
       CAST(customer_id AS VARCHAR) AS customer_natural_key,
       CAST(product_id AS VARCHAR) AS product_natural_key,
       quantity, unit_price, discount_pct, subtotal, net_amount, shipping_cost,
       order_amount AS total_amount, status AS order_status, payment_method,
       {ts(AS_OF_2)} AS etl_processed_date,
       dk AS date_partition
FROM j""",
    }


def fact_sales_sql() -> str:
    return _cte(**_fact_ctes()) + "\nSELECT * FROM fact"


def fact_incremental_sql() -> str:
    """A full rebuild without keys."""
    return _cte(**_fact_ctes()) + "\nSELECT * EXCLUDE (sales_key) FROM fact"


def verify_load_sql() -> str:
    return _cte(**_fact_ctes()) + f"\nSELECT count(*) AS rows_written, count(*) AS rows_read, CAST({len(FACT_SALES.columns)} AS INTEGER) AS columns FROM fact"


def load_bucketed_sql() -> str:
    return _cte(**_fact_ctes(), p=_std_sql(PRODUCTS, "all")) + """
SELECT p.category, count(*) AS n_items, CAST(sum(net_amount) AS DECIMAL(28,2)) AS net_amount
FROM fact JOIN p ON product_natural_key = CAST(p.product_id AS VARCHAR) GROUP BY p.category"""


def assign_sk_sql() -> str:
    return _cte(si=items_silver_sql()) + """
SELECT order_item_id, product_id,
       1000 + row_number() OVER (ORDER BY product_id NULLS FIRST, order_item_id NULLS FIRST) AS item_key
FROM si"""


def load_roundtrip_sql() -> str:
    cols = ", ".join(c if c != "order_date_key" else "date_partition AS order_date_key"
                     for c, _ in FACT_SALES.columns)
    return _cte(**_fact_ctes()) + f"\nSELECT {cols} FROM fact"


def _failed(rules: dict[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(
        f"CASE WHEN NOT coalesce({cond}, false) THEN '{name}' END" for name, cond in rules.items()) + ")"


ITEM_RULES_SQL = {
    "order_item_id_not_null": "order_item_id IS NOT NULL",
    "order_id_not_null": "order_id IS NOT NULL",
    "product_id_not_null": "product_id IS NOT NULL",
    "quantity_positive": "quantity > 0",
    "unit_price_non_negative": "unit_price >= 0",
    "discount_in_range": "discount_pct BETWEEN 0 AND 100",
    "subtotal_non_negative": "subtotal >= 0",
}
ORDER_RULES_SQL = {
    "order_id_not_null": "order_id IS NOT NULL",
    "customer_id_not_null": "customer_id IS NOT NULL",
    "order_date_not_null": "order_date IS NOT NULL",
    "order_amount_positive": "order_amount > 0",
}


def quality_items_sql() -> str:
    f = _failed(ITEM_RULES_SQL)
    return f"SELECT order_item_id, {f} AS failed_rules, {f} = '' AS passed FROM ({items_silver_sql()})"


def quality_orders_sql() -> str:
    f = _failed(ORDER_RULES_SQL)
    return f"SELECT order_id, {f} AS failed_rules, {f} = '' AS passed FROM ({orders_silver_sql()})"


def quality_split_items_sql() -> str:
    f = _failed(ITEM_RULES_SQL)
    return (f"SELECT order_item_id, order_id, product_id, quantity, {f} AS failed_rules, {f} = '' AS accepted "
            f"FROM ({items_silver_sql('order_items_faulty')})")


def quality_split_orders_sql() -> str:
    f = _failed(ORDER_RULES_SQL)
    return (f"SELECT order_id, customer_id, order_amount, {f} AS failed_rules, {f} = '' AS accepted "
            f"FROM ({orders_silver_sql('orders_faulty')})")


def quarantine_sql() -> str:
    f = _failed(ORDER_RULES_SQL)
    return (f"SELECT order_id, customer_id, order_amount, failed_rules, processing_timestamp FROM ("
            f"SELECT DISTINCT *, {f} AS failed_rules FROM ({orders_silver_sql('orders_faulty')})) WHERE failed_rules <> ''")


def audit_sql(rules: TableRules, src: str) -> str:
    t = rules.table
    parts = []
    for c in rules.not_null:
        parts.append(f"SELECT '{t}' AS table_name, 'not_null' AS check_name, '{c}' AS column_name, "
                     f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM {src}")
    for c, n in rules.max_bytes.items():
        parts.append(f"SELECT '{t}', 'max_bytes', '{c}', "
                     f"CAST(count(*) FILTER (WHERE strlen({c}) > {n}) AS BIGINT) FROM {src}")
    keysets = ([("primary_key", rules.primary_key)] if rules.primary_key else []) + \
              [("unique", u) for u in rules.unique]
    for kind, cols in keysets:
        cl = ", ".join(cols)
        nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
        parts.append(f"SELECT '{t}', '{kind}', '{','.join(cols)}', CAST(coalesce(sum(n), 0) AS BIGINT) "
                     f"FROM (SELECT count(*) AS n FROM {src} WHERE {nn} GROUP BY {cl} HAVING count(*) > 1)")
    return "\nUNION ALL\n".join(parts)


def audit_fact_sql() -> str:
    return _cte(**_fact_ctes()) + "\n" + audit_sql(FACT_SALES, "fact")


def audit_fact_faulty_sql() -> str:
    bad = """SELECT CASE sales_key % 19 WHEN 1 THEN NULL WHEN 3 THEN sales_key - 1 ELSE sales_key END AS sales_key,
       CASE sales_key % 11 WHEN 1 THEN NULL WHEN 2 THEN repeat(order_natural_key, 300) ELSE order_natural_key END AS order_natural_key,
       CASE sales_key % 13 WHEN 1 THEN NULL WHEN 2 THEN repeat(order_item_natural_key, 40) ELSE order_item_natural_key END AS order_item_natural_key,
       CASE WHEN sales_key % 17 = 1 THEN NULL ELSE order_date_key END AS order_date_key,
       CASE WHEN sales_key % 31 = 1 THEN repeat(customer_natural_key, 300) ELSE customer_natural_key END AS customer_natural_key,
       CASE WHEN sales_key % 37 = 1 THEN repeat(product_natural_key, 300) ELSE product_natural_key END AS product_natural_key,
       CASE WHEN sales_key % 29 = 1 THEN repeat(order_status, 60) ELSE order_status END AS order_status,
       CASE WHEN sales_key % 23 = 1 THEN repeat(payment_method, 20) ELSE payment_method END AS payment_method
FROM fact"""
    return _cte(**_fact_ctes(), bad=bad) + "\n" + audit_sql(FACT_SALES, "bad")


def audit_dim_faulty_sql() -> str:
    bad = """SELECT * REPLACE (
       CASE CAST(customer_natural_key AS BIGINT) % 10 WHEN 7 THEN NULL WHEN 0 THEN '0' ELSE customer_key END AS customer_key,
       CASE CAST(customer_natural_key AS BIGINT) % 10 WHEN 6 THEN NULL
            WHEN 4 THEN CAST(CAST(customer_natural_key AS BIGINT) - 1 AS VARCHAR) ELSE customer_natural_key END AS customer_natural_key,
       CASE WHEN CAST(customer_natural_key AS BIGINT) % 10 = 5 THEN repeat(address, 200) ELSE address END AS address)
FROM dc"""
    return _cte(**_entity_ctes(CUSTOMERS), dc=_dim_customer_body(), bad=bad) + "\n" + audit_sql(DIM_CUSTOMER, "bad")


def audit_dims_sql() -> str:
    ctes = {}
    ctes.update(_entity_ctes(CUSTOMERS, "c_"))
    ctes.update(_entity_ctes(PRODUCTS, "p_"))
    ctes["dc"] = _dim_customer_body("c_v2")
    ctes["dp"] = _dim_product_body("p_v2")
    ctes.update(_dim_date_ctes())
    body = "\nUNION ALL\n".join([audit_sql(DIM_CUSTOMER, "dc"), audit_sql(DIM_PRODUCT, "dp"),
                                 audit_sql(DIM_DATE, "dd")])
    return _cte(**ctes) + "\n" + body


def oracles() -> dict[str, str]:
    q = {
        "silver_orders": orders_silver_sql(),
        "silver_order_items": items_silver_sql(),
    }
    for spec in (CUSTOMERS, PRODUCTS):
        q[f"standardize_{spec.name}"] = standardize_sql(spec)
        q[f"scd2_initial_{spec.name}"] = initial_sql(spec)
        q[f"scd2_classify_{spec.name}"] = classify_sql(spec)
        q[f"scd2_merge_{spec.name}"] = merge_sql(spec)
        q[f"scd2_profile_{spec.name}"] = profile_sql(spec)
    q.update({
        "assign_sk": assign_sk_sql(),
        "dim_customer": dim_customer_sql(),
        "dim_product": dim_product_sql(),
        "dim_date": dim_date_sql(),
        "fact_sales": fact_sales_sql(),
        "quality_gate_items": quality_items_sql(),
        "quality_gate_orders": quality_orders_sql(),
        "quality_split_items": quality_split_items_sql(),
        "quality_split_orders": quality_split_orders_sql(),
        "audit_fact": audit_fact_sql(),
        "audit_fact_faulty": audit_fact_faulty_sql(),
        "audit_dim_faulty": audit_dim_faulty_sql(),
        "audit_dims": audit_dims_sql(),
        "bronze_csv_customers": standardize_sql(CUSTOMERS),
        "bronze_csv_products": standardize_sql(PRODUCTS),
        "append_resent": orders_silver_sql(),
        "quarantine_resent": quarantine_sql(),
        "dim_exported": dim_customer_sql(),
        "scd2_store_customers": merge_sql(CUSTOMERS),
        "scd2_store_products": merge_sql(PRODUCTS),
        "append_idempotent": orders_silver_sql(),
        "stream_ingest_orders": orders_silver_sql(),
        "stream_ingest_order_items": items_silver_sql(),
        "scd2_backfill_customers": in_order_sql(CUSTOMERS, True),
        "scd2_back_dated_customers": in_order_sql(CUSTOMERS, False),
        "fact_published": fact_sales_sql(),
        "fact_incremental": fact_incremental_sql(),
        "verify_load_fact": verify_load_sql(),
        "load_bucketed": load_bucketed_sql(),
        "stream_fact": fact_incremental_sql(),
        "load_roundtrip": load_roundtrip_sql(),
    })
    return q
