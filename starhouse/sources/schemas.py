"""Schemas and fixed declarations of the retail model.

Bronze is read with explicit types (never inferred: inference turns ``10`` and
``10.0`` into different hash inputs). Entity specs and gold constraints are
fixed values that must equal the modelled pipeline's for identical results.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

DEC18 = T.DecimalType(18, 2)
DEC5 = T.DecimalType(5, 2)

# ---- bronze (explicit schemas, one per entity) ----
BRONZE = {
    "customers": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("city", T.StringType()),
    ]),
    "products": T.StructType([
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("stock_quantity", T.IntegerType()),
        T.StructField("category", T.StringType()),
    ]),
    "orders": T.StructType([
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_date", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("shipping_cost", DEC18),
        T.StructField("order_total", DEC18),
    ]),
    "order_items": T.StructType([
        T.StructField("order_item_id", T.StringType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", DEC18),
        T.StructField("discount_pct", DEC5),
        T.StructField("subtotal", DEC18),
    ]),
}


@dataclass(frozen=True)
class EntitySpec:
    """How one versioned (SCD2) entity is standardised, hashed and keyed."""
    name: str
    key: str
    sk: str
    text_cols: tuple[str, ...]
    hash_cols: tuple[str, ...]
    columns: tuple[str, ...] = field(default=())


# The standardised columns and the change-hash column lists.
# Customers hash name, email, phone, city, phone (phone twice, address not
# hashed, so an address-only edit makes no new version). Products hash
# product_name, price, stock_quantity, category.
CUSTOMERS = EntitySpec(
    name="customers",
    key="customer_id",
    sk="customer_sk",
    text_cols=("name", "email", "phone", "address", "city"),
    hash_cols=("name", "email", "phone", "city", "phone"),
    columns=("customer_id", "name", "email", "phone", "address", "city"),
)
PRODUCTS = EntitySpec(
    name="products",
    key="product_id",
    sk="product_sk",
    text_cols=("product_name", "category"),
    hash_cols=("product_name", "price", "stock_quantity", "category"),
    columns=("product_id", "product_name", "price", "stock_quantity", "category"),
)
ENTITIES = {"customers": CUSTOMERS, "products": PRODUCTS}

# SCD2 open-ended validity and the date spine default range.
FAR_FUTURE = "9999-12-31 23:59:59"
DIM_DATE_START = "2010-01-01"
DIM_DATE_END = "2030-12-31"


@dataclass(frozen=True)
class TableRules:
    """Declared warehouse constraints, checked over data by the audit."""
    table: str
    primary_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...]
    not_null: tuple[str, ...]
    max_bytes: dict
    columns: tuple[tuple[str, str], ...]
    cluster_by: tuple[str, ...] = ()     # distribution key, re-aimed as buckets
    sort_by: tuple[str, ...] = ()        # sort key, re-aimed as sorted buckets
    source: dict = field(default_factory=dict)   # silver column of each renamed column

    def types(self) -> dict[str, str]:
        """Spark type of each declared column; a byte limit is for the audit and the catalog table."""
        return {c: "string" if t.startswith("VARCHAR") else t.lower() for c, t in self.columns}


# Gold star tables, column order, warehouse types, silver columns and constraints.
DIM_CUSTOMER = TableRules(
    table="dim_customer",
    primary_key=("customer_key",),
    unique=(("customer_natural_key",),),
    not_null=("customer_key", "customer_natural_key"),
    max_bytes={"customer_key": 255, "customer_natural_key": 255, "customer_name": 255,
               "email": 255, "phone": 255, "address": 512, "city": 255},
    columns=(("customer_key", "VARCHAR(255)"), ("customer_natural_key", "VARCHAR(255)"),
             ("customer_name", "VARCHAR(255)"), ("email", "VARCHAR(255)"),
             ("phone", "VARCHAR(255)"), ("address", "VARCHAR(512)"), ("city", "VARCHAR(255)"),
             ("row_effective_date", "TIMESTAMP_NTZ"), ("row_expiration_date", "TIMESTAMP_NTZ"),
             ("current_row_flag", "BOOLEAN"), ("etl_processed_date", "TIMESTAMP_NTZ")),
    source={"customer_key": "customer_sk", "customer_natural_key": "customer_id", "customer_name": "name",
            "row_effective_date": "valid_from", "row_expiration_date": "valid_to", "current_row_flag": "is_current"},
)
DIM_PRODUCT = TableRules(
    table="dim_product",
    primary_key=("product_key",),
    unique=(("product_natural_key",),),
    not_null=("product_key", "product_natural_key"),
    max_bytes={"product_key": 255, "product_natural_key": 255, "product_name": 255,
               "category": 255},
    columns=(("product_key", "VARCHAR(255)"), ("product_natural_key", "VARCHAR(255)"),
             ("product_name", "VARCHAR(255)"), ("current_price", "DECIMAL(18,2)"),
             ("stock_quantity", "INT"), ("category", "VARCHAR(255)"),
             ("row_effective_date", "TIMESTAMP_NTZ"), ("row_expiration_date", "TIMESTAMP_NTZ"),
             ("current_row_flag", "BOOLEAN"), ("etl_processed_date", "TIMESTAMP_NTZ")),
    cluster_by=("product_natural_key",),
    sort_by=("product_natural_key",),
    source={"product_key": "product_sk", "product_natural_key": "product_id", "current_price": "price",
            "row_effective_date": "valid_from", "row_expiration_date": "valid_to", "current_row_flag": "is_current"},
)
DIM_DATE = TableRules(
    table="dim_date",
    primary_key=("date_key",),
    unique=(),
    not_null=("date_key", "full_date"),
    max_bytes={"day_name": 9, "month_name": 9},
    columns=(("date_key", "INT"), ("full_date", "DATE"), ("day_of_week", "INT"),
             ("day_name", "VARCHAR(9)"), ("day_of_month", "INT"), ("day_of_year", "INT"),
             ("week_of_year", "INT"), ("month", "INT"), ("month_name", "VARCHAR(9)"),
             ("quarter", "INT"), ("year", "INT"), ("is_weekend", "BOOLEAN"),
             ("is_holiday", "BOOLEAN"), ("etl_processed_date", "TIMESTAMP_NTZ")),
)
FACT_SALES = TableRules(
    table="fact_sales",
    primary_key=("sales_key",),
    unique=(),
    not_null=("sales_key", "order_natural_key", "order_item_natural_key", "order_date_key"),
    max_bytes={"order_natural_key": 255, "order_item_natural_key": 255,
               "customer_natural_key": 255, "product_natural_key": 255,
               "order_status": 50, "payment_method": 50},
    columns=(("sales_key", "BIGINT"), ("order_natural_key", "VARCHAR(255)"),
             ("order_item_natural_key", "VARCHAR(255)"), ("customer_natural_key", "VARCHAR(255)"),
             ("product_natural_key", "VARCHAR(255)"), ("quantity", "INT"),
             ("unit_price", "DECIMAL(18,2)"), ("discount_pct", "DECIMAL(5,2)"),
             ("subtotal", "DECIMAL(18,2)"), ("net_amount", "DECIMAL(18,2)"),
             ("shipping_cost", "DECIMAL(18,2)"), ("total_amount", "DECIMAL(18,2)"),
             ("order_status", "VARCHAR(50)"), ("payment_method", "VARCHAR(50)"),
             ("etl_processed_date", "TIMESTAMP_NTZ"), ("order_date_key", "INT")),
    cluster_by=("product_natural_key",),
    sort_by=("order_date_key", "customer_natural_key"),
    source={"order_natural_key": "order_id", "order_item_natural_key": "order_item_id",
            "customer_natural_key": "customer_id", "product_natural_key": "product_id",
            "total_amount": "order_amount", "order_status": "status"},
)
STAR = {t.table: t for t in (DIM_CUSTOMER, DIM_PRODUCT, DIM_DATE, FACT_SALES)}
