"""End-to-end jobs: the bronze → silver → gold → star runs, one function per step.

Paths follow ``{root}/{layer}/{table}`` and are always arguments. Every job
is re-runnable: entity merges commit a new version only after it is fully
written, transaction appends skip keys already loaded, gold tables are
published as new versions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, scd2
from ..operators.quality import item_rules, order_rules, quality_gate
from ..operators.silver import silver_order_items, silver_orders
from ..sinks.scd2_store import RunStats, Scd2Store
from ..sinks.star import DIM_WRITE_OPTIONS, create_star, load_table, verify_load
from ..sinks.transactions import append_new, read_transactions
from ..session import scratch_scope, staged
from ..sinks.versioned import VersionedTable
from ..sources.bronze import read_bronze
from ..sources.schemas import BRONZE, ENTITIES



@dataclass(frozen=True)
class Lake:
    root: str

    def path(self, layer: str, table: str = "") -> str:
        return f"{self.root.rstrip('/')}/{layer}" + (f"/{table}" if table else "")


def _silver_schema(spark: SparkSession, entity: str):
    empty = spark.createDataFrame([], BRONZE[entity])
    if entity == "orders":
        return silver_orders(empty, "1970-01-01 00:00:00").schema
    return silver_order_items(empty, "19700101", "1970-01-01 00:00:00").schema


def entity_batch(spark: SparkSession, lake: Lake, entity: str, batch_date: str, as_of: str,
                 on_bad: str = "error", dedupe_order: str | None = None,
                 profile: bool = False) -> RunStats:
    """Merge one dated customers/products drop into its SCD2 history (first run = initial load)."""
    spec = ENTITIES[entity]
    batch = scd2.standardize(read_bronze(spark, lake.path("bronze"), entity, batch_date, on_bad=on_bad), spec)
    if dedupe_order:
        batch = scd2.dedupe_latest(batch, spec, dedupe_order)
    with scratch_scope(spark):      # key positions are dropped once the run is written
        return Scd2Store(spark, lake.path("silver", entity), spec).apply(batch, as_of, profile=profile)


def _drops(spark, lake, entity, batches, on_bad):
    spec = ENTITIES[entity]
    return [(scd2.standardize(read_bronze(spark, lake.path("bronze"), entity, day, on_bad=on_bad), spec), as_of) for day, as_of in batches]


def entity_backfill(spark: SparkSession, lake: Lake, entity: str, batches: list[tuple[str, str]], on_bad: str = "error") -> RunStats:
    """Merge several dated drops, (batch_date, as_of) in order of time, in one run."""
    with scratch_scope(spark):
        return Scd2Store(spark, lake.path("silver", entity), ENTITIES[entity]).apply_all(_drops(spark, lake, entity, batches, on_bad))


def late_entity_batch(spark: SparkSession, lake: Lake, entity: str, batch_date: str, as_of: str,
                      later: list[tuple[str, str]], on_bad: str = "error") -> RunStats:
    """Merge a dated drop as of a time before committed runs; ``later``: their (batch_date, as_of) after that time,
    read from bronze again."""
    (batch, _), *rest = _drops(spark, lake, entity, [(batch_date, as_of), *later], on_bad)
    with scratch_scope(spark):
        return Scd2Store(spark, lake.path("silver", entity), ENTITIES[entity]).apply(batch, as_of, later=rest)


def _gate(rows: DataFrame, rules, lake: Lake, table: str, key: str) -> DataFrame:
    """The good rows; the rejected ones go to quarantine. The batch is parsed once, into a table that both read."""
    good, rejected = quality_gate(staged(rows, "gate"), rules)
    append_new(rejected, lake.path("quarantine", table), key)
    return good


def orders_batch(spark: SparkSession, lake: Lake, batch_date: str, as_of: str,
                 gate: bool = False, on_bad: str = "error", scope: str = "table") -> int:
    """Append one dated orders drop to silver (partitioned by order date); returns the rows written."""
    rows = silver_orders(read_bronze(spark, lake.path("bronze"), "orders", batch_date, on_bad=on_bad),
                         as_of, on_bad=on_bad)
    with scratch_scope(spark):
        if gate:
            rows = _gate(rows, order_rules(), lake, "orders", "order_id")
        return append_new(rows, lake.path("silver", "orders"), "order_id", scope=scope)


def order_items_batch(spark: SparkSession, lake: Lake, batch_date: str, as_of: str,
                      gate: bool = False, scope: str = "table") -> int:
    """Append one dated order-items drop to silver (partitioned by the batch date); returns the rows written."""
    rows = silver_order_items(read_bronze(spark, lake.path("bronze"), "order_items", batch_date),
                              batch_date, as_of)
    with scratch_scope(spark):
        if gate:
            rows = _gate(rows, item_rules(), lake, "order_items", "order_item_id")
        return append_new(rows, lake.path("silver", "order_items"), "order_item_id", scope=scope)


def silver(spark: SparkSession, lake: Lake, entity: str) -> DataFrame:
    if entity in ENTITIES:
        return Scd2Store(spark, lake.path("silver", entity), ENTITIES[entity]).read()
    return read_transactions(spark, lake.path("silver", entity), _silver_schema(spark, entity))


def build_gold(spark: SparkSession, lake: Lake, as_of: str,
               date_range: tuple[str, str] | None = None, verify: bool = False) -> dict:
    """Publish dim_customer, dim_product, dim_date and fact_sales as new versions.

    ``date_range=None`` sizes the date spine to whole years covering the
    orders (so every fact date has a dimension row); otherwise (start, end).
    Returns the version of each table; with ``verify`` also a read-back report
    (rows, columns, schema). The fact comes back with 17 columns: its 16 file
    columns plus the discovered ``order_date_key`` last.
    """
    with scratch_scope(spark):      # the fact's key positions are dropped once it is published
        return _build_gold(spark, lake, as_of, date_range, verify)


def _build_gold(spark, lake, as_of, date_range, verify):
    cust = Scd2Store(spark, lake.path("silver", "customers"), ENTITIES["customers"]).current()
    prod = Scd2Store(spark, lake.path("silver", "products"), ENTITIES["products"]).current()
    orders = silver(spark, lake, "orders")
    items = silver(spark, lake, "order_items")
    dims = {
        "dim_customer": gold.dim_customer(cust, as_of),
        "dim_product": gold.dim_product(prod, as_of),
        "dim_date": (gold.dim_date(spark, as_of, *date_range) if date_range
                     else gold.dim_date_covering(orders, "order_date", as_of)),
    }
    versions = {}
    for name, df in dims.items():
        versions[name] = VersionedTable(spark, lake.path("gold", name)).publish(
            df, options=DIM_WRITE_OPTIONS, as_of=as_of, single_file=name == "dim_date")
    fact = gold.fact_sales(items, orders, as_of)
    versions["fact_sales"] = VersionedTable(spark, lake.path("gold", "fact_sales")).publish(
        fact, partition_by=["order_date_key"], as_of=as_of)
    if verify:
        widths = {**{name: len(df.columns) for name, df in dims.items()}, "fact_sales": len(fact.columns) + ("order_date_key" not in fact.columns)}
        return {name: {"version": v, **verify_load(spark, VersionedTable(spark, lake.path("gold", name)).version_path(v), expected_columns=widths[name])}
                for name, v in versions.items()}
    return versions


def build_dim(spark: SparkSession, lake: Lake, name: str, as_of: str, date_range: tuple[str, str] | None = None,
              single_file: bool = False) -> int:
    """Publish one dimension by itself, compared by content with what is read back; returns its version."""
    with scratch_scope(spark):
        if name == "dim_date":
            rows = gold.dim_date(spark, as_of, *date_range) if date_range else gold.dim_date_covering(silver(spark, lake, "orders"), "order_date", as_of)
        else:
            entity, build = {"dim_customer": ("customers", gold.dim_customer), "dim_product": ("products", gold.dim_product)}[name]
            rows = build(Scd2Store(spark, lake.path("silver", entity), ENTITIES[entity]).current(), as_of)
        return VersionedTable(spark, lake.path("gold", name)).publish(
            rows, options=DIM_WRITE_OPTIONS, as_of=as_of, single_file=single_file or name == "dim_date", verified=True)


def build_fact(spark: SparkSession, lake: Lake, as_of: str) -> int:
    """Publish the fact by itself, compared by content with what is read back; returns its version."""
    with scratch_scope(spark):
        fact = gold.fact_sales(silver(spark, lake, "order_items"), silver(spark, lake, "orders"), as_of)
        return VersionedTable(spark, lake.path("gold", "fact_sales")).publish(
            fact, partition_by=["order_date_key"], as_of=as_of, verified=True)


def refresh_fact(spark: SparkSession, lake: Lake, date_range: tuple[str, str], as_of: str) -> int:
    """Re-run the fact for order dates in ``date_range`` (yyyyMMdd, inclusive), in place.

    Only silver order partitions in the range are read (partition pruning),
    and only the fact's order_date_key partitions they produce are replaced
    (dynamic partition overwrite); every other date is untouched. Refreshed
    rows get keys after the current largest sales_key, so keys stay unique;
    after a refresh they are no longer dense. Dates in the range that no
    longer have rows keep their previous partition.
    """
    table = VersionedTable(spark, lake.path("gold", "fact_sales"))
    top = spark.read.parquet(table.version_path(table.version())).agg(F.max("sales_key")).first()[0] or 0
    orders = silver(spark, lake, "orders")
    items = silver(spark, lake, "order_items")
    with scratch_scope(spark):
        fact = gold.fact_sales(items, orders, as_of, date_range=date_range, key_start=top)
        return table.replace_partitions(fact, ["order_date_key"])


def load_star(spark: SparkSession, lake: Lake, database: str, buckets: int | None = None) -> None:
    """Create the star tables if absent and bulk-load the latest gold versions by position. The tables'
    rows are replaced, so the job can be run again."""
    create_star(spark, database, lake.path("warehouse"), buckets)
    for name in ("dim_customer", "dim_product", "dim_date", "fact_sales"):
        table = VersionedTable(spark, lake.path("gold", name))
        parts = ("order_date_key",) if name == "fact_sales" else ()
        load_table(spark, table.version_path(table.version()), f"{database}.{name}", partition_cols=parts, overwrite=True)
