"""Registered queries that go through storage: each writes under a fresh
folder inside the shared checkpoint directory, then returns the read-back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gold, scd2
from ..operators.quality import order_rules, quality_gate
from ..operators.silver import silver_orders
from ..session import delete_path, scratch_path, scratch_scope, shuffles_freed, staged
from ..sinks.incremental_fact import IncrementalFact
from ..sinks.scd2_store import Scd2Store
from ..sinks.star import arranged, create_star, export_dim, load_table, load_verified
from ..sinks.transactions import append_new, read_transactions
from ..sinks.versioned import VersionedTable
from ..sources.bronze import read_bronze, write_bronze
from ..sources.fixtures import AS_OF_1, AS_OF_2, ITEMS_BATCH_DATE, bronze
from ..sources.schemas import CUSTOMERS, FACT_SALES, PRODUCTS
from ..streaming.fact import write_fact_stream
from ..streaming.ingest import ingest
from . import pipeline as P


def _bronze_csv(spec):
    def q(spark, sf):
        """Every customer or part dropped as dated CSV, read back through the dated glob with the declared schema."""
        root = scratch_path(spark, "bronze")
        write_bronze(bronze(spark, sf, f"{spec.name}_all"), root, spec.name, "20250303")
        return scd2.standardize(read_bronze(spark, root, spec.name, "20250303"), spec)
    return q


def _store(spec):
    def q(spark, sf):
        store = Scd2Store(spark, scratch_path(spark, f"silver-{spec.name}"), spec)
        store.apply(P.entity_batch(spark, sf, spec, 1), AS_OF_1)
        store.apply(P.entity_batch(spark, sf, spec, 2), AS_OF_2)
        return store.read()
    return q


def q_append_idempotent(spark, sf):
    """The orders batch appended twice; the second append finds every key loaded."""
    path = scratch_path(spark, "silver-orders")
    rows = P.orders_silver(spark, sf)
    append_new(rows, path, "order_id")
    append_new(rows, path, "order_id")
    return read_transactions(spark, path, rows.schema)


def q_append_resent(spark, sf):
    """The orders batch, then its rows again under another partition value: every key is loaded."""
    path = scratch_path(spark, "silver-orders")
    rows = P.orders_silver(spark, sf)
    append_new(rows, path, "order_id")
    append_new(rows.withColumn("partition_date", F.lit("resent")), path, "order_id")
    return read_transactions(spark, path, rows.schema)


def q_quarantine_resent(spark, sf):
    """The gate's rejected orders quarantined, and again by a later run: nothing is written twice, keys or not."""
    path = scratch_path(spark, "quarantine")
    for as_of in (AS_OF_1, AS_OF_2):
        _, rejected = quality_gate(silver_orders(bronze(spark, sf, "orders_faulty"), as_of), order_rules())
        append_new(rejected, path, "order_id", partition_by="order_year_month")
    return spark.read.schema(rejected.schema).parquet(path).select("order_id", "customer_id", "order_amount", "failed_rules", "processing_timestamp")


def q_dim_exported(spark, sf):
    """dim_customer exported as one plain file, and read back."""
    path = scratch_path(spark, "dim-export")
    dim = gold.dim_customer(P.entity_v2(spark, sf, CUSTOMERS), AS_OF_2)
    export_dim(dim, path, single_file=True)
    return spark.read.schema(dim.schema).parquet(path)


def _stream(entity, batch_date, build):
    def q(spark, sf):
        root = scratch_path(spark, "bronze")
        frame = bronze(spark, sf, entity)
        write_bronze(frame, root, entity, batch_date, part="0001", compression="gzip")
        write_bronze(frame, root, entity, batch_date, part="0002", compression="gzip")   # the same drop delivered twice
        target = scratch_path(spark, f"silver-{entity}")
        ingest(spark, root, entity, target, scratch_path(spark, "stream-ckpt"), AS_OF_1)
        return read_transactions(spark, target, build(spark, sf).schema)
    return q


def q_fact_published(spark, sf):
    """Fact written partitioned by order_date_key through a staged version, read back (17 columns)."""
    table = VersionedTable(spark, scratch_path(spark, "gold-fact"))
    table.publish(P.fact(spark, sf), partition_by=["order_date_key"], as_of=AS_OF_2)
    return table.read()


def fact_drops(spark, sf):
    """Three drops of orders and items: by date, and a late one of orders whose items came before."""
    orders, items = P.orders_silver(spark, sf), P.items_silver(spark, sf)
    late = F.col("order_id") % 200 == 0
    early = F.col("partition_date") < "19950617"
    first = orders.where(early & ~late)
    # an item's id begins with its order's, so the rest is told by the order's id, which is shorter
    held = items.join(first.select("order_id"), "order_id", "left_semi").unionByName(items.where(late))
    rest = items.where(~F.coalesce(late, F.lit(False))).join(first.select("order_id"), "order_id", "left_anti")
    return orders, items, [(first, held), (orders.where(~early & ~late), rest), (orders.where(late), items.limit(0))]


def q_fact_incremental(spark, sf):
    """The fact after three drops, refreshed after each; apart from keys it is a full rebuild."""
    orders, items, drops = fact_drops(spark, sf)
    table = IncrementalFact(spark, scratch_path(spark, "fact-incremental"), orders.schema, items.schema)
    for day, (some_orders, some_items) in zip(("20250301", "20250302", "20250303"), drops):
        table.append_orders(some_orders)
        table.append_items(some_items.withColumn("partition_date", F.lit(day)), day)
        table.refresh(AS_OF_2)
    return table.fact().drop("sales_key")


def q_load_roundtrip(spark, sf):
    """Fact files bulk-loaded by position into the star table, read from the catalog."""
    root = scratch_path(spark, "star")
    db = "star_" + root.rsplit("-", 1)[-1]
    table = VersionedTable(spark, f"{root}/files/fact_sales")
    table.publish(P.fact(spark, sf), partition_by=["order_date_key"], as_of=AS_OF_2)
    create_star(spark, db, f"{root}/tables")
    load_table(spark, table.version_path(table.version()), f"{db}.fact_sales",
               partition_cols=("order_date_key",))
    return spark.table(f"{db}.fact_sales")


def q_verify_load_fact(spark, sf):
    """The fact published and bulk-loaded, each compared by content with what was written; the report of the load."""
    root = scratch_path(spark, "verify")
    db = "verify_" + root.rsplit("-", 1)[-1]
    table = VersionedTable(spark, f"{root}/files/fact_sales")
    table.publish(P.fact(spark, sf).drop("date_partition"), as_of=AS_OF_2, verified=True)
    create_star(spark, db, f"{root}/tables")
    report = load_verified(spark, table.version_path(table.version()), f"{db}.fact_sales")
    return spark.createDataFrame([tuple(report.values())], "rows_written long, rows_read long, columns int")


def q_load_bucketed(spark, sf):
    """Sales by category over the fact and dim_product loaded into tables bucketed by product: joined without an exchange."""
    root = scratch_path(spark, "bucketed")
    db = "bucketed_" + root.rsplit("-", 1)[-1]
    create_star(spark, db, f"{root}/tables", buckets=8)
    products = gold.dim_product(scd2.initial(P.entity_batch(spark, sf, PRODUCTS, "all"), PRODUCTS, AS_OF_1), AS_OF_2)
    tables = {name: VersionedTable(spark, f"{root}/files/{name}") for name in ("dim_product", "fact_sales")}
    tables["dim_product"].publish(products, as_of=AS_OF_2)
    with scratch_scope(spark):
        items, orders = staged(P.items_silver(spark, sf), "items"), staged(P.orders_silver(spark, sf), "orders")     # read once a part
        tables["fact_sales"].publish_parts((arranged(part.drop("date_partition"), FACT_SALES, balanced=True)
                                            for part in gold.fact_parts(items, orders, AS_OF_2)), as_of=AS_OF_2)
    for name, table in tables.items():
        load_table(spark, table.version_path(table.version()), f"{db}.{name}")
        delete_path(spark, table.root)          # the loaded files
    return sales_by_category(spark, db)


def sales_by_category(spark, db):
    fact, product = spark.table(f"{db}.fact_sales"), spark.table(f"{db}.dim_product")
    joined = fact.join(product.select("product_natural_key", "category").hint("shuffle_hash"), "product_natural_key")
    return joined.groupBy("category").agg(F.count(F.lit(1)).alias("n_items"), F.sum("net_amount").alias("net_amount"))


def q_stream_fact(spark, sf):
    """The fact streamed from five dated drops, in two micro-batches each: items before, with and after their orders."""
    files = 2 * spark.sparkContext.defaultParallelism       # a drop is written and read by all tasks, not by one
    target = scratch_path(spark, "fact-stream")
    with scratch_scope(spark):
        _stream_drops(spark, sf, files, target)
    return spark.read.parquet(target)


def _stream_drops(spark, sf, files, target):
    """Drops and checkpoint lie on disk while the stream runs; the drops are its own copy and go as they are read."""
    root = scratch_path(spark, "bronze")
    orders, items = bronze(spark, sf, "orders"), bronze(spark, sf, "order_items")
    third = lambda df, r: df.where(F.col("order_id") % 3 == r)
    for day, entity, frame in (("20250301", "order_items", third(items, 0)), ("20250302", "orders", third(orders, 0).unionByName(third(orders, 1))),
                               ("20250302", "order_items", third(items, 2)), ("20250303", "orders", third(orders, 2)), ("20250304", "order_items", third(items, 1))):
        with shuffles_freed(spark):
            write_bronze(frame.repartition(files), root, entity, day, compression="gzip")
    write_fact_stream(spark, root, target, scratch_path(spark, "stream-ckpt"), AS_OF_2, files_per_trigger=files // 2, partition_by=(), consume=True)


def registry():
    return {
        "bronze_csv_customers": _bronze_csv(CUSTOMERS),
        "bronze_csv_products": _bronze_csv(PRODUCTS),
        "append_resent": q_append_resent,
        "quarantine_resent": q_quarantine_resent,
        "dim_exported": q_dim_exported,
        "scd2_store_customers": _store(CUSTOMERS),
        "scd2_store_products": _store(PRODUCTS),
        "append_idempotent": q_append_idempotent,
        "stream_ingest_orders": _stream("orders", "20250302", P.orders_silver),
        "stream_ingest_order_items": _stream("order_items", ITEMS_BATCH_DATE, P.items_silver),
        "fact_published": q_fact_published,
        "fact_incremental": q_fact_incremental,
        "load_roundtrip": q_load_roundtrip,
        "verify_load_fact": q_verify_load_fact,
        "load_bucketed": q_load_bucketed,
        "stream_fact": q_stream_fact,
    }
