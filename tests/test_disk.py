"""What the star queries keep on disk while they run: one store of a stream's state a task, drops that go as they are read, freed shuffles,
a fact built in slices of dates."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from starhouse.operators import gold
from starhouse.operators.sieve import bits_for
from starhouse.operators.silver import silver_order_items, silver_orders
from starhouse.plans import io_queries as Q
from starhouse.session import SHUFFLE_CLEANUP, scratch_path, shuffles_freed, staged
from starhouse.sinks import transactions
from starhouse.sinks.incremental_fact import IncrementalFact
from starhouse.sinks.transactions import append_new, unseen
from starhouse.sources.bronze import write_bronze
from starhouse.streaming.fact import write_fact_stream

AS_OF = "2025-03-06 00:00:00"


def _bronze(spark, n=40):
    """Orders and two items of each; the last order without a date has no place in a partitioned fact, but in a stream."""
    orders = spark.range(n).select(F.col("id").alias("order_id"), (F.col("id") % 3).alias("customer_id"),
                                   F.expr("CASE WHEN id < 39 THEN timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id % 7 AS INT)) END").alias("order_date"),
                                   F.lit("O").alias("status"), F.lit("cash").alias("payment_method"),
                                   F.lit(1).cast("decimal(18,2)").alias("shipping_cost"), F.col("id").cast("decimal(18,2)").alias("order_total"))
    items = spark.range(2 * n).select(F.format_string("i%05d", "id").alias("order_item_id"), F.expr("id DIV 2").alias("order_id"),
                                      (F.col("id") % 5).alias("product_id"), F.lit(2).alias("quantity"), F.lit(3).cast("decimal(18,2)").alias("unit_price"),
                                      F.lit(10).cast("decimal(5,2)").alias("discount_pct"), F.lit(6).cast("decimal(18,2)").alias("subtotal"))
    return orders, items


def _local(path):
    return path.replace("file:", "", 1)


def _files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(_local(path)) for f in names if f.startswith("part-"))


def test_a_streams_state_is_one_store_a_task_and_read_drops_go(spark):
    orders, items = _bronze(spark)
    root, ckpt, target = (scratch_path(spark, n) for n in ("t-drops", "t-ckpt", "t-fact"))
    write_bronze(items.repartition(4), root, "order_items", "20250301", compression="gzip")
    write_bronze(orders.repartition(4), root, "orders", "20250302", compression="gzip")
    before = len(_files(root))
    write_fact_stream(spark, root, target, ckpt, AS_OF, files_per_trigger=2, partition_by=(), consume=True)
    got = spark.read.parquet(target)
    assert got.count() == 80 and got.where("order_date_key IS NULL").count() == 2 and got.select("order_item_natural_key").distinct().count() == 80
    assert before == 8 and len(_files(root)) <= 4                       # those of the last micro-batch may be left
    stores = [d for d in os.listdir(f"{_local(ckpt)}/state/0/0") if not d.startswith((".", "_")) and os.path.isdir(f"{_local(ckpt)}/state/0/0/{d}")]
    assert not [d for d in stores if d.startswith(("left-", "right-"))]


def test_drops_stay_if_they_are_no_copy(spark):
    orders, items = _bronze(spark)
    root = scratch_path(spark, "t-drops")
    write_bronze(items.repartition(2), root, "order_items", "20250301")
    write_bronze(orders.repartition(2), root, "orders", "20250302")
    before = _files(root)
    write_fact_stream(spark, root, scratch_path(spark, "t-fact"), scratch_path(spark, "t-ckpt"), AS_OF, files_per_trigger=1, partition_by=())
    assert _files(root) == before


def test_shuffle_files_go_with_their_statement(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = blocks.getAllFiles()
        return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}

    before = shuffled()
    out = staged(spark.range(1000).repartition(3, F.col("id") % 5), "t-staged")
    assert not shuffled() - before
    assert out.count() == 1000
    was = spark.conf.get(SHUFFLE_CLEANUP)
    with shuffles_freed(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP) == was



def _silver(spark, n=4000, days=50):
    """Silver orders over some days, a tenth without a date, some ids twice, and their items."""
    orders = spark.range(n).select((F.col("id") % (n - 7)).alias("order_id"), (F.col("id") % 3).alias("customer_id"),
                                   F.expr(f"CASE WHEN id % 10 < 9 THEN timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id * id % {days} AS INT)) END").alias("order_date"),
                                   F.lit("O").alias("status"), F.lit("cash").alias("payment_method"), F.lit(1).alias("shipping_cost"), F.col("id").alias("order_total"))
    items = spark.range(3 * n).select(F.format_string("i%06d", F.col("id") % (3 * n - 5)).alias("order_item_id"), F.expr("id DIV 3").alias("order_id"),
                                      (F.col("id") % 5).alias("product_id"), F.lit(2).alias("quantity"), F.lit(3).alias("unit_price"), F.lit(10).alias("discount_pct"),
                                      F.lit(6).alias("subtotal"))
    return staged(silver_order_items(items, "20250301", AS_OF), "t-items"), staged(silver_orders(orders, AS_OF), "t-orders")


def _ids(df):
    return [(r.sales_key, r.order_date_key, r.customer_natural_key, r.order_natural_key, r.order_item_natural_key) for r in df.collect()]


def test_a_fact_in_parts_is_the_whole_fact(spark, monkeypatch):
    items, orders = _silver(spark)
    whole = sorted(_ids(gold.fact_sales(items, orders, AS_OF, key_start=5)))
    assert len(gold.date_slices(orders)) == 1
    monkeypatch.setattr(gold, "SLICE_ORDERS", 500)
    monkeypatch.setattr(gold, "MOST_SLICES", 3)
    slices = gold.date_slices(orders)
    assert len(slices) == 3 and sum(n for _, n in slices) == 4000 == sum(orders.where(when).count() for when, _ in slices)
    parts = [_ids(part) for part in gold.fact_parts(items, orders, AS_OF, key_start=5)]
    assert len(parts) == 3 and [r for part in parts for r in sorted(part)] == whole
    keys = [r[0] for r in whole]
    assert keys == list(range(6, 6 + len(keys))) and whole[0][1] is None


def test_a_part_exchanges_its_own_items(spark, monkeypatch):
    items, orders = _silver(spark)
    monkeypatch.setattr(gold, "SLICE_ORDERS", 500)
    monkeypatch.setattr(gold, "MOST_SLICES", 3)
    seen, whole = [], gold.fact_sales
    monkeypatch.setattr(gold, "fact_sales", lambda i, o, *a, **k: seen.append((i.count(), o.count())) or whole(i, o, *a, **k))
    for part in gold.fact_parts(items, orders, AS_OF):
        part.collect()
    assert all(i <= 3.5 * o for i, o in seen) and sum(o for _, o in seen) == 4000


def test_a_large_bitmap_is_bounded_and_few_keys_have_a_small_one(spark):
    assert bits_for(0) == bits_for(1000) == 1 << 16 and bits_for(10 ** 12) == 1 << 26 and 4 <= bits_for(10 ** 6) / 10 ** 6 <= 17


def test_slices_need_dates_that_sort_like_their_keys(spark, monkeypatch):
    monkeypatch.setattr(gold, "SLICE_ORDERS", 1)
    day = lambda *days: spark.createDataFrame([(d,) for d in days], "partition_date string")
    assert [n for _, n in gold.date_slices(day("20240101", "20240102", "20240102", None))] == [1, 1, 2]
    assert [n for _, n in gold.date_slices(day("20240101", "+100000101", "20240102"))] == [3]
    assert gold.date_slices(day()) == [(None, 0)]


def test_loaded_files_go_and_the_rows_are_all_there(spark, monkeypatch):
    monkeypatch.setattr(gold, "SLICE_ORDERS", 700)
    roots = []
    monkeypatch.setattr(Q, "scratch_path", lambda s, n: roots.append(scratch_path(s, n)) or roots[-1])
    got = {r.category: (r.n_items, r.net_amount) for r in Q.q_load_bucketed(spark, SF_SMALL).collect()}
    assert sum(n for n, _ in got.values()) == 6000
    assert not _files(f"{roots[0]}/files") and _files(f"{roots[0]}/tables")


def test_a_refresh_in_slices_gives_the_rows_and_keys_of_one(spark, monkeypatch):
    items, orders = _silver(spark, 900, days=9)
    orders = orders.where("order_id % 3 <> 1").dropDuplicates(["order_id"])
    day = F.col("partition_date")
    want = _ids(gold.fact_sales(items.distinct(), orders.where(day.isNotNull()), AS_OF))
    monkeypatch.setattr(gold, "SLICE_ORDERS", 100)
    monkeypatch.setattr(gold, "MOST_SLICES", 2)
    table = IncrementalFact(spark, scratch_path(spark, "t-slices"), orders.schema, items.schema)
    table.append_orders(orders)
    table.append_items(items, "20250301")
    done = table.refresh(AS_OF)
    assert done.rows == done.max_key == len(want) and sorted(_ids(table.fact())) == sorted(want)


def test_an_appends_rows_are_compared_with_the_held_keys_alone(spark, monkeypatch):
    path = scratch_path(spark, "t-held")
    df = spark.createDataFrame([(i, f"d{i % 3}", "x") for i in range(300)] + [(None, "d0", "y")], "order_id bigint, partition_date string, v string")
    append_new(df.where("order_id < 200"), path, "order_id")
    kept = unseen(df, path, "order_id", keys_first=True)
    joins = [line for line in kept._jdf.queryExecution().executedPlan().toString().splitlines() if "LeftAnti" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins) and any("append-held" in f for f in kept.inputFiles())
    assert kept.count() == 101 == unseen(df, path, "order_id").count()
    real, held = transactions.staged, []
    monkeypatch.setattr(transactions, "staged", lambda d, n: held.append((n, real(d, n))) or held[-1][1])
    assert append_new(df, path, "order_id") == 101 and append_new(df, path, "order_id") == 0
    assert [n for n, _ in held] == ["append-batch", "append-held"] * 2
