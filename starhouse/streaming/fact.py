"""The sales fact as a stream: dated drops of items and orders, joined as they arrive.

Both sides are file streams over bronze drops. A row's event time is the day of its drop. Items and orders meet
if their drops are at most ``window`` days apart; until then each side is kept in the join's state, so that items
may come before or after their order. The watermark is the latest drop seen less the window, and state that can meet
nothing any more is dropped by Spark. The state is held by RocksDB, on the executors' disks with a bounded share of their
memory, as it has every row of the window: the default store would keep them all on the heap. Joined rows are appended, partitioned like the fact. A stream has no dense key;
number a loaded table with `assign_dense_key`.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..operators.gold import declared_columns
from ..operators.silver import silver_order_items, silver_orders
from ..session import SHUFFLE_CLEANUP, set_conf
from ..sinks.versioned import PARQUET_OPTIONS
from ..sources.schemas import FACT_SALES
from .ingest import batch_date_of_file, bronze_stream


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STATE_CONF = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "1000",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",         # of the changes, a copy of the state
    "spark.sql.streaming.join.stateFormatVersion": "3",                 # one store a task, not four: a store takes 4 MB of disk at least
    SHUFFLE_CLEANUP: "true",
}


@contextmanager
def _state_on_disk(spark: SparkSession):
    """A query that starts inside keeps its state in RocksDB (a checkpoint's own store goes before); a store the session has
    chosen stays."""
    chosen = spark.conf.get(PROVIDER, None)
    if chosen and "HDFSBackedStateStoreProvider" not in chosen:
        yield
        return
    with set_conf(spark, STATE_CONF):
        yield


def _drops(spark: SparkSession, bronze_root: str, entity: str, window: int, files_per_trigger: int | None, consume: bool) -> DataFrame:
    """Bronze rows with the day of their drop, as text and as event time with the watermark."""
    rows = bronze_stream(spark, bronze_root, entity, files_per_trigger, consume).withColumn("drop_day", batch_date_of_file())
    return rows.withColumn("dropped", F.to_timestamp("drop_day", "yyyyMMdd")).withWatermark("dropped", f"{window} days")


def fact_stream(spark: SparkSession, bronze_root: str, as_of: str, window: int = 7,
                files_per_trigger: int | None = None, consume: bool = False) -> DataFrame:
    """Streaming frame of the fact's rows, without sales_key."""
    items = silver_order_items(_drops(spark, bronze_root, "order_items", window, files_per_trigger, consume), F.col("drop_day"), as_of, keep=("dropped",))
    orders = silver_orders(_drops(spark, bronze_root, "orders", window, files_per_trigger, consume), as_of, keep=("dropped",))
    needed = {FACT_SALES.source.get(c, c) for c, _ in FACT_SALES.columns}
    i = items.select(*[c for c in items.columns if c in needed and c != "order_id"], F.col("order_id").alias("_order"), F.col("dropped").alias("_came"))
    o = orders.select(*[c for c in orders.columns if c in needed | {"order_id", "order_date", "dropped"}])
    near = F.expr(f"_order = order_id AND _came BETWEEN dropped - INTERVAL {window} DAYS AND dropped + INTERVAL {window} DAYS")
    sales = i.join(o, near, "inner").withColumn("etl_processed_date", F.lit(as_of).cast("timestamp_ntz"))
    dk = date_key(F.col("order_date"))
    return sales.select(*declared_columns(sales, FACT_SALES, sales_key=F.lit(None), order_date_key=dk), dk.alias("date_partition")).drop("sales_key")


def write_fact_stream(spark: SparkSession, bronze_root: str, target: str, checkpoint: str, as_of: str, window: int = 7,
                      files_per_trigger: int | None = None, partition_by: tuple[str, ...] = ("order_date_key",), available_now: bool = True,
                      consume: bool = False):
    """Start the query; with ``available_now`` it joins what has landed, stops and may be started again later: state and
    progress are in ``checkpoint``, and a batch that is repeated replaces its own files. ``consume``: a drop's files are
    deleted after the micro-batch that read them is committed, for drops that are a copy."""
    writer = fact_stream(spark, bronze_root, as_of, window, files_per_trigger, consume).writeStream.format("parquet").outputMode("append") \
        .options(**PARQUET_OPTIONS).option("checkpointLocation", checkpoint).partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    with _state_on_disk(spark):
        query = writer.start(target)
    if available_now:
        query.awaitTermination()
    return query
