"""Gold star schema: customer, product and date dimensions and the sales fact."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns, date_key
from ..session import scratch_scope, staged
from ..sources.schemas import DIM_CUSTOMER, DIM_DATE_END, DIM_DATE_START, DIM_PRODUCT, FACT_SALES, TableRules
from .keys import assign_dense_key, sized_sample
from .sieve import MOST_BITS, bitmap, bits_for, sifted_by


def _ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


def _current(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("is_current") == True)  # noqa: E712


def declared_columns(df: DataFrame, table: TableRules, **computed: Column) -> list[Column]:
    """The table's declared columns over ``df``: computed, or its silver column, cast where the types differ."""
    have, out = dict(df.dtypes), []
    for name, want in table.types().items():
        silver = table.source.get(name, name)
        col = computed.get(name)
        if col is None:
            col = F.col(silver) if have[silver] == want else F.col(silver).cast(want)
        out.append(col.alias(name))
    return out


def dim_customer(silver: DataFrame, as_of: str) -> DataFrame:
    """Current customer versions in the warehouse's columns."""
    return _current(silver).select(*declared_columns(silver, DIM_CUSTOMER, etl_processed_date=_ts(as_of)))


def dim_product(silver: DataFrame, as_of: str) -> DataFrame:
    """Current product versions in the warehouse's columns; the price becomes a decimal."""
    return _current(silver).select(*declared_columns(silver, DIM_PRODUCT, etl_processed_date=_ts(as_of)))


def _calendar(bounds: DataFrame, as_of: str) -> DataFrame:
    """Explode a one-row (start, end) frame into one row per day with calendar attributes."""
    days = bounds.select(F.explode(F.sequence(F.col("start"), F.col("end"),
                                              F.expr("INTERVAL 1 DAY"))).alias("dt"))
    cal = calendar_columns(F.col("dt"))
    return days.select(*[v.alias(k) for k, v in cal.items()], _ts(as_of).alias("etl_processed_date"))


def dim_date(spark: SparkSession, as_of: str, start: str = DIM_DATE_START,
             end: str = DIM_DATE_END) -> DataFrame:
    """Daily spine ``start``..``end`` inclusive (default 2010-01-01..2030-12-31, 7,670 days)."""
    bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("start"),
                                   F.to_date(F.lit(end)).alias("end"))
    return _calendar(bounds, as_of)


def dim_date_covering(df: DataFrame, col: str, as_of: str) -> DataFrame:
    """Spine over whole calendar years spanning ``df[col]``, so every fact date has a row.

    The bounds are one partial aggregate over ``df``; no value reaches the driver.
    """
    d = F.to_date(F.col(col))
    bounds = (df.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
              .filter(F.col("lo").isNotNull())
              .select(F.make_date(F.year("lo"), F.lit(1), F.lit(1)).alias("start"),
                      F.make_date(F.year("hi"), F.lit(12), F.lit(31)).alias("end")))
    return _calendar(bounds, as_of)


# The fact's order: the warehouse sort key (order_date_key, customer) then the
# order and item ids. One exchange by ranges of it gives the dense sales_key and
# the write layout. It carries silver columns: the warehouse's strings, constants
# and second date column are made after it.
FACT_ORDER = ("order_date_key", "customer_id", "order_id", "order_item_id")


def _sampled_order(items: DataFrame, orders: DataFrame, ranges: int | None) -> tuple[int, DataFrame]:
    """Number of ranges, and FACT_ORDER of a sample of the items: bounded by that number, so it is broadcast to the
    orders' keys."""
    ranges, some = sized_sample(items.select("order_id", "order_item_id"), ranges)
    return ranges, F.broadcast(some).join(orders.select("order_id", "order_date", "customer_id"), "order_id").select(
        date_key(F.col("order_date")), "customer_id", "order_id", "order_item_id")


def fact_sales(items: DataFrame, orders: DataFrame, as_of: str,
               date_range: tuple[str, str] | None = None, key_start: int = 0,
               num_partitions: int | None = None) -> DataFrame:
    """Order items joined to their orders (inner: orders without items drop out).

    ``sales_key`` is dense from ``key_start + 1`` in (order_date_key,
    customer_id, order_id, order_item_id) order. Order-level shipping_cost and
    total_amount repeat on each item row: never sum them per item.
    ``date_range`` (yyyyMMdd strings) prunes silver order partitions.
    """
    od = orders
    if date_range is not None:
        od = od.filter(F.col("partition_date").between(*date_range))
    needed = {FACT_SALES.source.get(c, c) for c, _ in FACT_SALES.columns} | {"order_id"}
    od = od.select(*[c for c in od.columns if c in needed | {"order_date"}])
    it = items.select(*[c for c in items.columns if c in needed])
    sales = it.join(od.withColumn("order_date_key", date_key(F.col("order_date"))).drop("order_date"), "order_id", "inner")
    ranges, sample = _sampled_order(items, od, num_partitions)
    keyed = assign_dense_key(sales, FACT_ORDER, "sales_key", start=key_start, num_partitions=ranges, sample=sample)
    return keyed.select(
        *declared_columns(keyed, FACT_SALES, sales_key=F.col("sales_key"), order_date_key=F.col("order_date_key"), etl_processed_date=_ts(as_of)),
        F.col("order_date_key").alias("date_partition"))


#: Orders that a slice holds at least, and the slices that a fact is built in at most.
SLICE_ORDERS = 250_000
MOST_SLICES = 8


def date_slices(orders: DataFrame) -> list[tuple[Column | None, int]]:
    """Runs of order dates, ascending (no date first), with about the same number of orders: a condition over ``orders`` and that
    number. One slice without a condition if there are few orders, or so many that a sieve of a slice's would let most items pass.
    The driver holds a row per date."""
    counted = sorted(((r.partition_date, r["count"]) for r in orders.groupBy("partition_date").count().collect()), key=lambda r: (r[0] is not None, r[0]))
    n = sum(c for _, c in counted)
    slices = min(MOST_SLICES, n // SLICE_ORDERS)
    # partition dates sort like date keys if they are all of one length
    if slices < 2 or n // slices > MOST_BITS or any(d is not None and len(d) != 8 for d, _ in counted):
        return [(None, n)]
    runs, at = [[] for _ in range(slices)], 0
    for d, c in counted:
        runs[at * slices // n].append((d, c))
        at += c
    day, out = F.col("partition_date"), []
    for run in filter(None, runs):
        dated = [d for d, _ in run if d is not None]
        when = day.between(dated[0], dated[-1]) if dated else F.lit(False)
        out.append((when if run[0][0] is not None else when | day.isNull(), sum(c for _, c in run)))
    return out


def fact_parts(items: DataFrame, orders: DataFrame, as_of: str, key_start: int = 0) -> Iterator[DataFrame]:
    """`fact_sales` as frames of a slice of order dates each, with the keys it has in the whole. A slice's items are found by a
    bitmap of its orders' ids, so the exchanges hold a slice's rows and not all. ``items`` and ``orders`` are read
    once a slice: stored tables, not queries. Write each frame, once, before the next is taken: keys go on from its rows."""
    for days, n in date_slices(orders):
        with scratch_scope(orders.sparkSession):
            some, held = items, orders
            if days is not None:
                held, bits = orders.where(days), bits_for(n)
                some = sifted_by(items, staged(bitmap(held, "order_id", bits), "slice-orders"), "order_id", bits)
            written = Observation()
            yield fact_sales(some, held, as_of, key_start=key_start).observe(written, F.count(F.lit(1)).alias("rows"))
            key_start += written.get["rows"]
