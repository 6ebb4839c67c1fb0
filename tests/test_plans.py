"""Physical-plan checks: pushdown, partition pruning, join strategies, no single-partition data exchange."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from starhouse.operators import gold, scd2
from starhouse.plans import pipeline as P
from starhouse.session import scratch_path
from starhouse.sinks.transactions import append_new, read_transactions
from starhouse.sources.schemas import CUSTOMERS

AS_OF = "2025-03-06 00:00:00"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_is_current_pushed_to_parquet(spark):
    path = scratch_path(spark, "t-plan-silver")
    P.entity_v2(spark, SF_SMALL, CUSTOMERS).write.parquet(path)
    dim = gold.dim_customer(spark.read.parquet(path), AS_OF)
    plan = plan_of(dim)
    assert "PushedFilters: [IsNotNull(is_current), EqualTo(is_current,true)]" in plan
    # column pruning: hash_key is never read for the dimension
    assert "hash_key" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_fact_date_range_prunes_order_partitions(spark):
    path = scratch_path(spark, "t-plan-orders")
    rows = P.orders_silver(spark, SF_SMALL).filter(F.col("partition_date") < "19950301")
    append_new(rows, path, "order_id")
    orders = read_transactions(spark, path, rows.schema)
    items = P.items_silver(spark, SF_SMALL)
    od = orders.filter(F.col("partition_date").between("19950101", "19950131"))
    j = items.join(od.select("order_id", "order_date"), "order_id")
    plan = plan_of(j)
    assert "PartitionFilters: [isnotnull(partition_date" in plan


def test_merge_uses_equi_joins_only(spark):
    v1 = P.entity_v1(spark, SF_SMALL, CUSTOMERS)
    b2 = P.entity_batch(spark, SF_SMALL, CUSTOMERS, 2)
    result = scd2.changes(v1.filter("is_current"), b2, CUSTOMERS, AS_OF, 135)
    for df in (result.classified, result.closed, result.current):
        plan = plan_of(df)
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_fact_joins_once(spark):
    """The plan that ran: one scan of items and orders each, one exchange by range used twice, no exchange of all
    rows to one task (the offsets have a row a range)."""
    fact = P.fact(spark, SF_SMALL)
    fact.collect()
    plan = plan_of(fact).split("Initial Plan")[0]
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 1
    assert plan.count("ReusedExchange") == 1 and "rangepartitioning" not in plan.lower()
    assert plan.count("SinglePartition") == 1 and "NestedLoopJoin" not in plan


def test_append_dedupe_reads_only_batch_partitions(spark):
    from starhouse.sinks.transactions import unseen
    path = scratch_path(spark, "t-plan-scope")
    df = spark.createDataFrame([(i, f"2025030{i % 5}") for i in range(50)], "order_id bigint, partition_date string")
    append_new(df, path, "order_id")
    batch = df.filter(F.col("partition_date") == "20250302")
    plan = plan_of(unseen(batch, path, "order_id", "partition_date", scope="partition"))
    assert "PartitionFilters: [" in plan and "20250302" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert unseen(batch, path, "order_id", "partition_date", scope="partition").count() == 0
    assert unseen(batch.withColumn("order_id", F.col("order_id") + 1000), path, "order_id",
                  "partition_date", scope="partition").count() == 10
