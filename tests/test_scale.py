"""What must hold for large tables: inputs run once, a single file's rows are computed by all tasks, drops are many files."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starhouse.operators.audit import audit
from starhouse.operators.keys import assign_dense_key
from starhouse.plans import io_queries as Q
from starhouse.session import scratch_path
from starhouse.sinks import transactions
from starhouse.sinks.star import export_dim
from starhouse.sources.schemas import DIM_DATE
from starhouse.streaming import fact as stream


def _table(spark, name):
    path = scratch_path(spark, name)
    spark.range(3000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("tie"), (F.col("id") % 7).alias("v")).write.parquet(path)
    return path


def test_a_key_alone_runs_the_input_once(spark):
    """A caller that drops columns still has one exchange, used twice."""
    got = assign_dense_key(spark.read.parquet(_table(spark, "t-scale-key")), ["k"], "sk", num_partitions=4).select("sk")
    assert sorted(r.sk for r in got.collect()) == list(range(1, 3001))
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1 and plan.count("FileScan") == 1


def test_a_small_input_has_few_ranges(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    got = assign_dense_key(df, ["k"], "sk")
    assert got.rdd.getNumPartitions() <= 2 and got.agg(F.max("sk")).first()[0] == 3000


def test_an_audit_computes_its_frame_once(spark):
    path = _table(spark, "t-scale-audit")
    df = spark.read.parquet(path).select(F.col("v").cast("int").alias("date_key"), F.when(F.col("k") > 0, F.current_date()).alias("full_date"),
                                         F.col("tie").alias("day_name"), F.lit("January and so on").alias("month_name"))
    out = audit(df, DIM_DATE)
    assert path.rsplit("/", 1)[-1] not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.check_name, r.column_name): r.violations for r in out.collect()}
    assert got == {("not_null", "date_key"): 0, ("not_null", "full_date"): 1, ("max_bytes", "day_name"): 0, ("max_bytes", "month_name"): 3000,
                   ("primary_key", "date_key"): 3000}


def test_one_file_is_computed_by_all_tasks(spark):
    path = scratch_path(spark, "t-scale-single")
    export_dim(spark.range(0, 100, 1, 4).withColumn("task", F.spark_partition_id()), path, single_file=True)
    back = spark.read.parquet(path)
    assert back.select(F.input_file_name()).distinct().count() == 1 and back.select("task").distinct().count() == 4


def test_a_drop_of_the_streamed_fact_is_written_by_several_tasks(spark, monkeypatch):
    class Seen(Exception):
        pass

    def write(df, *_a, **_k):
        assert df.rdd.getNumPartitions() > 1
        raise Seen

    monkeypatch.setattr(Q, "write_bronze", write)
    with pytest.raises(Seen):
        Q.q_stream_fact(spark, SF_SMALL)


def test_the_streams_state_is_on_disk_and_the_session_stays_as_it_was(spark):
    before = spark.conf.get(stream.PROVIDER)
    with stream._state_on_disk(spark):
        assert "RocksDB" in spark.conf.get(stream.PROVIDER)
    assert spark.conf.get(stream.PROVIDER) == before
    spark.conf.set(stream.PROVIDER, "my.Provider")
    try:
        with stream._state_on_disk(spark):
            assert spark.conf.get(stream.PROVIDER) == "my.Provider"
    finally:
        spark.conf.set(stream.PROVIDER, before)


def test_a_first_load_of_parsed_files_is_not_written_twice(spark, monkeypatch):
    path = scratch_path(spark, "t-scale-append")
    df = spark.createDataFrame([(i % 40, f"d{i % 3}") for i in range(80)], "order_id bigint, partition_date string")
    real, calls = transactions.staged, []
    monkeypatch.setattr(transactions, "staged", lambda d, n: calls.append(n) or real(d, n))
    assert transactions.append_new(df, path, "order_id", reread=True) == df.distinct().count() and not calls
    assert transactions.append_new(df, path, "order_id", reread=True) == 0 and calls


def test_drops_hold_each_item_once_and_the_rest_reads_items_once(spark):
    _, items, drops = Q.fact_drops(spark, SF_SMALL)
    both = drops[0][1].select("order_item_id").unionByName(drops[1][1].select("order_item_id"))
    assert both.exceptAll(items.select("order_item_id")).count() == 0 and both.count() == items.count()
    assert drops[1][1]._jdf.queryExecution().optimizedPlan().toString().count("l_orderkey#") and \
        drops[1][1]._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") == 1
