"""Content verification, the bitmap before an append's join, file layout, the streamed fact, and the entry without the training-data part."""

import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starhouse.operators.sieve import bitmap, sifted
from starhouse.plans import io_queries as Q
from starhouse.plans import pipeline as P
from starhouse.session import scratch_path
from starhouse.sinks.star import arranged, load_verified
from starhouse.sinks.transactions import append_new, unseen
from starhouse.sinks.verify import ContentMismatch, Watched, fingerprint, verify
from starhouse.sinks.versioned import VersionedTable
from starhouse.sources.schemas import FACT_SALES


def _frame(spark):
    return spark.range(1000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("v"), F.lit(None).cast("int").alias("n"))


def test_one_changed_cell_is_found(spark):
    path, df = scratch_path(spark, "t-verify"), _frame(spark)
    watched = Watched(df)
    watched.df.write.parquet(path)
    back = spark.read.parquet(path)
    assert verify(watched.fingerprint, back.repartition(3), df.columns).rows == 1000
    for other in (back.withColumn("v", F.when(F.col("id") == 5, "x").otherwise(F.col("v"))), back.where("id <> 5"),
                  back.unionByName(back.where("id = 5")), back.where("id <> 5").unionByName(back.where("id = 6"))):
        with pytest.raises(ContentMismatch):
            verify(watched.fingerprint, other, df.columns)
    assert fingerprint(df.limit(0)).rows == 0


def test_a_version_that_reads_back_otherwise_is_not_committed(spark, monkeypatch):
    from starhouse.sinks import versioned
    table = VersionedTable(spark, scratch_path(spark, "t-verified"))
    assert table.publish(_frame(spark), partition_by=["v"], verified=True) == 1
    real = versioned.verify
    monkeypatch.setattr(versioned, "verify", lambda w, back, cols, what: real(w, back.where("id <> 3"), cols, what))
    with pytest.raises(ContentMismatch):
        table.publish(_frame(spark), verified=True)
    assert table.version() == 1 and table.read().count() == 1000


def test_load_verified_counts_what_was_appended(spark):
    path = scratch_path(spark, "t-load")
    _frame(spark).write.parquet(path)
    name = "t_load_" + path.rsplit("-", 1)[-1]
    spark.sql(f"CREATE TABLE {name} (a BIGINT, b VARCHAR(1), c INT) USING parquet LOCATION '{path}-table'")
    assert load_verified(spark, path, name) == {"rows_written": 1000, "rows_read": 1000, "columns": 3}
    assert load_verified(spark, path, name, overwrite=False)["rows_read"] == 1000 and spark.table(name).count() == 2000


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_bitmap_lets_all_partners_pass(spark, bits):
    """With 64 bits nearly every key shares a bit with another: more rows pass, and the result is the same."""
    table = spark.range(5000).withColumnRenamed("id", "k")
    batch = spark.createDataFrame([(i * 11,) for i in range(40)] + [(None,), (10 ** 12,)], "k long")
    passed = sifted(table, batch, "k", bits)
    assert bitmap(batch, "k", bits).count() <= bits // 64
    n = passed.count()
    assert passed.join(batch, "k", "left_semi").count() == 40 and (n > 40 if bits == 64 else 40 <= n < 60)
    want = {r.k for r in batch.join(table, "k", "left_anti").collect()}
    assert {r.k for r in batch.join(passed, "k", "left_anti").collect()} == want == {None, 10 ** 12}


def test_append_join_reads_a_sifted_target(spark):
    path = scratch_path(spark, "t-sieve")
    df = spark.createDataFrame([(i, f"d{i % 5}") for i in range(3000)], "order_id bigint, partition_date string")
    append_new(df, path, "order_id")
    plan = unseen(df.limit(5), path, "order_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan and "LeftAnti" in plan
    assert append_new(df.where("order_id < 50").withColumn("order_id", F.col("order_id") + 2990), path, "order_id") == 40


def test_files_keep_the_declared_order(spark):
    path = scratch_path(spark, "t-layout")
    fact = P.fact(spark, SF_SMALL).drop("date_partition").where("order_date_key < 19930101")
    arranged(fact, FACT_SALES).write.parquet(path)
    local = path.replace("file:", "", 1)
    files = [f for f in os.listdir(local) if f.endswith(".parquet")]
    assert 0 < len(files) <= 8
    for f in files:
        rows = [(r[0], r[1]) for r in spark.read.parquet(f"{path}/{f}").select(*FACT_SALES.sort_by).collect()]
        assert rows == sorted(rows) and all(isinstance(c, str) for _, c in rows)


def test_bucketed_join_has_no_exchange_of_rows(spark):
    out = Q.q_load_bucketed(spark, SF_SMALL)
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("ShuffledHashJoin"):]
    assert "Exchange" not in below and "Sort [" not in below and below.count("Bucketed: true") == 2


def test_streamed_fact_equals_the_batch(spark):
    got = Q.q_stream_fact(spark, SF_SMALL)
    want = P.fact(spark, SF_SMALL).drop("sales_key").select(*got.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 6000


def test_entry_without_the_training_data_part(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    ignore = shutil.ignore_patterns(".git", "llm", "__pycache__")
    for drop_pipeline in (False, True):
        copy = tmp_path / str(drop_pipeline)
        shutil.copytree(repo, copy, ignore=ignore)
        if drop_pipeline:
            (copy / "corpus_pipeline.py").unlink(missing_ok=True)
        code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q) and not any(k.startswith('op') or k == 'pipeline' for k in q); print(len(q))"
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(copy)})
        assert out.returncode == 0 and int(out.stdout.split()[-1]) >= 36, out.stderr
