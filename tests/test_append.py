"""Appends: one rule at every size, re-sent keys, rows without a key; ordered SCD2 runs."""

import pytest

from starhouse.session import scratch_path
from starhouse.sinks.scd2_store import Scd2Store
from starhouse.sinks.transactions import append_new, read_transactions, unseen
from starhouse.sources.schemas import CUSTOMERS

SCHEMA = "order_id long, v string, partition_date string"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_resent_and_null_keys(spark):
    path = scratch_path(spark, "t-append")
    first = _df(spark, [(1, "a", "d1"), (2, "b", "d1"), (None, "x", "d1"), (None, "y", "d2"), (1, "a", "d1")])
    assert append_new(first, path, "order_id") == 4
    assert append_new(first, path, "order_id") == 0
    again = _df(spark, [(1, "a", "d9"), (3, "c", "d9"), (None, "x", "d1"), (None, "z", "d1")])
    assert append_new(again, path, "order_id") == 2
    got = {tuple(r) for r in read_transactions(spark, path, first.schema).collect()}
    assert got == {(1, "a", "d1"), (2, "b", "d1"), (None, "x", "d1"), (None, "y", "d2"), (3, "c", "d9"), (None, "z", "d1")}


def test_partition_scope_is_by_choice_and_prunes(spark):
    path = scratch_path(spark, "t-append")
    append_new(_df(spark, [(1, "a", "d1"), (2, "b", "d2")]), path, "order_id")
    rows = _df(spark, [(1, "a", "d3")])
    assert unseen(rows, path, "order_id", "partition_date").count() == 0
    kept = unseen(rows, path, "order_id", "partition_date", scope="partition")
    assert kept.count() == 1 and "partition_date" in kept._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        unseen(rows, path, "order_id", "partition_date", scope="batch")


def test_late_run_is_rejected(spark):
    from starhouse.operators import scd2
    from starhouse.sources.schemas import BRONZE
    store = Scd2Store(spark, scratch_path(spark, "t-late"), CUSTOMERS)
    row = {f.name: None for f in BRONZE["customers"].fields} | {BRONZE["customers"].fields[0].name: 1}
    batch = scd2.standardize(spark.createDataFrame([tuple(row.values())], BRONZE["customers"]), CUSTOMERS)
    store.apply(batch, "2025-03-06 00:00:00")
    with pytest.raises(ValueError, match="as_of"):
        store.apply(batch, "2025-03-03 00:00:00")
