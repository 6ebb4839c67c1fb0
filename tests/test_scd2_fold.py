"""Several batches at once and late batches against one merge after another; bucketed current rows."""

import os
import random

import pytest

from starhouse.operators import scd2, scd2_fold
from starhouse.session import scratch_path, staged
from starhouse.sinks.scd2_store import Scd2Store
from starhouse.sources.schemas import BRONZE, CUSTOMERS, FAR_FUTURE

TIMES = [f"2025-03-{d:02d} 00:00:00" for d in (3, 5, 7, 9, 11)]


def batch(spark, rows):
    return scd2.standardize(spark.createDataFrame(rows, BRONZE["customers"]), CUSTOMERS)


def drops(spark, seed):
    """Five batches in which keys come, go, change, change back and stay; and rows without a key."""
    rng = random.Random(seed)
    out = []
    for _ in TIMES:
        rows = [(i, "n", "e", rng.choice("123"), f"a{rng.random()}", "c") for i in range(30) if rng.random() < 0.7]
        out.append(batch(spark, rows + [(None, "none", "e", rng.choice("12"), "a", "c")]))
    return list(zip(out, TIMES))


def in_order(items):
    """Plain merges, one after another, of keys that a batch holds once: (columns, key, current, from, to) rows."""
    history, top = [], 0
    for frame, t in items:
        rows = [tuple(r) for r in frame.select(*scd2.entity_columns(CUSTOMERS, frame)).collect()]
        now = {h[0][0]: h for h in history if h[2] and h[0][0] is not None}
        begun = []
        for r in rows:
            held = now.get(r[0])
            if held is None or held[0][-1] != r[-1]:
                begun.append((held is None, r[0] is not None, r[0] or 0, r[-1], r))
                if held is not None:
                    held[2], held[4] = False, t
        for *_, r in sorted(begun):
            top += 1
            history.append([r, top, True, t, FAR_FUTURE])
    return history


def plain(rows, keys=True):
    if not isinstance(rows, list):
        rows = [(tuple(r[c] for c in (*CUSTOMERS.columns, "hash_key")), r[CUSTOMERS.sk], r.is_current, str(r.valid_from), str(r.valid_to)) for r in rows.collect()]
    return sorted(str((h[0], h[1] if keys else "", *h[2:])) for h in rows)


def stored(spark, items):
    store = Scd2Store(spark, scratch_path(spark, "t-fold"), CUSTOMERS, buckets=4)
    store.apply(*items[0])
    return store


def test_backfill_equals_single_merges(spark):
    items = drops(spark, 1)
    v1 = stored(spark, items).read()
    assert plain(scd2_fold.backfill(v1, items[1:], CUSTOMERS)) == plain(in_order(items))
    assert plain(scd2_fold.backfill(v1, [], CUSTOMERS)) == plain(in_order(items[:1]))


@pytest.mark.parametrize("late", [1, 3])
def test_back_dated_equals_in_order(spark, late):
    items = drops(spark, 2 + late)
    store = stored(spark, items)
    store.apply_all([x for i, x in enumerate(items) if i not in (0, late)])
    known = store.read()
    got = staged(scd2_fold.back_dated(known, *items[late], items[late + 1:], CUSTOMERS), "t-got")
    assert plain(got, keys=False) == plain(in_order(items), keys=False)
    keys = [r[0] for r in got.select(CUSTOMERS.sk).collect()]
    assert len(keys) == len(set(keys))
    # versions that are as before keep their keys
    of = lambda df: {(r[0], str(r[1]), r[2]): r[3] for r in df.select(CUSTOMERS.key, "valid_from", "hash_key", CUSTOMERS.sk).collect() if r[0] is not None}
    old, new = of(known), of(got)
    assert set(old) & set(new) and all(old[k] == new[k] for k in set(old) & set(new))


def test_repeated_keys_in_a_batch_and_in_the_history(spark):
    row = lambda i, phone: (i, "n", "e", phone, "a", "c")
    first = batch(spark, [row(1, "2"), row(1, "3"), row(2, "1")])                      # key 1 twice current
    v1 = scd2.initial(first, CUSTOMERS, TIMES[0])
    out = scd2_fold.backfill(v1, [(batch(spark, [row(1, "2"), row(2, "9"), row(2, "8")]), TIMES[2])], CUSTOMERS)
    assert out.where("is_current").groupBy("customer_id").count().where("count > 1").count() == 0
    assert out.where("NOT is_current AND customer_id = 1").count() == 2


def test_store_late_batch_and_backfill(spark):
    items = drops(spark, 8)
    store = stored(spark, items)
    store.apply_all(items[1:3])
    assert plain(store.read()) == plain(in_order(items[:3]))
    store.apply(*items[4])
    with pytest.raises(ValueError, match="as_of"):
        store.apply(*items[3])
    store.apply(*items[3], later=items[4:])
    assert plain(store.read(), keys=False) == plain(in_order(items), keys=False)
    assert store.current().count() == len([h for h in in_order(items) if h[2]])
    after = batch(spark, [(3, "n", "e", "77", "a", "c")])
    store.apply(after, "2025-03-12")
    assert store.apply(after, "2025-03-12 00:00:00").buckets == []          # the same instant: a re-run
    assert plain(store.read(), keys=False) == plain(in_order([*items, (after, "2025-03-12 00:00:00")]), keys=False)
    with pytest.raises(ValueError, match="as_of"):
        store.apply_all([items[0]])


def test_a_small_batch_rewrites_only_its_buckets(spark):
    store = Scd2Store(spark, scratch_path(spark, "t-buckets"), CUSTOMERS, buckets=64)
    store.apply(batch(spark, [(i, "n", "e", "1", "a", "c") for i in range(4000)]), TIMES[0])
    small = batch(spark, [(i, "n", "e", "2" if i < 4 else "1", "a", "c") for i in (0, 1, 2, 3, 70, 71)])      # 71 and 70 as before
    done = store.apply(small, TIMES[1])
    want = {r[0] for r in small.where("customer_id < 4").select(store.bucket("customer_id")).collect()}
    assert set(done.buckets) == want and len(want) <= 4
    path = f"{store._run_path(2)}/is_current=true".replace("file:", "", 1)
    assert {d for d in os.listdir(path) if "=" in d} == {f"bucket={b}" for b in want}
    assert store.read().count() == 4004 and store.current().count() == 4000 and store.current().where("phone = '2'").count() == 4
    assert store.apply(batch(spark, [(5, "n", "e", "1", "a", "c")]), TIMES[2]).buckets == []                 # nothing changed
    assert store.current().count() == 4000 and store.last_run()["version"] == 3
    plan = store.current([next(iter(want))])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1
