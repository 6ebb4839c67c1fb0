"""Property tests: Spark SCD2 merge and dense keys against a brute-force Python model."""

import datetime as dt
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starhouse.operators import scd2
from starhouse.operators.keys import assign_dense_key
from starhouse.sources.schemas import BRONZE, CUSTOMERS

T1, T2 = "2025-03-03 00:00:00", "2025-03-06 00:00:00"
FAR = dt.datetime(9999, 12, 31, 23, 59, 59)

batch_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)),
                                st.one_of(st.none(), st.sampled_from(["1", "2", "3"]))),
                      min_size=1, max_size=12)


def _hash(phone):
    parts = ["n", "e"] + ([phone] if phone is not None else []) + ["c"] + ([phone] if phone is not None else [])
    return hashlib.sha256("|".join(parts).encode()).hexdigest()


def _model_initial(batch, t):
    rows = sorted(batch, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, _hash(r[1])))
    return [dict(k=k, p=p, h=_hash(p), sk=i + 1, cur=True, vf=t, vt=FAR) for i, (k, p) in enumerate(rows)]


def _model_merge(hist, batch, t):
    cur = [r for r in hist if r["cur"]]
    old = [r for r in hist if not r["cur"]]
    max_sk = max((r["sk"] for r in hist), default=0)
    ins, changed = [], set()
    for k, p in batch:
        h = _hash(p)
        same_key = [c for c in cur if k is not None and c["k"] == k]
        if not same_key:
            ins.append((1, k, p, h))
        elif any(c["h"] != h for c in same_key):
            ins.append((0, k, p, h))
            changed.add(k)
    prior = [dict(r, cur=False, vt=t) if r["k"] in changed else r for r in cur]
    ins.sort(key=lambda r: (r[0], r[1] is not None, r[1] if r[1] is not None else 0, r[3]))
    new = [dict(k=k, p=p, h=h, sk=max_sk + i + 1, cur=True, vf=t, vt=FAR) for i, (_, k, p, h) in enumerate(ins)]
    return old + prior + new


def _frame(spark, batch):
    rows = [(k, "n", "e", p, "a", "c") for k, p in batch]
    return scd2.standardize(spark.createDataFrame(rows, BRONZE["customers"]), CUSTOMERS)


def _as_set(rows):
    return sorted((r["k"] if r["k"] is not None else -1, r["p"] or "", r["sk"], r["cur"], r["vf"], r["vt"])
                  for r in rows)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(b1=batch_rows, b2=batch_rows)
def test_merge_matches_model(spark, b1, b2):
    t1, t2 = dt.datetime(2025, 3, 3), dt.datetime(2025, 3, 6)
    v2 = scd2.merge(scd2.initial(_frame(spark, b1), CUSTOMERS, T1), _frame(spark, b2), CUSTOMERS, T2)
    got = [dict(k=r.customer_id, p=r.phone, sk=r.customer_sk, cur=r.is_current, vf=r.valid_from, vt=r.valid_to)
           for r in v2.collect()]
    want = _model_merge(_model_initial(b1, t1), b2, t2)
    assert _as_set(got) == _as_set(want)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(keys=st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=0, max_size=60),
       parts=st.integers(1, 9), start=st.integers(0, 1000))
def test_dense_key_matches_sorted_rank(spark, keys, parts, start):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    got = {r.i: r.sk for r in assign_dense_key(df, ["k", "i"], "sk", start=start, num_partitions=parts).collect()}
    order = sorted(range(len(keys)), key=lambda i: (keys[i] is not None, keys[i] or 0, i))
    assert got == {i: start + rank + 1 for rank, i in enumerate(order)}
