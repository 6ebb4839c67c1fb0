from collections import Counter

import pytest

from starhouse.llm import mixing as M


def edf(jobs):
    """Brute force: earliest deadline first, slot by slot, with exact integers."""
    total, done, out = sum(n for _, n in jobs), Counter(), []
    for t in range(total):
        ready = [(-(-(done[s] + 1) * total // n), k, s) for k, (s, n) in enumerate(jobs) if done[s] < n and done[s] * total // n <= t]
        s = min(ready)[2]
        done[s] += 1
        out.append((s, done[s]))
    return out


def brute(sources):
    """Order of blocks (source, i) by phases."""
    left, done, out = dict((s, b) for s, b, _ in sources), Counter(), []
    w = {s: x for s, _, x in sources}
    from fractions import Fraction as Fr
    ends = sorted({Fr(b, x) for _, b, x in sources})
    since = Fr(0)
    for until in ends:
        live = sorted(s for s, b, x in sources if Fr(b, x) >= until)
        a = {s: (left[s] if Fr(left[s], w[s]) <= until else int(w[s] * until)) - done[s] for s in live}
        times = min(a[s] // w[s] for s in live)
        for _ in range(times):
            for s, _j in edf([(s, w[s]) for s in live]):
                done[s] += 1
                out.append((s, done[s]))
        rest = [(s, a[s] - times * w[s]) for s in live if a[s] > times * w[s]]
        for s, _j in edf(rest):
            done[s] += 1
            out.append((s, done[s]))
        since = until
    return out


@pytest.mark.parametrize("sources", [
    [("a", 50, 3), ("b", 9, 2), ("c", 17, 5)], [("a", 4, 1)], [("a", 7, 7), ("b", 7, 7)], [("a", 1, 9), ("b", 40, 1), ("c", 3, 4)]])
def test_block_order_is_pfair(spark, sources):
    blocks = spark.createDataFrame([(s, i * 3, i + 1, 1, 1) for s, n, _ in sources for i in range(n)],
                                   "source string, bucket long, i long, n_docs long, chars long")
    src = spark.createDataFrame(sources, "source string, blocks long, w long")
    got = M.block_slots(blocks, src).orderBy("slot").collect()
    assert [r.slot for r in got] == list(range(sum(n for _, n, _ in sources)))
    assert [(r.source, r.bucket // 3 + 1) for r in got] == brute(sources)
    # less than a block from the weight in every prefix of the first phase
    w, total = {s: x for s, _, x in sources}, sum(x for _, _, x in sources)
    seen = Counter()
    for t, r in enumerate([r for r in got if r.phase == 1][:M.RESOLUTION], 1):
        seen[r.source] += 1
        if t % total == 0 or len(sources) > 1 and t < total * min(n // x for _, n, x in sources):
            assert all(abs(seen[s] - t * w[s] / total) < 1 for s in w)


def test_every_document_once_and_defined_cases(spark):
    rows = [(i, f"text {i} " * 40, "hot" if i % 3 else f"s{i % 5}", "x") for i in range(300)]
    rows += [(1000, None, "hot", "x"), (None, "t", None, "x"), (None, "t", None, "x"), (1001, "", "s1", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, slot string")
    out = M.mix(docs, weights={"hot": 2.0, "s1": 1.0, "absent": 5.0}, block_chars=2000, resolution=20).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    assert len({(r.slot, r.source) for r in out}) == len({r.slot for r in out}) and {r.slot for r in out} == set(range(max(r.slot for r in out) + 1))
    assert M.mix(docs.limit(0)).count() == 0


def test_blocks_are_numbered_across_stretches(spark, monkeypatch):
    monkeypatch.setattr(M, "STRETCH", 4)
    rows = [(s, b, 1, 1) for s, step in (("a", 1), ("b", 3), ("c", 9)) for b in range(0, 40, step)]
    got = M._numbered(spark.createDataFrame(rows, "source string, bucket long, n_docs long, chars long")).collect()
    want = {(s, b): i for s, step in (("a", 1), ("b", 3), ("c", 9)) for i, b in enumerate(range(0, 40, step), 1)}
    assert {(r.source, r.bucket): r.i for r in got} == want and len(got) == len(rows)


@pytest.mark.parametrize("weights", [{"a": 0.001, "b": 0.4, "c": 0.599}, {"a": 1 / 3, "b": 0.0037, "c": 2 / 3 - 0.0037}])
def test_deviation_from_the_target_itself(spark, weights):
    """Every prefix of a long phase against the unrounded target weights."""
    n = 9000
    counts = {s: int(n * w * 1.02) + 2 for s, w in weights.items()}
    blocks = spark.createDataFrame([(s, i, i + 1, 1, 1) for s, c in counts.items() for i in range(c)],
                                   "source string, bucket long, i long, n_docs long, chars long")
    got = M.block_slots(blocks, M.source_weights(blocks, weights)).orderBy("slot").collect()
    assert [r.slot for r in got] == list(range(sum(counts.values())))
    assert all([r.bucket for r in got if r.source == s] == list(range(c)) for s, c in counts.items())
    seen, off = Counter(), []
    for t, r in enumerate([r for r in got if r.phase == 1], 1):
        seen[r.source] += 1
        off.append(max(abs(seen[s] - t * w) for s, w in weights.items()))
    last = 2 * max(M.RESOLUTION, int(1 / min(weights.values())) + 1)
    print("worst deviation", max(off[:-last]), max(off))
    assert len(off) > 8500 and max(off[:-last]) < 2 and max(off) < 2 + len(weights)
