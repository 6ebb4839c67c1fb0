"""Repeated strings against brute force over all windows; transforms, interleaves and contexts against plain ones."""

import random

import numpy as np
import pytest

from starhouse.llm import suffix_dedup as D

SCHEMA = "doc_id long, text string, rk string, spans string, kept string, n_spans string"


def plain(rows):
    """All windows of SPAN bytes of all rows in a table of counts."""
    texts = [(r[1] or "").encode() for r in rows]
    count = {}
    for t in texts:
        for i in range(len(t) - D.SPAN + 1):
            w = t[i:i + D.SPAN]
            count[w] = count.get(w, 0) + 1
    out = []
    for r, t in zip(rows, texts):
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - D.SPAN + 1):
            if count[t[i:i + D.SPAN]] > 1:
                gone[i:i + D.SPAN] = True
        runs = int(np.count_nonzero(np.diff(np.r_[False, gone].astype(int)) == 1))
        out.append((str(r[0]), len(t), int(gone.sum()), runs, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return sorted(out)


def found(spark, rows, parts=4):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    out = D.remove(docs, D.repeated_spans(docs)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    return sorted((str(r[0]), r[1], r[2], r[3], bytes(r[4])) for r in out)


def row(i, text):
    return (i, text, "rk", "s", "k", "n")


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 8))) for _ in range(n))


def corpus(seed, docs=90):
    rng = random.Random(seed)
    shared = [words(rng, rng.randint(20, 120)) for _ in range(4)]
    out = []
    for i in range(docs):
        text = words(rng, rng.randint(1, 160))
        for s in rng.sample(shared, rng.randint(0, 2)):
            at = rng.randrange(len(text) + 1)
            cut = rng.randrange(max(1, len(s) - 150)) if rng.random() < 0.5 else 0
            text = text[:at] + s[cut:] + text[at:]
        if i % 9 == 0 and out:
            text = out[rng.randrange(len(out))][1]                    # a copy
        if i % 11 == 0 and len(text) > 60:
            text = text[:50] + "#" + text[50:]                        # a near copy or a nick
        out.append(row(i, text))
    return out


@pytest.mark.parametrize("bucket", [512, 3])
def test_against_brute_force(spark, monkeypatch, bucket):
    """With buckets of three contexts the shared passages' cores are refined."""
    monkeypatch.setattr(D, "BUCKET", bucket)
    monkeypatch.setattr(D, "BIN_BYTES", 20_000)
    rows = corpus(4)
    want = plain(rows)
    assert sum(r[2] for r in want) > 10_000 and any(r[3] > 1 for r in want)
    assert found(spark, rows) == want


def test_edges(spark):
    rng = random.Random(9)
    base = words(rng, 90)
    rows = [row(1, None), row(2, ""), row(3, base[:150]), row(4, "ab" * 400), row(5, "x" * 199), row(6, "x" * 200), row(7, "x" * 200), row(8, "y" * 201),
            row(9, base), row(9, base), row(None, base[10:]), row(10, "é" * 90 + base), row(11, words(rng, 30_000)), row(11, "z" + base[:260])]
    assert found(spark, rows) == plain(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert D.remove(empty, D.repeated_spans(empty)).count() == 0


def test_merged_transforms_are_in_order():
    """Every word of every text, in the order of three words from there, classes where they are equal."""
    rng = random.Random(1)
    bodies = [bytes(rng.choice(b"ab") for _ in range(rng.randint(24, 60))) for _ in range(30)] + [b"ab" * 20] * 3 + [b"short", b""]
    text, offset, classes = D.merged(bodies, 3)
    got = [(t, o, c) for t, o, c in zip(text.tolist(), offset.tolist(), classes.tolist()) if o < 2 ** 31 - 1]
    assert sorted(g[:2] for g in got) == [(t, o) for t, b in enumerate(bodies) for o in range(len(b) - 7)]
    whole = [(bodies[t][o:o + 24], c) for t, o, c in got if o + 24 <= len(bodies[t])]
    assert [w for w, _ in whole] == sorted(w for w, _ in whole)
    assert len({w for w, _ in whole}) == len({c for _, c in whole}) == len(set(whole))
    assert any(a == b for a, b in zip(whole, whole[1:]))


def test_orders_beyond_sixteen_bits():
    x = np.random.default_rng(5).integers(0, 200_000, 5000).astype(np.int32)
    assert D.stable_order(x).tolist() == np.argsort(x, kind="stable").tolist()
    assert D.cut_spans(b"abcdefghij", [2 << 16 | 3, 5 << 16 | 1, 3 << 16 | 1, 8 << 16 | 2]) == (6, 2, b"abgh")


def test_contexts_hold_each_window_once():
    rng = random.Random(3)
    texts = [words(rng, n).encode() for n in (3, 200, 60, 500)] + [b"q" * 700, b"", b"ab" * 300]
    begins = np.r_[0, np.cumsum([len(t) for t in texts])]
    doc, core, first, last = D.context_runs(texts, D._Hasher())
    windows = [(d, p) for d, a, b in zip(doc, first, last) for p in range(a, b + 1)]
    assert windows == [(d, p) for d, t in enumerate(texts) for p in range(begins[d], begins[d] + len(t) - D.SPAN + 1)]
    assert all(b <= c and c + D.CORE <= a + D.SPAN for a, b, c in zip(first, last, core))
    x = np.array([5, 1, 1, 9, 7, 8, 2, 2, 6], dtype=np.uint64)
    assert D.sliding_least(x, 3).tolist() == [min(x[i:i + 3]) for i in range(7)]
