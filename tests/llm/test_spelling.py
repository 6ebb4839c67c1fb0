"""Spelling variants against brute force: counting, near words, forms and roots, on generated and edge rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from starhouse.llm import spelling as S

SCHEMA = "doc_id long, text string, word string, n string, key string"


def plain_counts(rows):
    total = Counter()
    for doc, text in [r[:2] for r in rows]:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode()) & 0xFFFFFFFF
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def edits(w, letters):
    out = {w[:i] + w[i + 1:] for i in range(len(w))}
    for c in letters:
        out |= {w[:i] + c + w[i:] for i in range(len(w) + 1)} | {w[:i] + c + w[i + 1:] for i in range(len(w))}
    return out - {w}


def plain(rows):
    counts = plain_counts(rows)
    letters = set("".join(counts))
    near = {w: [x for x in edits(w, letters) if x in counts] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), counts[form[w]] if form[w] else -1) for w, n in counts.items())


def found(spark, rows):
    out = S.group(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in out)


def generated(docs=400, seed=2):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeéÀß") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    stems += [s[:i] + rng.choice("abcÿ") + s[i + rng.randint(0, 1):] for s in stems for i in (0, 3, len(s))]
    weights = [1 / (1 + i % 60) ** 2 for i in range(len(stems))]
    return [(i, " ".join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(stems, weights, k=120)) + "; ×÷ Ab9cdefgh", "x", "y", "z") for i in range(docs)]


@pytest.mark.parametrize("block", [4096, 8])
def test_against_brute_force(spark, monkeypatch, block):
    """With blocks of eight words no number of classes is enough, so blocks are split."""
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(S, "CLASSES", (4, 5))
    rows = generated()
    assert len([r for r in plain(rows) if r[1]]) > 20
    assert found(spark, rows) == plain(rows)


def test_edges_and_chains(spark):
    long = "ab" * 3000
    text = " ".join(["chainaa"] * 5 + ["chainab"] * 25 + ["chainbb"] * 125 + [long] * 5 + [long + "c"] * 30 + ["stopit"] * 5 + ["stipot"] * 9)
    rows = [(1, text, None, None, None), (None, "Nullid " * 6, None, None, None), (2, None, "a", "b", "c"), (3, "", "", "", ""), (4, "noĀnoĀ 12", "", "", ""),
            (5, "samely " * 4, "", "", ""), (5, "samely " * 4, "", "", "")]
    got = found(spark, rows)
    assert got == plain(rows)
    assert {r[0]: r[2] for r in got}["chainaa"] == "chainbb"
    assert S.group(spark.createDataFrame([], SCHEMA)).count() == 0


def test_verification():
    a = lambda *w: np.stack([np.frombuffer(x, dtype=np.uint8) for x in w])
    assert S.one_replaced(a(b"abc", b"abc", b"abc"), a(b"abd", b"abc", b"xby")).tolist() == [True, False, False]
    assert S.one_inserted(a(b"abcd", b"aabb", b"abcd", b"xabc"), a(b"abd", b"abb", b"bda", b"abc")).tolist() == [True, True, False, True]
