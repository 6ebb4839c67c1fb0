"""The pipeline's rows against a brute-force version, document by document and pair by pair."""

import re
from collections import defaultdict

import pytest
from conftest import SF_SMALL

import corpus_pipeline
from starhouse.llm import language_id
from starhouse.llm.common import table
from starhouse.llm.queries import held_out

BLANK = "".join(map(chr, [32, *range(9, 14)]))


def lower(text):
    return text.encode().lower().decode()


def known_language(docs, model):
    """One text at a time, each with a fresh predictor."""
    out = {}
    for i, text in docs.items():
        label, score = language_id._predictor(model)([text])
        if label[0] != "und" and score[0] >= corpus_pipeline.MIN_LANGUAGE_SCORE:
            out[i] = text
    return out


def without_repeated_lines(docs):
    holders = defaultdict(set)
    key = lambda line: lower(line.strip(BLANK))
    for i, text in docs.items():
        for line in text.split("\n"):
            holders[key(line)].add(i)
    gone = lambda i, line: len(key(line)) >= 10 and min(holders[key(line)]) < i
    out = {i: "\n".join(x for x in text.split("\n") if not gone(i, x)) for i, text in docs.items()}
    return {i: text for i, text in out.items() if text.strip(BLANK) or text == docs[i]}


def without_near_copies(docs):
    def shingles(text):
        ws = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        return {tuple(ws[a:a + 5]) for a in range(max(1, len(ws) - 4))} if ws else set()

    sets, root = {i: shingles(t) for i, t in docs.items()}, {i: i for i in docs}
    ids = sorted(docs)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root[a], root[b]))
                root = {i: x if r == y else r for i, r in root.items()}
    return {i: t for i, t in docs.items() if root[i] == i}


def without_contaminated(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = set()
    for t in items:
        ws = words(t)
        windows |= {tuple(ws[a:a + 13]) for a in range(max(1, len(ws) - 12))} if ws else set()
    lengths = {len(w) for w in windows}

    def clean(text):
        ws, hit = words(text), set()
        for n in lengths:
            for a in range(len(ws) - n + 1):
                if tuple(ws[a:a + n]) in windows:
                    hit |= set(range(a, a + n))
        return not hit or 20 * len(hit) < len(ws)

    return {i: t for i, t in docs.items() if clean(t)}


@pytest.fixture(scope="module")
def got(spark):
    return corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "text", "source", "slot").collect()


def test_rows_equal_brute_force(spark, got):
    source = table(spark, SF_SMALL, "documents")
    docs = {r.doc_id: r.text or "" for r in source.collect()}
    assert len(docs) == source.count()
    model = language_id.fit(source.where(~held_out(4)))
    kept = without_near_copies(without_repeated_lines(known_language(docs, model)))
    want = without_contaminated(kept, [r.text for r in table(spark, SF_SMALL, "benchmark").collect()])
    assert 0 < len(want) < len(docs) and len(got) == len(want)
    assert {r.doc_id: r.text or "" for r in got} == want


def test_slots_hold_one_source_and_have_no_gaps(got):
    assert len({(r.slot, r.source) for r in got}) == len({r.slot for r in got})
    assert {r.slot for r in got} == set(range(max(r.slot for r in got) + 1))
