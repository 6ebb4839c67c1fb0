"""The language model learns from all training documents, whole, however many they are."""

import numpy as np

from starhouse.llm import lm_scoring
from starhouse.llm.gru import END, GRU

PAIRS = [(f"left{i}", f"right{i}") for i in range(12)]


def test_word_pairs_are_learned_over_tasks_and_rounds(spark):
    rows = [(i, " ".join(w for j in range(12) for w in PAIRS[(i * 5 + j * j) % 12]), True) for i in range(6000)]
    weights, vocab, _ = lm_scoring.fit(spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(4))
    ids = {w: i + 2 for i, w in enumerate(vocab)}
    seq = lambda ws: np.array([ids[w.encode()] for w in ws] + [END])
    model = GRU.from_bytes(weights)
    right = model.score([seq(PAIRS[i]) for i in range(12)])
    wrong = model.score([seq((PAIRS[i][0], PAIRS[(i + 5) % 12][1])) for i in range(12)])
    assert (right > wrong).mean() > 0.9


def test_vocabulary_is_that_of_all_documents(spark):
    """Close counts, which no sample of 2,500 of the documents ranks right."""
    words = {f"w{k:04d}": 10 + k % 3 for k in range(1200)}
    rows = list(enumerate(f"{w} x{n}y{w}" for w, c in words.items() for n in range(c)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    _, vocab, _ = lm_scoring.fit(docs)
    assert vocab == [w.encode() for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))][:lm_scoring.VOCAB]


def test_frequent_words_end_at_a_count(spark):
    """Words of a count come all or not at all, so no more than asked for."""
    rows = [(f"w{i:03d}".encode(), 9 if i < 3 else 5 if i < 10 else 1) for i in range(200)]
    counts = spark.createDataFrame(rows, "w binary, c long").repartition(5)
    assert lm_scoring.frequent(counts, 50) == [w for w, c in rows if c > 1] and lm_scoring.frequent(counts, 9) == [w for w, c in rows if c > 5]
    assert len(lm_scoring.frequent(counts, 200)) == 200 and lm_scoring.frequent(counts, 2) == [] == lm_scoring.frequent(counts.limit(0), 5)


class _Notes:
    """A model that notes what it is trained on, token by token, and how."""

    def __init__(self):
        self.got = []

    def train(self, tokens, epochs=3, streams=48, rate=0.006, state=None):
        self.got += [(int(t), epochs, streams) for t in tokens[1:]]


def test_a_document_is_learned_alike_whatever_follows():
    """No switch by a task's size: what a task learns from a text isn't another way of learning because there is more text."""
    docs = [[2 + i % 7] * 300 + [END] for i in range(1500)]
    runs = []
    for n in (40, 66, 67, 600, 700, 1500):
        model = _Notes()
        assert lm_scoring.learn(model, docs[:n]) == 301 * n == len(model.got)
        assert [t for t, _, _ in model.got] == [t for d in docs[:n] for t in d]
        runs.append(model.got)
    assert all(a == b[:len(a)] for a, b in zip(runs, runs[1:], strict=False))
