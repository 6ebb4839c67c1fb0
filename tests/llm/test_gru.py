"""The recurrent model against a slow version, step by step and number by number, and the work it takes."""

import numpy as np
import pytest

from starhouse.llm import lm_scoring
from starhouse.llm.gru import END, GRU, WINDOW


def slow(p, size, x, y, h):
    """Log P of targets ``y`` after inputs ``x`` of one stream, and the last state."""
    n, out = len(h), []
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    for word, target in zip(x, y, strict=True):
        a, g = p["P"][word], h @ p["U"]
        r, z = sigmoid(a[:n] + g[:n]), sigmoid(a[n:2 * n] + g[n:2 * n])
        c = np.tanh(a[2 * n:] + r * g[2 * n:])
        h = (1 - z) * c + z * h
        k, place = divmod(target, size)
        outer, inner = h @ p["Wc"] + p["bc"], h @ p["Ww"][k] + p["bw"][k]
        out.append(outer[k] - np.log(np.exp(outer).sum()) + inner[place] - np.log(np.exp(inner).sum()))
    return np.array(out), h


def model(vocab=30, hidden=5, dtype=np.float64):
    m, rng = GRU(vocab, hidden), np.random.default_rng(3)
    m.p = {k: (w + rng.normal(0, 0.3, w.shape)).astype(dtype) for k, w in m.p.items()}
    return m


def test_gradients_are_those_of_the_slow_loss():
    m, rng = model(), np.random.default_rng(1)
    x, y, h = rng.integers(0, 30, (7, 3)), rng.integers(0, 30, (7, 3)), rng.normal(0, 0.5, (3, 5))
    loss = lambda p: -sum(slow(p, m.size, x[:, j], y[:, j], h[j])[0].sum() for j in range(3))
    g, after = m.window_grads(x, y, h)
    assert np.allclose(after, [slow(m.p, m.size, x[:, j], y[:, j], h[j])[1] for j in range(3)])
    for k, w in m.p.items():
        for at in rng.permutation([i for i in np.ndindex(w.shape) if w[i] > -1e8])[:40]:
            at, by = tuple(at), 1e-5
            up, down = ({**m.p, k: w.copy()} for _ in range(2))
            up[k][at] += by
            down[k][at] -= by
            assert (loss(up) - loss(down)) / (2 * by) == pytest.approx(g[k][at], rel=1e-4, abs=1e-6), (k, at)


def test_documents_of_any_length_score_as_alone():
    """Streams hold documents end to end; none sees the one before it, and an empty list of tokens scores 0."""
    m, rng = model(dtype=np.float32), np.random.default_rng(2)
    docs = [np.append(rng.integers(2, 30, n), END) for n in (0, 1, 900, 3, 0, WINDOW - 1, WINDOW, 60, 61, 5, 1, 1, 200)] + [np.array([], int)]
    p = {k: w.astype(float) for k, w in m.p.items()}
    want = [slow(p, m.size, np.append(END, d[:-1]), d, np.zeros(5))[0].sum() if len(d) else 0 for d in docs]
    for batch in (1, 3, 384):
        assert np.allclose(m.score(docs, batch), want, rtol=1e-4)
    assert m.score([]).shape == (0,)


def test_short_documents_run_beside_a_long_one(monkeypatch):
    """Steps, each a fixed cost, are those of the longest document or of full streams. Before, each batch of documents of like length
    took those of its own longest one."""
    m, steps, forward = model(), [], GRU.forward
    monkeypatch.setattr(GRU, "forward", lambda self, x, *a, **k: steps.append(len(x)) or forward(self, x, *a, **k))
    m.score([np.full(2_000 if i < 5 else 200 + i, END) for i in range(400)], 20)
    total = 5 * 2_000 + sum(200 + i for i in range(5, 400))
    assert total / 20 <= sum(steps) < total / 20 + 2 * 600


def test_words_have_the_hash_of_sql(spark):
    words = [b"", b"a", "é".encode(), b"\xff\xfe", b"x" * 100]
    df = spark.createDataFrame([(w,) for w in words], "w binary").selectExpr("xxhash64(w) AS h")
    assert [r.h for r in df.collect()] == lm_scoring._hashes(words, len(words)).tolist()
