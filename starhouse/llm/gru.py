"""A gated recurrent language model in numpy with a class-factored softmax.

Words are split by frequency into classes; P(word) = P(class | state) P(word | class, state). Training is
truncated backpropagation over windows with the state carried on; scoring carries the state over all
windows of a document, so that a log-likelihood is one of the complete document.
"""

from __future__ import annotations

import heapq
import io

import numpy as np

UNK, END = 0, 1
WINDOW = 24
#: Words below this have many rows in a window, as a rule: ids go by frequency.
FREQUENT = 24


class GRU:
    def __init__(self, vocab: int, hidden: int = 24, seed: int = 7):
        self.h = hidden
        self.size = max(2, int(np.ceil(np.sqrt(vocab))))             # words of a class
        self.classes = -(-vocab // self.size)
        rng = np.random.default_rng(seed)
        n = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)      # noqa: E731
        self.p = {"P": n(vocab, 3 * hidden), "U": n(hidden, 3 * hidden), "Wc": n(hidden, self.classes), "bc": np.zeros(self.classes, np.float32),
                  "Ww": n(self.classes, hidden, self.size), "bw": np.zeros((self.classes, self.size), np.float32)}
        self.rooms: dict[str, np.ndarray] = {}
        last = vocab - (self.classes - 1) * self.size                # places of the last class that no word has
        self.p["bw"][-1, last:] = -1e9

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, h=self.h, **self.p)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> GRU:
        z = np.load(io.BytesIO(data))
        self = cls.__new__(cls)
        self.rooms = {}
        self.p = {k: z[k] for k in z.files if k != "h"}
        self.h, self.classes, self.size = int(z["h"]), *self.p["bw"].shape
        return self

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """A work array for one window, kept for the next: the pages of large fresh ones are cleared each time, which takes longer than the work."""
        size = int(np.prod(shape))
        if name not in self.rooms or len(self.rooms[name]) < size:
            self.rooms[name] = np.empty(size, self.p["U"].dtype)
        return self.rooms[name][:size].reshape(shape)

    def _views(self, flat):
        """Parts of a vector in the parameters' shapes."""
        ends = np.cumsum([w.size for w in self.p.values()])
        return {k: part.reshape(w.shape) for (k, w), part in zip(self.p.items(), np.split(flat, ends[:-1]), strict=True)}

    def _gates(self):
        """Inputs' and states' weights by gate: (3 * vocab, h) and (3, h, h). Those of the two sigmoids are halved, as
        sigmoid(x) = (1 + tanh(x / 2)) / 2."""
        half = np.array([0.5, 0.5, 1], self.p["U"].dtype)[:, None, None]
        by_gate = lambda w, out: np.multiply(w.reshape(-1, 3, self.h).transpose(1, 0, 2), half, out=out)
        vocab = len(self.p["P"])
        return by_gate(self.p["P"], self._room("inputs", 3, vocab, self.h)).reshape(-1, self.h), \
            by_gate(self.p["U"], self._room("states", 3, self.h, self.h))

    def forward(self, x, h, gates, starts: dict | None = None, keep: bool = True):
        """States before and after each of the steps of ``x`` (steps, streams): (steps + 1, streams, h); the gates r and z and the state's
        share of the third (steps, 3, streams, h), and the candidates; without ``keep`` of the last step only. Before step t the streams
        ``starts[t]`` begin anew. All are work arrays, valid until the next call."""
        inputs, states = gates
        steps, n = x.shape
        rows = x[:, None, :] + (np.arange(3) * len(self.p["P"]))[:, None]
        given = inputs.take(rows, axis=0, out=self._room("given", steps, 3, n, self.h), mode="clip")
        hs = self._room("hs", steps + 1, n, self.h)
        gs, cs = self._room("gs", steps if keep else 1, 3, n, self.h), self._room("cs", steps if keep else 1, n, self.h)
        hs[0] = h
        for t in range(steps):
            h, out, g, c, x = hs[t], hs[t + 1], gs[t if keep else 0], cs[t if keep else 0], given[t]
            if starts and t in starts:
                h = h.copy()
                h[starts[t]] = 0
            np.matmul(h, states, out=g)
            rz = g[:2]
            rz += x[:2]
            np.tanh(rz, out=rz)
            rz *= 0.5
            rz += 0.5
            np.multiply(g[0], g[2], out=c)
            c += x[2]
            np.tanh(c, out=c)
            np.subtract(h, c, out=out)
            out *= g[1]
            out += c
        return hs, gs, cs

    def _softmaxes(self, hs, y):
        """Of states ``hs`` (n, h) and targets ``y``: the order by class, the classes' edges, states and targets' (class, place) in that
        order, and for both softmaxes the exponentials (choices, n), their sums and the targets' logits below the largest."""
        cls = y // self.size
        order = np.argsort(cls.astype(np.min_scalar_type(self.classes)), kind="stable")
        hs, cls = hs.take(order, axis=0, out=self._room("sorted", *hs.shape), mode="clip"), cls[order]
        place, edges = y[order] - cls * self.size, np.searchsorted(cls, np.arange(self.classes + 1))
        at, out = np.arange(len(y)), []
        inner = self._room("inner", self.size, len(y))
        for c in np.flatnonzero(np.diff(edges)):
            part = inner[:, edges[c]:edges[c + 1]]
            np.matmul(self.p["Ww"][c].T, hs[edges[c]:edges[c + 1]].T, out=part)
            part += self.p["bw"][c][:, None]
        outer = np.matmul(self.p["Wc"].T, hs.T, out=self._room("outer", self.classes, len(y)))
        outer += self.p["bc"][:, None]
        for logits, target in ((outer, cls), (inner, place)):
            logits -= logits.max(axis=0)
            own = logits[target, at]
            np.exp(logits, out=logits)
            out.append((logits, logits.sum(axis=0), own))
        return order, edges, hs, (cls, place), out

    def log_probs(self, hs, y):
        """Natural log P of targets ``y`` (n) at states ``hs`` (n, h)."""
        order, _, _, _, softmaxes = self._softmaxes(hs, y)
        out = np.empty(len(y), hs.dtype)
        out[order] = sum(own - np.log(total) for _, total, own in softmaxes)
        return out

    def _output_grads(self, hs, y, g):
        order, edges, hs, targets, softmaxes = self._softmaxes(hs, y)
        for (d, total, _), target in zip(softmaxes, targets, strict=True):
            d /= total
            d[target, np.arange(len(y))] -= 1
        d, inner = softmaxes[0][0], softmaxes[1][0]
        g["Wc"][:], g["bc"][:] = hs.T @ d.T, d.sum(axis=1)
        dh = self._room("dh", *hs.shape)
        for c in np.flatnonzero(np.diff(edges)):
            at = slice(edges[c], edges[c + 1])
            g["Ww"][c], g["bw"][c] = hs[at].T @ inner[:, at].T, inner[:, at].sum(axis=1)
            np.matmul(inner[:, at].T, self.p["Ww"][c].T, out=dh[at])
        dh += np.matmul(d.T, self.p["Wc"].T, out=hs)                 # the sorted states aren't needed any more
        hs[order] = dh
        return hs

    def window_grads(self, x, y, h):
        """Gradients of the summed loss of one window (steps, streams), parts of the work array "grads", and the state after it."""
        hs, gs, cs = self.forward(x, h, self._gates())
        steps, n = x.shape
        flat = self._room("grads", sum(w.size for w in self.p.values()))
        flat.fill(0)
        g = self._views(flat)
        dhs = self._output_grads(hs[1:].reshape(-1, self.h), y.reshape(-1), g).reshape(cs.shape)
        r, z, gc, before = gs[:, 0], gs[:, 1], gs[:, 2], hs[:-1]
        by_c, some = self._room("by_c", *cs.shape), self._room("some", *cs.shape)
        by = self._room("by", steps, n, 3, self.h)                   # a state's gradient times this: those of r, z and the state's share
        np.multiply(cs, cs, out=some)
        np.subtract(1, some, out=some)
        np.subtract(1, z, out=by_c)
        np.subtract(before, cs, out=by[:, :, 1])                     # (before - c) z (1 - z)
        by[:, :, 1] *= by_c
        by[:, :, 1] *= z
        by_c *= some                                                 # (1 - z) (1 - c * c)
        np.multiply(by_c, r, out=by[:, :, 2])
        np.subtract(1, r, out=some)
        some *= gc
        np.multiply(by[:, :, 2], some, out=by[:, :, 0])
        back = np.ascontiguousarray(self.p["U"].T)
        carry = np.zeros_like(h)
        for t in range(steps - 1, -1, -1):
            dh = dhs[t]
            dh += carry
            by[t] *= dh[:, None]
            carry = by[t].reshape(n, -1) @ back
            carry += np.multiply(dh, z[t], out=some[t])
        g["U"][:] = before.reshape(-1, self.h).T @ by.reshape(steps * n, -1)
        np.multiply(dhs, by_c, out=by[:, :, 2])                      # the third gate's input is not multiplied by r
        words = x.reshape(-1).astype(np.min_scalar_type(len(self.p["P"])))
        order = np.argsort(words, kind="stable")
        kinds, first = np.unique(words[order], return_index=True)
        rows = by.reshape(steps * n, -1).take(order, axis=0, out=self._room("given", steps * n, 3 * self.h), mode="clip")
        ends, few = np.append(first[1:], len(rows)), int(np.searchsorted(kinds, FREQUENT))
        for k, a, b in zip(kinds[:few], first, ends, strict=False):  # a product is the faster way to add many rows
            g["P"][k] = np.ones(b - a, rows.dtype) @ rows[a:b]
        if few < len(kinds):
            g["P"][kinds[few:]] = np.add.reduceat(rows[first[few]:], first[few:] - first[few], axis=0)
        return g, hs[-1].copy()

    def train(self, tokens: np.ndarray, epochs: int = 3, streams: int = 48, rate: float = 0.006, state: dict | None = None) -> None:
        """Adam over windows of parallel streams of one token sequence (each document ends in END). ``state`` carries the moments
        from one sequence to the next."""
        streams = max(1, min(streams, (len(tokens) - 1) // WINDOW))
        per = (len(tokens) - 1) // streams
        if per < 1:
            return
        x = tokens[:per * streams].reshape(streams, per).T
        y = tokens[1:per * streams + 1].reshape(streams, per).T
        state = {} if state is None else state
        flat = np.concatenate([w.ravel() for w in self.p.values()])
        self.p = self._views(flat)
        m, v = (state.setdefault(k, np.zeros_like(flat)) for k in "mv")
        n = state.get("n", 0)
        for _ in range(epochs):
            h = np.zeros((streams, self.h), np.float32)
            for a in range(0, per, WINDOW):
                _, h = self.window_grads(x[a:a + WINDOW], y[a:a + WINDOW], h)
                n += 1
                w, step = self._room("grads", len(flat)), self._room("step", len(flat))
                scale = 1 / (len(x[a:a + WINDOW]) * streams)
                norm = float(np.sqrt(np.dot(w, w))) * scale
                w *= scale * min(1.0, 1.0 / max(norm, 1e-9))
                np.subtract(w, m, out=step)
                step *= 0.1
                m += step
                np.multiply(w, w, out=step)
                step -= v
                step *= 0.01
                v += step
                np.multiply(v, 1 / (1 - 0.99**n), out=step)
                np.sqrt(step, out=step)
                step += 1e-8
                np.divide(m, step, out=step)
                step *= rate / (1 - 0.9**n)
                flat -= step
        state["n"] = n

    def score(self, docs: list[np.ndarray], batch: int = 384) -> np.ndarray:
        """Natural log-likelihood of each token sequence (END last). Documents are laid end to end in ``batch`` streams of like length, the
        longest first, so that streams stay full while a long document runs; the state begins anew with each document."""
        sizes = np.array([len(d) for d in docs], dtype=np.int64)
        if not sizes.sum():
            return np.zeros(len(docs))
        loads = [(0, s) for s in range(min(batch, len(docs)))]
        streams: list[list[int]] = [[] for _ in loads]
        for i in np.argsort(-sizes, kind="stable").tolist():
            load, s = loads[0]
            streams[s].append(i)
            heapq.heapreplace(loads, (load + int(sizes[i]), s))
        lens = np.zeros(len(streams), dtype=np.int64)
        for load, s in loads:
            lens[s] = load
        by_length = np.argsort(-lens, kind="stable")
        lens = lens[by_length]
        order = np.array([i for s in by_length for i in streams[s]])
        ends = np.cumsum(sizes[order])
        most = int(lens[0])
        y = np.concatenate([docs[i] for i in order])
        x = np.append(END, y[:-1]).astype(np.int64)
        new = np.zeros(len(y), dtype=bool)
        new[(ends - sizes[order])[sizes[order] > 0]] = True
        x[new] = END
        offset = np.cumsum(lens) - lens
        got, gates, t0 = np.zeros(len(y), np.float32), self._gates(), 0
        h = np.zeros((len(lens), self.h), np.float32)
        while t0 < most:
            live = int(np.searchsorted(-lens, -t0, side="left"))       # longer streams come first
            steps = min(most - t0, max(WINDOW, WINDOW * batch // live))
            t = np.arange(t0, t0 + steps)[:, None]
            at = np.minimum(offset[:live] + t, len(y) - 1)
            real = t < lens[:live]
            starts: dict = {}
            for k, stream in zip(*(w.tolist() for w in np.nonzero(new[at] & real)), strict=True):
                starts.setdefault(k, []).append(stream)
            states = self.forward(x[at], h[:live], gates, starts, keep=False)[0]
            h, states, at = states[-1].copy(), states[1:].reshape(-1, self.h), at.reshape(-1)
            if not real.all():
                some = np.flatnonzero(real)
                states, at = states.take(some, axis=0, out=self._room("some", len(some), self.h), mode="clip"), at[some]
            got[at] = self.log_probs(states, y[at])
            t0 += steps
        some, out = sizes[order] > 0, np.zeros(len(docs))
        out[order[some]] = np.add.reduceat(got, (ends - sizes[order])[some], dtype=np.float64)
        return out
