"""Vector codes against a plain k-means, box shortlists and curve keys against brute force, edge rows."""

import hashlib
import math

import numpy as np
import pytest

from starhouse.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, code string, rid string"


def plain(rows):
    """Integer k-means as the docstring says, without blocks."""
    ok = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not ok:
        return set()
    dim = -(-max(len(r[1]) for r in ok) // 4) * 4
    ints = [[math.floor(x * 1024) for x in r[1]] + [0] * (dim - len(r[1])) for r in ok]
    order = sorted(range(len(ok)), key=lambda i: (ok[i][0] is None, ok[i][0] or 0, ints[i]))
    w = dim // 4
    part = lambda i, p: ints[i][p * w:(p + 1) * w]
    books = [[part(i, p) for i in order[:256]] for p in range(4)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(4):
        for p in range(4):
            groups = {}
            for i in range(len(ok)):
                groups.setdefault(near(part(i, p), books[p])[1], []).append(part(i, p))
            books[p] = [[sum(c) // len(groups[e]) for c in zip(*groups[e])] if e in groups else books[p][e] for e in range(len(books[p]))]
    found = [[near(part(i, p), books[p]) for p in range(4)] for i in range(len(ok))]
    errors = [sum(d for d, _ in f) for f in found]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted((str(r[0]), "".join(f"{e:02x}" for _, e in f), err, sum(x for x, o in zip(errors, ok) if o[2] == r[2]), sha)
                  for r, f, err in zip(ok, found, errors))


def coded(spark, rows):
    out = V.encode(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in out)


def vectors(n, dim, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(0, 0.4, dim).astype(np.float32).tolist(), int(i) % 3 if i % 7 else None, "c", "r") for i in range(n)]


def test_against_plain_kmeans(spark):
    rows = vectors(700, 8)
    rows += [(1000 + i, rows[5][1], 1, None, None) for i in range(300)]           # copies of one vector
    assert coded(spark, rows) == plain(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(30, 6) + [(100, None, 1, "", ""), (101, [0.5, None, 0.1], 1, "", ""), (102, [nan] * 6, 1, "", ""),
                             (103, [inf] * 6, 2, "", ""), (104, [-0.0001, 0.5], 2, "", ""), (105, [], None, "", ""),
                             (None, [0.25] * 6, None, "", ""), (7, [0.5] * 6, 1, "", ""), (7, [0.5] * 6, 1, "", "")]
    assert coded(spark, rows) == plain(rows)
    assert coded(spark, [(1, [], None, "", "")])[0][1:3] == ("00000000", 0)
    assert coded(spark, [(1, None, 1, "", "")]) == []
    assert V.encode(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_beyond_the_limit(spark):
    out = coded(spark, [(1, [3e38, -3e38, 0.0, 1.0], 1, "", ""), (2, [0.0] * 4, 1, "", "")])
    assert [r[1:3] for r in out] == [("00000000", 0), ("01010101", 0)] or [r[2] for r in out] == [0, 0]


@pytest.mark.parametrize("scale", [40, 2_000_000, 2 ** 27])
def test_nearest_and_shortlist_are_exact(scale):
    rng = np.random.default_rng(1)
    book = rng.integers(-scale, scale, (60, 5))
    points = rng.integers(-scale // 9, scale // 9, (80, 5)) + book[3]
    points[:5] = book[[3, 3, 7, 9, 9]]
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(p, c)), e) for e, c in enumerate(book)) for p in points]
    short = V.shortlist(points.min(0), points.max(0), book)
    at, d = V.nearest(points, book[short])
    assert [(int(x), int(short[i])) for x, i in zip(d, at)] == want
    assert {e for _, e in want} <= set(short.tolist())


def test_curve_visits_every_cell_by_single_steps():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = [k.tobytes() for k in V.hilbert_keys(grid - 4, -4, 3)]
    walk = grid[np.argsort(keys)]
    assert len(set(keys)) == 512 and (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()
