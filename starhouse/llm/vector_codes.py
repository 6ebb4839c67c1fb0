"""Vector code compression: four sub-vector codebooks trained by exact integer k-means over Hilbert-sorted blocks.

Each component x becomes the integer floor(1024 * x), each vector four consecutive parts. A part's integers
are put on a Hilbert curve, and the parts are range-partitioned by (position, curve key, row) and cut into
flat blocks of `BLOCK` parts, written once with their least and greatest components (the box) and their sums.
Copies of one vector, however many, are dealt to many tasks, since the row is part of the key. In each
round a block's box bounds the distance of its parts to every entry: entries whose least possible distance
exceeds another entry's greatest possible one can be nearest to no part. If one entry is left, the block's
sums are added to it as they are; else a matrix product over the entries left gives the exact squared
distances (in doubles while all terms stay under 2^53, else in 64-bit integers). Tasks return one row per
entry that they used; the driver gets the codebooks alone (256 x dimension integers).

Defined cases: rows whose vector is null or holds a null, NaN or infinite component are dropped. Vectors
shorter than the longest (rounded up to a multiple of four) are filled up with zeros. Components are limited to
`_limit`, far beyond any embedding, so that no squared distance leaves 64 bits. Codebooks start with the
smallest ids, ties by the vector itself, null ids last; with fewer than 256 kept rows they have fewer
entries. Repeated rows are coded each. Null labels are one label. An empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import drop_written, written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Parts of a block. The box is tighter in small blocks, a matrix product dearer by the part.
BLOCK = 256
#: Bytes of the curve key that are kept; parts alike in all of them lie in any order, which changes no result.
KEY_BYTES = 32
_CHUNK = 4096
_BLOCK_TYPE = "pos int, rid array<long>, vec binary, lo binary, hi binary, total binary"


def _limit(dim: int) -> int:
    """Greatest magnitude of a component: dim * (2 * limit)^2 is at most 2^62."""
    return int((2.0 ** 60 / max(dim, 1)) ** 0.5)


def hilbert_keys(parts: np.ndarray, lo: int, bits: int) -> np.ndarray:
    """Hilbert curve keys (rows of bytes, most significant first) of integer points in [lo, lo + 2^bits)."""
    n, w = parts.shape
    if not w:
        return np.zeros((n, 0), dtype=np.uint8)
    x = (parts - lo).astype(np.uint32).T.copy()
    q = 1 << (bits - 1)
    while q > 1:                                   # undo excess work from the most significant bit down
        for i in range(w):
            high = (x[i] & q) != 0
            flip = np.where(high, np.uint32(q - 1), np.uint32(0))
            swap = np.where(high, np.uint32(0), (x[0] ^ x[i]) & np.uint32(q - 1))
            x[0] ^= flip ^ swap
            x[i] ^= swap
        q >>= 1
    for i in range(1, w):                          # Gray code
        x[i] ^= x[i - 1]
    t, q = np.zeros(n, dtype=np.uint32), 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[w - 1] & q) != 0, np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= t
    shifts = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    planes = ((x[None, :, :] >> shifts[:, None, None]) & 1).astype(np.uint8)      # bit plane, dimension, row
    return np.packbits(planes.reshape(bits * w, n).T, axis=1)[:, :KEY_BYTES]


def integers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(rid, vec_id, label, q)``: kept rows with their integer components; ``rid`` numbers the rows."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(F.col(vector_col).isNotNull() & finite)
    bound = 2.0 ** 40                              # before the cast; `_limit` is smaller
    q = F.transform(vector_col, lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(bound)), F.lit(-bound))))
    return kept.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), q.alias("q"))


def _matrix(rows, dim: int) -> np.ndarray:
    """Rows of integers, filled up with zeros to ``dim`` columns and limited."""
    out, limit = np.zeros((len(rows), dim), dtype=np.int64), _limit(dim)
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        if size:
            out[at, :size] = np.stack([rows[i] for i in at])
    return np.clip(out, -limit, limit)


def _keyed(rows: DataFrame, dim: int, lo: int, bits: int) -> DataFrame:
    """One row for each part: (pos, key, rid, vec)."""
    w = dim // PARTS

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), _CHUNK):
                part = batch.iloc[a:a + _CHUNK]
                m = _matrix(part["q"].tolist(), dim)
                for pos in range(PARTS):
                    sub = m[:, pos * w:(pos + 1) * w]
                    yield pd.DataFrame({"pos": np.int32(pos), "key": [k.tobytes() for k in hilbert_keys(sub, lo, bits)],
                                        "rid": part["rid"].to_numpy(), "vec": [v.tobytes() for v in sub.astype("<i4")]})

    return rows.select("rid", "q").mapInPandas(made, "pos int, key binary, rid long, vec binary")


def _cut(w: int):
    """Consecutive rows of one position become blocks."""
    def block(pos: int, rids: list, vecs: list) -> dict:
        m = np.frombuffer(b"".join(vecs), dtype="<i4").reshape(len(rids), w).astype(np.int64)
        return {"pos": pos, "rid": rids, "vec": m.astype("<i4").tobytes(), "lo": m.min(0).astype("<i8").tobytes(),
                "hi": m.max(0).astype("<i8").tobytes(), "total": m.sum(0).astype("<i8").tobytes()}

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pos, rids, vecs = None, [], []
        for batch in batches:
            out = []
            for p, rid, vec in zip(batch["pos"].tolist(), batch["rid"].tolist(), batch["vec"].tolist(), strict=True):
                if rids and (p != pos or len(rids) == BLOCK):
                    out.append(block(pos, rids, vecs))
                    rids, vecs = [], []
                pos = p
                rids.append(rid)
                vecs.append(vec)
            if out:
                yield pd.DataFrame(out)
        if rids:
            yield pd.DataFrame([block(pos, rids, vecs)])

    return made


def shortlist(lo: np.ndarray, hi: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Entries, ascending, that can be the nearest (ties included) of some point in the box."""
    below, above = lo - book, book - hi
    least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(1)
    most = (np.maximum(np.abs(book - lo), np.abs(book - hi)) ** 2).sum(1)
    return np.flatnonzero(least <= most.min())


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each point's nearest row of ``book`` (ties: the lower) and the squared distance, exactly."""
    w = max(book.shape[1], 1)
    top = int(max(np.abs(points).max(initial=0), np.abs(book).max(initial=0)))
    kind = np.float64 if 4 * w * top * top < 2 ** 53 else np.int64
    p, b = points.astype(kind), book.astype(kind)
    d = (b * b).sum(1)[None, :] - 2 * (p @ b.T)
    at = d.argmin(1)
    return at, (d[np.arange(len(p)), at] + (p * p).sum(1)).astype(np.int64)


def _blocks(batch: pd.DataFrame, books: np.ndarray, w: int):
    """(row, position, points, shortlist) of the blocks of a batch."""
    as_ints = lambda x: np.frombuffer(x, dtype="<i8")
    for row in batch.itertuples(index=False):
        book = books[row.pos]
        yield row, book, np.frombuffer(row.vec, dtype="<i4").reshape(len(row.rid), w), shortlist(as_ints(row.lo), as_ints(row.hi), book)


def _round(books: np.ndarray, w: int):
    """Task's share of a round: (pos, entry, n, sums) of the entries that its parts are nearest to."""
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(books.shape[:2], dtype=np.int64)
        sums = np.zeros(books.shape, dtype=np.int64)
        for batch in batches:
            for row, book, points, short in _blocks(batch, books, w):
                if len(short) == 1:
                    n[row.pos, short[0]] += len(row.rid)
                    sums[row.pos, short[0]] += np.frombuffer(row.total, dtype="<i8")
                    continue
                at, _ = nearest(points, book[short])
                order = np.argsort(at, kind="stable")
                starts = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
                used = short[at[order[starts]]]
                n[row.pos, used] += np.diff(np.r_[starts, len(at)])
                if w:
                    sums[row.pos, used] += np.add.reduceat(points[order].astype(np.int64), starts, axis=0)
        pos, entry = np.nonzero(n)
        if len(pos):
            yield pd.DataFrame({"pos": pos.astype(np.int32), "entry": entry.astype(np.int32), "n": n[pos, entry], "sums": list(sums[pos, entry])})

    return made


def _coded(books: np.ndarray, w: int):
    """(rid, pos, entry, distance) of each part."""
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, book, points, short in _blocks(batch, books, w):
                at, d = nearest(points, book[short])
                yield pd.DataFrame({"rid": np.asarray(row.rid, dtype=np.int64), "pos": np.int32(row.pos), "entry": short[at].astype(np.int32), "d": d})

    return made


def _next_books(blocks: DataFrame, books: np.ndarray, w: int) -> np.ndarray:
    """The codebooks after one round; entries without parts stay."""
    found = blocks.mapInPandas(_round(books, w), "pos int, entry int, n long, sums array<long>")
    n = found.groupBy("pos", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(w)])
    out = books.copy()
    for row in n.collect():                        # at most PARTS * ENTRIES rows
        out[row[0], row[1]] = [s // row[2] for s in row[3:]]
    return out


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def train(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, DataFrame]:
    """Codebooks (part, entry, component) and the blocks; ``vectors`` as `integers` gives them, written."""
    facts = vectors.agg(F.max(F.size("q")).alias("dim"), F.min(F.array_min("q")).alias("lo"), F.max(F.array_max("q")).alias("hi")).first()
    dim = -(-(facts.dim or 0) // PARTS) * PARTS
    w, limit = dim // PARTS, _limit(dim)
    lo, hi = max(min(facts.lo or 0, 0), -limit), min(max(facts.hi or 0, 0), limit)
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(ENTRIES).select("q").collect()
    start = _matrix([r.q for r in first], dim)
    books = np.ascontiguousarray(start.reshape(len(first), PARTS, w).transpose(1, 0, 2))
    keyed = written(_keyed(vectors, dim, lo, max((hi - lo).bit_length(), 1)), "vector-parts")    # the range partitioner reads its input twice
    spread = keyed.repartitionByRange("pos", "key", "rid").sortWithinPartitions("pos", "key", "rid")
    blocks = written(spread.select("pos", "rid", "vec").mapInPandas(_cut(w), _BLOCK_TYPE), "vector-blocks")
    drop_written(keyed)
    for _ in range(rounds):
        books = _next_books(blocks, books, w)
    return books, blocks


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           rounds: int = ROUNDS) -> DataFrame:
    """``(vec_id, label, code, error, label_error, codebooks_sha256)`` of every kept row."""
    rows = written(integers(vectors, id_col, vector_col, label_col), "vectors")
    books, blocks = train(rows, rounds)
    w = books.shape[2]
    parts = blocks.mapInPandas(_coded(books, w), "rid long, pos int, entry int, d long")
    hexed = F.lower(F.lpad(F.hex(F.col("entry")), 2, "0"))
    code = F.concat(*[F.max(F.when(F.col("pos") == p, hexed)) for p in range(PARTS)])
    coded = parts.groupBy("rid").agg(code.alias("code"), F.sum("d").alias("error"))
    done = written(rows.select("rid", "vec_id", "label").join(coded, "rid").drop("rid"), "vector-codes")
    totals = written(done.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error")), "vector-labels")
    return done.join(totals, F.col("label").eqNullSafe(F.col("l")), "left").select(
        "vec_id", "label", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
