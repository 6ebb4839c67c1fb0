"""Suffix-array dedup: bytes of repeated long strings, from merged Burrows-Wheeler transforms of shards.

A string of `SPAN` bytes that starts at two places, in one document or two, is repeated, and every byte of it is removed.

1. Every window of SPAN bytes chooses the place of the least hash among its `CORE`-byte strings, ties to the
   left. The choice depends on the window's bytes alone, so equal windows choose equal cores at equal
   offsets. Neighbour windows mostly choose the same place: a run of them is one *context*, the bytes of the
   run, and every window is in exactly one. A context is one narrow row: hashes of core and of content.
2. Rows are range-partitioned by (core, content, row) and sorted, so that a core that a third of all documents
   hold is dealt to many tasks. A context that occurs twice is repeated as a whole. Cores with one
   context are done. Of the others, one row for each distinct context goes on with its bytes.
3. Cores with more than `BUCKET` contexts are refined: the windows of a context are split by their offset into
   the intervals of `LEVELS`, and an interval's windows share a longer core, which is the new key. Contexts alone
   under their key hold nothing repeated; equal ones are repeated as a whole; a single offset's core is
   the whole window, so the last level settles all.
4. The remaining contexts are gathered by key into bins. A symbol is `WORD` bytes, so a context is as many strings
   of symbols as a word has bytes, one for each remainder of the offset, and their suffixes are all its
   suffixes. A bin is split into shards, and each shard's Burrows-Wheeler transform is built by sorting its own
   suffixes. The transforms are merged by refining their interleave: after k rounds, each a stable sort by
   the preceding symbol and a step back, all suffixes stand in the order of their first k symbols, and
   equal prefixes are intervals. No suffix is sorted anew. After SPAN / WORD rounds an interval that holds two
   windows is a repeated string.
5. The spans of each document are joined to its text. Both joins with the texts first drop the documents that
   a bitmap of fixed size (`SIEVE_BITS`) knows to have no row on the other side.

The windows of a context all hold its core, so the removed bytes of a context are one span.
Content is identified by 64-bit hashes of core and of context together; windows are otherwise compared in full.

Defined cases: null text is empty; texts under SPAN bytes lose nothing; repeated rows are each other's copies
and lose all their windows; equal doc_id with different text are different documents; an empty table gives no
rows; other columns are kept, those named like results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import chunks, row_key, written

SPAN = 200
CORE = 64
#: Distinct contexts of a key that are compared by merging; more are refined first, by offset intervals of 2^level.
BUCKET = 4096
LEVELS = (6, 4, 2, 0)
#: Bytes of a bin, about, shards that it is merged from, and bytes of a symbol, which divide SPAN.
BIN_BYTES = 50_000
SHARDS = 4
WORD = 8
#: Bits of the bitmap that keeps documents without rows on the other side out of a join, at most.
SIEVE_BITS = 1 << 25
CHUNK_BYTES = 200_000
_BASE = 0x9E3779B97F4A7C15
_CONTEXT = "key long, body binary, off int, m int, rk long, at long, shared boolean"
_RESULTS = ("n_bytes", "n_removed", "n_spans", "kept")


class _Hasher:
    """Hashes of all strings of CORE bytes, by prefix sums of powers modulo 2^64."""

    def __init__(self):
        self.values = np.random.default_rng(12).integers(0, 2 ** 63, 256, dtype=np.uint64)
        self.powers = self.inverse = np.ones(1, dtype=np.uint64)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if len(self.powers) < n:
            for name, base in (("powers", _BASE), ("inverse", pow(_BASE, -1, 2 ** 64))):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.powers[:n], out=sums[1:])
        h = (sums[CORE:] - sums[:-CORE]) * self.inverse[:n - CORE + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values, from running minima of blocks in both directions."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def context_runs(texts: list[bytes], hasher: _Hasher):
    """(document, core place, first window, last window) of the contexts, places from the start of all texts."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    if len(data) < SPAN:
        return (np.zeros(0, dtype=np.int64),) * 4
    key = (hasher(data) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(data) - CORE + 1, dtype=np.uint64)
    chosen = (sliding_least(key, SPAN - CORE + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.ones(len(data), dtype=bool)
    for size, end in zip(map(len, texts), ends.tolist(), strict=True):
        inside[end - min(size, SPAN - 1):end] = False              # such a window would cross the end
    p = np.flatnonzero(inside)
    if not len(p):
        return (np.zeros(0, dtype=np.int64),) * 4
    a = chosen[p]
    first = np.flatnonzero(np.r_[True, (np.diff(a) != 0) | (np.diff(p) != 1)])
    last = np.r_[first[1:], len(p)] - 1
    return np.searchsorted(ends, p[first], side="right"), a[first], p[first], p[last]


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(k, c, u, rk, span) of every context; span: first window << 16 | core's offset << 8 | windows - 1."""
    hasher, digest = _Hasher(), xxhash.xxh3_64_intdigest
    for batch in batches:
        texts = [(t or "").encode() for t in batch["text"].tolist()]
        rks = batch["rk"].to_numpy()
        for i, j in chunks([len(t) for t in texts], CHUNK_BYTES):
            doc, core, first, last = context_runs(texts[i:j], hasher)
            if not len(doc):
                continue
            data = memoryview(b"".join(texts[i:j]))
            begins = np.r_[0, np.cumsum([len(t) for t in texts[i:j]])][doc]
            yield pd.DataFrame({
                "k": _signed([digest(data[a:a + CORE]) for a in core.tolist()]),
                "c": _signed([digest(data[a:b + SPAN]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]),
                "u": (np.arange(len(doc)) % 1024).astype(np.int32), "rk": rks[i:j][doc],
                "span": (first - begins) << 16 | (core - first) << 8 | (last - first)})


_MARK = "kind int, rk long, k long, c long, span long, n long, full boolean, probe boolean"


def _mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Decides rows sorted by (k, c): kind 0. The first and last core of a partition can go on in another, so the first
    row here of each of their contexts comes out undecided (kind 1; the context's other rows are repeated), with the
    core's numbers (kind 2: c and span its least and greatest context) and the outermost contexts' (kind 3). A
    partition is held as a whole."""
    b = pd.concat(list(batches) or [pd.DataFrame({x: np.zeros(0, np.int64) for x in ("k", "c", "rk", "span")})])
    n = len(b)
    if not n:
        return
    k, c, rk, span = (b[x].to_numpy() for x in ("k", "c", "rk", "span"))
    new_k = np.r_[True, k[1:] != k[:-1]]
    new_c = new_k | np.r_[True, c[1:] != c[:-1]]
    run_k, run_c = np.cumsum(new_k) - 1, np.cumsum(new_c) - 1
    n_c = np.bincount(run_c)
    contexts = np.bincount(run_k[new_c])                 # distinct contexts of each core
    count = n_c[run_c]
    edge = (run_k == 0) | (run_k == run_k[-1])
    full, mixed = count >= 2, contexts[run_k] >= 2

    def rows(at, kind, **change):
        return pd.DataFrame({"kind": np.int32(kind), "rk": rk[at], "k": k[at], "c": c[at], "span": span[at], "n": count[at],
                             "full": full[at], "probe": new_c[at] & mixed[at], **change})

    yield rows(np.flatnonzero(~edge & (full | (new_c & mixed))), 0)
    yield rows(np.flatnonzero(edge & ~new_c), 0, probe=False)
    yield rows(np.flatnonzero(edge & new_c), 1, probe=True)
    for run in sorted({0, run_k[-1]}):
        own = np.flatnonzero(run_k == run)
        yield rows(own[:1], 2, n=len(own), c=c[own[:1]], span=c[own[-1:]])
    outer = [np.flatnonzero(run_c == run)[:1] for run in sorted({0, run_c[-1]})]
    yield rows(np.concatenate(outer), 3)


def _decided(docs: DataFrame) -> DataFrame:
    """(rk, k, span, full, probe): contexts that are repeated as a whole, and those to be compared."""
    found = docs.select(row_key("doc_id", "text").alias("rk"), "text").mapInPandas(_contexts, "k long, c long, u int, rk long, span long")
    found = written(found, "repeat-contexts")            # the range partitioner reads its input twice
    spread = found.repartitionByRange("k", "c", "u", "rk", "span").sortWithinPartitions("k", "c")
    marks = written(spread.drop("u").mapInPandas(_mark, _MARK), "repeat-marks")
    cores = marks.where("kind = 2").groupBy("k").agg((F.min("c") != F.max("span")).alias("mixed"))
    outer = marks.where("kind = 3").groupBy("k", "c").agg(F.sum("n").alias("total"))
    open_rows = marks.where("kind = 1").join(F.broadcast(cores), "k") \
        .join(F.broadcast(outer), ["k", "c"], "left")    # two rows a partition at most
    return marks.where("kind = 0").select("rk", "k", "span", "full", "probe").unionByName(open_rows.select(
        "rk", "k", "span", (F.coalesce("total", "n") >= 2).alias("full"), (F.col("probe") & F.col("mixed")).alias("probe")))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the contexts to be compared."""
    columns = ["key", "body", "off", "m", "rk", "at", "shared"]
    for batch in batches:
        out, held = [], 0
        for rk, text, keys, spans, shared in zip(*(batch[c].tolist() for c in ("rk", "text", "keys", "spans", "shared")), strict=True):
            data = text.encode()
            for key, span, full in zip(keys, spans, shared, strict=True):
                at, off, m = int(span) >> 16, int(span) >> 8 & 255, (int(span) & 255) + 1
                out.append((key, data[at:at + m - 1 + SPAN], off, m, rk, at, bool(full)))
                held += m + SPAN
            if held > 8 * CHUNK_BYTES:
                yield pd.DataFrame(out, columns=columns)
                out, held = [], 0
        if out:
            yield pd.DataFrame(out, columns=columns)


def _halves(level: int):
    """Contexts split by offset into intervals of 2^level, each under the hash of the core that its windows share."""
    size = 1 << level

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                least = r.off - r.m + 1                   # offsets of the core in the windows: least .. off
                for low in range(least // size * size, r.off + 1, size):
                    a, b = max(low, least), min(low + size - 1, r.off)
                    core = r.body[r.off - low:r.off - (low + size - 1) + SPAN]
                    start = r.off - b
                    out.append((xxhash.xxh3_64_intdigest(core, seed=low << 4 | level), r.body[start:r.off - a + SPAN], b, b - a + 1, r.rk, r.at + start, r.shared))
            df = pd.DataFrame(out, columns=["key", "body", "off", "m", "rk", "at", "shared"])
            yield df.assign(key=_signed(df["key"].tolist()))
    return made


def _packed(first, length):
    """A span as one number; spans of contexts are short."""
    return (F.shiftleft(first.cast("long"), 16) + length).alias("span")


def _span_rows(rows: DataFrame) -> DataFrame:
    return rows.where("NOT shared").select("rk", _packed(F.col("at"), F.col("m") - 1 + SPAN))


def _refined(contexts: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Contexts whose keys have at most BUCKET of them, and the spans that the others gave on the way."""
    sizes = written(contexts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET).select("key"), "repeat-hot")
    if sizes.limit(1).count() == 0:
        return contexts, []
    hot = F.broadcast(sizes)                              # at most one row for BUCKET contexts
    small, large, spans = [contexts.join(hot, "key", "left_anti")], contexts.join(hot, "key", "left_semi"), []
    for level in LEVELS:
        rows = written(large.mapInPandas(_halves(level), _CONTEXT), "repeat-halves")
        content = F.xxhash64("body")
        keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), (F.min(content) == F.max(content)).alias("same")).where("n > 1")
        known = written(rows.join(keys, "key"), "repeat-halves")
        spans.append(_span_rows(known.where("same")))
        small.append(known.where(f"NOT same AND n <= {BUCKET}").select(*rows.columns))
        large = known.where(f"NOT same AND n > {BUCKET}").select(*rows.columns)
        if not level or large.limit(1).count() == 0:
            break
    out = small[0]
    for df in small[1:]:
        out = out.unionByName(df)
    return out, spans


def stable_order(x: np.ndarray) -> np.ndarray:
    """Stable sort of small non-negative integers, 16 bits at a time."""
    order = np.argsort(x.astype(np.uint16), kind="stable")
    if len(x) and x.max() >= 1 << 16:
        order = order[np.argsort((x >> 16).astype(np.uint16)[order], kind="stable")]
    return order


def symbols(bodies: list[bytes]):
    """(symbol, text, offset) of the texts as strings of words: a text's words at offsets r, r + WORD, ... for each
    remainder r, then a separator, 0. A word is its bytes as a number plus one; UTF-8 has no word of 0xFF alone, and
    words cut short by the end are left out."""
    data = np.frombuffer(b"".join(bodies) + bytes(WORD), dtype=np.uint8).astype(np.uint64)
    n = len(data) - WORD
    word = np.zeros(n, dtype=np.uint64)
    for j in range(WORD):
        word |= data[j:n + j] << np.uint64(8 * (WORD - 1 - j))
    size = np.array([len(b) for b in bodies])
    count = np.maximum(size - WORD + 1, 0)                       # words of each text
    owner = np.repeat(np.arange(len(bodies)), count)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    share = np.maximum(-(-(count[:, None] - np.arange(WORD)) // WORD), 0) + 1     # symbols of each string, separator included
    start = (np.cumsum(share) - share.reshape(-1)).reshape(-1, WORD)
    sym = np.zeros(share.sum(), dtype=np.uint64)
    text, at = np.zeros(len(sym), dtype=np.int32), np.full(len(sym), np.iinfo(np.int32).max, dtype=np.int32)
    place = start[owner, offset % WORD] + offset // WORD
    sym[place] = word[np.repeat(np.cumsum(size) - size, count) + offset] + np.uint64(1)
    text[place], at[place] = owner, offset
    return sym, text, at


def ranks(sym: np.ndarray) -> np.ndarray:
    """Symbols as small integers of the same order; the separator, the least, is 0."""
    return np.unique(sym, return_inverse=True)[1].astype(np.int32)


def suffix_order(sym: np.ndarray) -> np.ndarray:
    """Order of the suffixes of strings that end with 0: up to the separator, then by place. By doubling."""
    n = len(sym)
    ends = np.flatnonzero(sym == 0)
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)          # symbols before the separator
    rank, h, classes = sym, 1, 0
    while True:
        after = np.zeros(n, dtype=np.int32)
        at = np.flatnonzero(left >= h)
        after[at] = rank[at + h] + 1
        order = stable_order(after)
        order = order[stable_order(rank[order])]
        a, b = rank[order], after[order]
        dense = np.zeros(n, dtype=np.int32)
        np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]), out=dense[1:])
        rank = np.empty(n, dtype=np.int32)
        rank[order] = dense
        if dense[-1] + 1 == classes or h > left.max():
            return order
        classes, h = dense[-1] + 1, 2 * h


def interleave(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, classes): all shards' rows (numbered shard by shard) in the order of their first ``depth`` symbols, and
    the interval of equal prefixes of each."""
    bwt = np.concatenate(transforms)
    back, dollars, base = np.empty(len(bwt), dtype=np.int32), [], 0
    for t in transforms:
        back[base + stable_order(t)] = np.arange(base, base + len(t), dtype=np.int32)
        dollars.append(np.arange(base, base + np.count_nonzero(t == 0), dtype=np.int32))
        base += len(t)
    dollars = np.concatenate(dollars)
    rows, classes, intervals = np.arange(len(bwt), dtype=np.int32), np.zeros(len(bwt), dtype=np.int32), 1
    for _ in range(depth):
        x = bwt[rows]
        order = stable_order(x)
        x, held = x[order], classes[order]
        rows = back[rows[order]]
        rows[:len(dollars)] = dollars                     # nothing precedes a string: separators keep their order
        new = (x[1:] != x[:-1]) | (held[1:] != held[:-1])
        new[:len(dollars) - 1] = False
        classes = np.zeros(len(x), dtype=np.int32)
        np.cumsum(new, out=classes[1:])
        if classes[-1] + 1 == intervals:                  # no interval was cut: none will be
            break
        intervals = classes[-1] + 1
    return rows, classes


def merged(bodies: list[bytes], depth: int):
    """(text, offset, class) of all words of the texts, in the order of ``depth`` words from there."""
    sym, text, at = symbols(bodies)
    sym = ranks(sym)
    ends = np.flatnonzero(sym == 0)
    cuts = [0, *(ends[len(bodies) * (i + 1) // SHARDS * WORD - 1] + 1 for i in range(SHARDS) if len(bodies) * (i + 1) // SHARDS)]
    places, transforms = [], []
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            order = suffix_order(sym[a:b])
            transforms.append(sym[a:b][order - 1])        # before a string stands the separator of another
            places.append(order + a)
    rows, classes = interleave(transforms, depth)
    place = np.concatenate(places)[rows]
    return text[place], at[place], classes


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """(rk, span) of the contexts of a bin with repeated windows."""
    m, rk, at, shared = (rows[c].to_numpy() for c in ("m", "rk", "at", "shared"))
    text, offset, classes = merged(rows["body"].tolist(), SPAN // WORD)
    window = offset < m[text]
    hit = window & (np.bincount(classes[window], minlength=classes[-1] + 1)[classes] >= 2) & ~shared[text].astype(bool)
    least, most = np.full(len(m), SPAN * 2), np.full(len(m), -1)
    np.minimum.at(least, text[hit], offset[hit])
    np.maximum.at(most, text[hit], offset[hit])
    found = most >= 0
    return pd.DataFrame({"rk": rk[found], "span": (at + least)[found] << 16 | (most - least + SPAN)[found]})


def _sieve(docs: DataFrame, keys: DataFrame, found: bool) -> DataFrame:
    """Rows of ``docs`` whose rk may be in ``keys`` (or surely isn't), by a bitmap: 64 bits a row, of bounded size."""
    bits = max(1 << 10, min(SIEVE_BITS, 16 * keys.count()))
    bit = F.pmod(F.xxhash64("rk", F.lit(1)), F.lit(bits))
    word, mask = F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, CAST(at AS INT))")
    table = keys.select(word, F.pmod(bit, F.lit(64)).alias("at")).groupBy("word").agg(F.bit_or(mask).alias("mask"))
    marked = docs.withColumn("at", F.pmod(bit, F.lit(64))).join(F.broadcast(table.withColumnRenamed("word", "w")), word == F.col("w"), "left")
    hit = F.coalesce(F.col("mask").bitwiseAND(mask) != 0, F.lit(False))
    return marked.where(hit if found else ~hit).drop("at", "w", "mask")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``(rk, spans)`` of the document rows that hold repeated strings: an array of start << 16 | length; spans may overlap."""
    decided = written(_decided(docs), "repeat-decided")
    probes = decided.where("probe").groupBy("rk").agg(F.collect_set(F.struct("k", "span", "full")).alias("p"))
    probes = written(probes.select("rk", F.col("p.k").alias("keys"), F.col("p.span").alias("spans"), F.col("p.full").alias("shared")), "repeat-probes")
    texts = _sieve(docs.select(row_key("doc_id", "text").alias("rk"), "text"), probes.select("rk"), True)
    contexts = written(texts.join(probes, "rk").mapInPandas(_cut, _CONTEXT), "repeat-texts")
    small, spans = _refined(contexts)
    total = contexts.agg(F.sum(F.length("body"))).first()[0] or 0
    bins = max(1, -(-total // BIN_BYTES))
    dealt = small.withColumn("bin", F.pmod(F.xxhash64("key"), F.lit(bins)))
    spans.append(dealt.groupBy("bin").applyInPandas(_merged, "rk long, span long"))
    first, last = F.shiftright("span", 16), F.col("span").bitwiseAND(255)
    out = decided.where("full").select("rk", _packed(first, last + SPAN))
    for df in spans:
        out = out.unionByName(df)
    return out.groupBy("rk").agg(F.collect_set("span").alias("spans"))


def cut_spans(data: bytes, spans) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs removed, bytes kept); spans may overlap, and those that touch are one run."""
    packed = np.sort(np.asarray(spans, dtype=np.int64))
    start, stop = packed >> 16, np.maximum.accumulate((packed >> 16) + (packed & 0xFFFF))
    new = np.flatnonzero(np.r_[True, start[1:] > stop[:-1]])
    begins, ends = start[new], stop[np.r_[new[1:] - 1, len(stop) - 1]]
    kept = b"".join([data[a:b] for a, b in zip([0, *ends.tolist()], [*begins.tolist(), len(data)], strict=True)])
    return len(data) - len(kept), len(new), kept


def remove(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and the bytes that are kept, which needn't be whole characters."""
    @F.pandas_udf("n_removed long, n_spans long, kept binary")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([cut_spans((t or "").encode(), s) for t, s in zip(texts, spans, strict=True)], columns=["n_removed", "n_spans", "kept"])

    keep = [c for c in docs.columns if c not in _RESULTS]
    whole = F.coalesce("text", F.lit("")).cast("binary")
    spans = written(spans, "repeat-spans")
    d = docs.select(F.struct(*keep).alias("d"), row_key("doc_id", "text").alias("rk"))
    held = _sieve(d, spans.select("rk"), True).join(spans, "rk", "left").withColumn("text", F.col("d.text"))
    n_bytes = F.length(whole).cast("long").alias("n_bytes")
    kept = held.where("spans IS NULL").unionByName(_sieve(d, spans.select("rk"), False).select(
        "d", "rk", F.lit(None).cast("array<long>").alias("spans"), F.col("d.text").alias("text")))
    less = held.where("spans IS NOT NULL").withColumn("cut", cut("text", "spans"))
    return less.select("d.*", n_bytes, "cut.*").unionByName(kept.select(
        "d.*", n_bytes, F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), whole.alias("kept")))
