"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A text's set are its distinct shingles of ``k`` words (whole sequence as one if it has fewer). Circulant
MinHash needs two permutations of the universe of 2^32: sigma scatters the shingles once, and coordinate j
of the signature is the minimum of pi(sigma(x) + j), the second permutation shifted circularly by j. ``BANDS``
bands of ``ROWS`` coordinates give the buckets: a pair of similarity 0.8 misses all of them with
probability (1 - 0.8^4)^32, about 5e-8.

Texts of equal set are one class. Classes meet in buckets; a bucket is never expanded into all its pairs:

- first it chooses one pivot, the class with the largest buckets (an original rather than a copy), which all
  its classes are compared with. Links merge components, and most buckets then are in one component;
- the classes of a bucket that is still open are compared with those of other components, in blocks of
  ``BLOCK`` classes: first by signatures (a linked pair agrees in ``SKETCH`` of the 128 coordinates but for a
  probability of 1e-8), then on the full sets, inside the group of rows. Only links that join components
  come out, fewer than the group has rows, however many pairs are looked at.

No pair of a bucket is left out: each is compared, or already linked through others, or, by the size of
the sets or their signatures, can't reach the threshold. The pivots' pairs are confirmed on the full sets, streamed to
tasks by (pivot, salt), so that a pivot with very many partners is dealt over many tasks.

Defined cases: null or blank text has an empty set and is linked with nothing; a null doc_id has no
component id and is kept; rows of equal doc_id are one node, each row with its own set size; repeated
rows get equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import chunks, drop_written, row_key, small_batches, written
from starhouse.llm.graph import components

BANDS, ROWS = 32, 4
#: Classes of a bucket, and sizes of their sets in all, that are compared with each other in one group of rows;
#: two blocks in another.
BLOCK, BLOCK_SHINGLES = 512, 1_000_000
#: Share of agreeing coordinates below which an open bucket's pair isn't looked at: 0.8 less 5.7 standard deviations.
SKETCH = 0.6
#: Partners of a pivot that share one copy of its text.
SALT_ROWS = 128
CHUNK_CHARS = 1_500_000
_U64 = np.uint64
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                  0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=_U64)


def _mix64(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers (splitmix finaliser)."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _permute32(x: np.ndarray) -> np.ndarray:
    """A permutation of 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    lists = [t.encode().lower().split() if t else [] for t in texts]      # bytes: A-Z and blanks of ASCII only
    flat = [w for ws in lists for w in ws]
    if not flat:
        return [np.empty(0, dtype=_U64) for _ in texts]
    codes, distinct = pd.factorize(np.array(flat, dtype=object))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct), dtype=_U64, count=len(distinct))[codes]
    out, at = [], 0
    for ws in lists:
        n = len(ws)
        h = hashes[at:at + n]
        at += n
        if not n:
            out.append(np.empty(0, dtype=_U64))
            continue
        width = min(k, n)
        acc = np.full(n - width + 1, width, dtype=_U64)
        for j in range(width):
            acc = _mix64(acc * _MULT[0] + h[j:n - width + 1 + j] * _MULT[1 + j % 7])
        out.append(np.unique(acc))
    return out


def signature(shingles: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """Circulant MinHash: coordinate j is min pi(sigma(x) + j mod 2^32)."""
    sigma = _permute32((shingles >> _U64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995))
    shift = np.arange(size, dtype=np.uint32)[:, None]
    best = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    for a in range(0, len(sigma), 512):
        np.minimum(best, _permute32(sigma[a:a + 512][None, :] + shift).min(axis=1), out=best)
    return best


def _band_hashes(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, ROWS).astype(_U64)
    acc = np.arange(BANDS, dtype=_U64)
    for j in range(ROWS):
        acc = _mix64(acc * _MULT[0] + rows[:, j] + _U64(1))
    return acc.view(np.int64)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """``(doc_id, rk, n, cid, bands, sig)``; cid is a hash of the whole set, null for an empty one."""
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in chunks([len(t or "") + 1 for t in texts], CHUNK_CHARS):
                sets = shingle_sets(texts[a:b], k)
                cid = [int(np.int64(xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63)) if len(s) else None for s in sets]
                sig = [signature(s) if len(s) else None for s in sets]
                yield pd.DataFrame({
                    "id": batch["id"].iloc[a:b].array, "no_id": batch["no_id"].iloc[a:b].array, "rk": batch["rk"].iloc[a:b].array, "n": [len(s) for s in sets],
                    "cid": pd.array(cid, dtype="Int64"), "bands": [None if g is None else _band_hashes(g) for g in sig], "sig": [None if g is None else g.tobytes() for g in sig]})

    small_batches(docs.sparkSession)
    # a null among longs would make pandas read them as floats
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"),
                       row_key("doc_id", "text").alias("rk"), "text")
    return rows.mapInPandas(made, "id long, no_id boolean, rk long, n long, cid long, bands array<long>, sig binary") \
        .select(F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "rk", "n", "cid", "bands", "sig")


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets reach the threshold. Texts of b, and once for each
    salt the text of a before them, are streamed in order of (a, salt)."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(SALT_ROWS)).alias("salts"))
    with_text = pairs.join(texts.select(F.col("cid").alias("b"), "text"), "b")
    others = with_text.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"), F.lit(False).alias("first"), "b", "text")
    pivots = sizes.join(texts.select(F.col("cid").alias("a"), "text"), "a") \
        .select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(True).alias("first"), F.lit(0).cast("long").alias("b"), "text")
    rows = pivots.unionByName(others).repartition("a", "salt").sortWithinPartitions("a", "salt", F.desc("first"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivot, of = None, None
        for batch in batches:
            texts = batch["text"].tolist()
            for x, y in chunks([len(t or "") + 1 for t in texts], CHUNK_CHARS):
                part = batch.iloc[x:y]
                links = []
                for a, first, s in zip(part["a"], part["first"], shingle_sets(texts[x:y], k), strict=True):
                    if first:
                        pivot, of = s, a
                        links.append(False)
                        continue
                    assert a == of
                    common = np.intersect1d(pivot, s, assume_unique=True).size
                    links.append(100 * common >= percent * (len(pivot) + len(s) - common))
                yield part.loc[links, ["a", "b"]]

    return rows.mapInPandas(compare, "a long, b long")


def _one_text(docs: DataFrame, sigs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(cid, text)`` of one row of each wanted class. Rows of one key are the same text and lie together after the join: of
    several, one is taken there, so that texts are exchanged once."""
    rep = sigs.join(wanted, "cid").groupBy("cid").agg(F.min("rk").alias("rk"))
    keyed = docs.select(row_key("doc_id", "text").alias("rk"), "text")
    return keyed.join(rep.hint("merge"), "rk").groupBy("rk").agg(F.first("cid").alias("cid"), F.first("text").alias("text")).select("cid", "text")


def _meeting(group: pd.DataFrame, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of one block, or of two blocks, of a bucket with the rows they have to be compared with: another
    component, sizes that allow the threshold, signatures that agree in at least ``SKETCH`` of the
    coordinates, and no earlier band that they share (so a pair is met once, not in each of its buckets)."""
    sig = np.frombuffer(b"".join(group["sig"]), dtype=np.uint32).reshape(len(group), -1)
    band = int(np.flatnonzero(_band_hashes(sig[0]) == group["bucket"].iloc[0])[0])
    k, n, at = (group[c].to_numpy() for c in ("k", "n", "at"))
    one = group["i"].iloc[0] == group["j"].iloc[0]
    left = np.arange(len(group)) if one else np.flatnonzero(at == group["i"].iloc[0])
    right = left if one else np.flatnonzero(at == group["j"].iloc[0])
    for pos, x in enumerate(left):
        others = right[pos + 1:] if one else right
        others = others[(k[others] != k[x]) & (100 * np.minimum(n[others], n[x]) >= percent * np.maximum(n[others], n[x]))]
        if not len(others):
            continue
        same = sig[others] == sig[x]
        first = same.reshape(len(others), BANDS, ROWS).all(axis=2).argmax(axis=1)
        others = others[(first == band) & (same.mean(axis=1) >= SKETCH)]
        if len(others):
            yield x, others


def _confirmed(group: pd.DataFrame, k: int, percent: int) -> pd.DataFrame:
    """Links (a, b), confirmed on the full sets, that join the components of a group as all its links would:
    fewer rows than the group has."""
    sets = [s for x, y in chunks([len(t) + 1 for t in group["text"]], CHUNK_CHARS) for s in shingle_sets(group["text"].iloc[x:y].tolist(), k)]
    codes, distinct = pd.factorize(np.concatenate(sets))
    size = np.array([len(s) for s in sets])
    end = np.cumsum(size)
    cid, (comp, _) = group["cid"].to_numpy(), pd.factorize(group["k"])
    mark = np.zeros(len(distinct), dtype=np.int32)
    out = []
    for x, others in _meeting(group, percent):
        others = others[comp[others] != comp[x]]
        if not len(others):
            continue
        own = codes[end[x] - size[x]:end[x]]
        mark[own] = 1
        flat = np.concatenate([codes[end[y] - size[y]:end[y]] for y in others])
        common = np.add.reduceat(mark[flat], np.cumsum(size[others]) - size[others])
        mark[own] = 0
        for y in others[100 * common >= percent * (size[x] + size[others] - common)]:
            if comp[y] != comp[x]:
                out.append((cid[x], cid[y]))
                comp[comp == comp[y]] = comp[x]
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)


def _open_links(open_rows: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between the components that meet in the buckets of ``open_rows``. Signatures say which rows of a
    group have anybody to be compared with; only those fetch their texts."""
    def meet(group: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(group), dtype=bool)
        for x, others in _meeting(group, percent):
            hit[x] = True
            hit[others] = True
        return group[hit]

    def confirm(group: pd.DataFrame) -> pd.DataFrame:
        return _confirmed(group, k, percent)

    group = ["bucket", "i", "j"]
    met = written(open_rows.groupBy(*group).applyInPandas(meet, open_rows.schema), "minhash-open")
    return met.join(texts, "cid").groupBy(*group).applyInPandas(confirm, "a long, b long")


def links(docs: DataFrame, sigs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between classes that span every component of the similarity graph."""
    classes = sigs.where("cid IS NOT NULL").groupBy("cid").agg(F.first("n").alias("n"), F.first("bands").alias("bands"))
    members = classes.select(F.explode("bands").alias("bucket"), "cid", "n")
    shared = members.groupBy("bucket").agg(F.count("*").alias("m"), F.sum("n").alias("w")).where("m > 1")
    members = written(members.join(shared, "bucket").select("bucket", "cid", "n", "m", "w"), "minhash-members")
    texts = written(_one_text(docs, sigs, members.select("cid").distinct()), "minhash-texts")
    # the text that others were copied from has the largest buckets: the first pivot of its buckets
    central = members.groupBy("cid").agg(F.sum("m").alias("central"))
    pivots = members.join(central, "cid").groupBy("bucket").agg(F.max(F.struct("central", "cid", "n")).alias("p"))
    star = members.join(pivots, "bucket").where("cid <> p.cid AND 100 * least(n, p.n) >= %d * greatest(n, p.n)" % percent)
    pairs = written(star.select(F.col("p.cid").alias("a"), F.col("cid").alias("b")).distinct(), "minhash-pairs")
    found = written(_verified(pairs, texts, k, percent), "minhash-links")
    comps = components(found, "minhash-components")
    merged = members.where("m > 2").join(comps.withColumnsRenamed({"node": "cid", "comp": "k"}), "cid", "left").withColumn("k", F.coalesce("k", "cid"))
    still = merged.groupBy("bucket").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).where("lo < hi").select("bucket")
    signed = sigs.where("cid IS NOT NULL").groupBy("cid").agg(F.first("sig").alias("sig"))
    blocks = F.ceil(F.greatest(F.col("m") / F.lit(BLOCK), F.col("w") / F.lit(BLOCK_SHINGLES))).cast("int")
    rest = merged.join(still, "bucket").withColumn("at", F.pmod(F.xxhash64("cid"), blocks).cast("int")) \
        .select("bucket", "cid", "n", "k", "at", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("to")) \
        .select("bucket", "cid", "n", "k", "at", F.least("at", "to").alias("i"), F.greatest("at", "to").alias("j"))
    new = written(_open_links(rest.join(signed, "cid"), texts, k, percent), "minhash-more-links")
    drop_written(members, texts, pairs, found)
    return new.unionByName(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")))


def dedup(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, rk, n_shingles, component_id, kept)``, a row per document row; rk: `row_key` of id and text."""
    sigs = written(signatures(docs.select("doc_id", "text"), k), "minhash-signatures")
    found = links(docs.select("doc_id", "text"), sigs, k, percent)
    # rows of one doc_id are one node, whatever their texts
    same_id = sigs.where("cid IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("b")).where("a <> b")
    many = sigs.where("cid IS NOT NULL").join(same_id.select("doc_id", "a"), "doc_id").select("a", F.col("cid").alias("b"))
    comps = components(found.select("a", "b").unionByName(many), "minhash-components")
    sigs = sigs.join(comps.withColumnsRenamed({"node": "cid"}), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    least = sigs.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("least"))
    own = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce(F.least("least", "doc_id"), "doc_id"))
    return sigs.join(least, "comp", "left").select("doc_id", "rk", F.col("n").alias("n_shingles"), own.alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
