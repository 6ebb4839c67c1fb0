"""Line dedup: range-partitioned line hashes, streamed first occurrences, keep bitmaps.

Every line's key (the line without blanks at both ends, A-Z lower-cased) of at least ``MIN_CHARS`` code
points is hashed. The rows (hash, doc_id, position) are partitioned by range of all three and sorted in
each partition, so that even a line that a third of the documents hold is dealt to many tasks. A task
streams its rows once and marks each with the first document of its hash as far as it knows. Only the
first and last hash of a partition can go on in another one; their first documents (two rows a
partition) are reduced to one per hash and joined back. A line goes if its hash's first document is another one.

`keep_bitmaps` returns, per document row, the number of lines, of dropped lines, and a compressed bitmap
(zlib; bit i of byte i // 8 is line i, 1: keep) instead of text; `apply_bitmaps` makes the texts.

A line key is identified by a 128-bit hash. A document row is identified by doc_id and a hash of its
text. Defined cases: null or empty text is one empty line; rows of equal doc_id are one holder of their
lines; a null doc_id counts as a document after all others; repeated rows get equal results; an empty
table gives no rows; other columns are not touched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import chunks, row_key, small_batches, written

MIN_CHARS = 10
LAST = 2**63 - 1
CHUNK_CHARS = 2_000_000
_BLANKS = " \t\n\v\f\r"
_MARKED = "h1 long, h2 long, doc long, rk long, pos int, first long, edge boolean"


def _lines(docs: DataFrame) -> DataFrame:
    """(h1, h2, doc, rk, pos) of the lines with a long enough key."""
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in chunks([len(t or "") + 1 for t in texts], CHUNK_CHARS):
                digests, owner, pos = [], [], []
                for i in range(a, b):
                    for j, line in enumerate((texts[i] or "").split("\n")):
                        key = line.strip(_BLANKS)
                        if len(key) >= MIN_CHARS:
                            digests.append(xxhash.xxh3_128_digest(key.encode().lower()))     # bytes: A-Z only
                            owner.append(i)
                            pos.append(j)
                h = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                rows = batch.iloc[owner]
                yield pd.DataFrame({"h1": h[:, 0], "h2": h[:, 1], "doc": rows["doc"].to_numpy(), "rk": rows["rk"].to_numpy(),
                                    "pos": np.array(pos, dtype=np.int32)})

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), row_key("doc_id", "text").alias("rk"), "text")
    return rows.mapInPandas(made, "h1 long, h2 long, doc long, rk long, pos int")


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Marks rows sorted by (h1, h2, doc) with the run's first document; ``edge``: the run may have begun
    in an earlier partition. The last run is not known to be one, so its hash comes out once more as
    a row with pos -1."""
    last, edge = None, True
    for b in batches:
        if not len(b):
            continue
        h1, h2, doc = b["h1"].to_numpy(), b["h2"].to_numpy(), b["doc"].to_numpy()
        new = np.empty(len(b), dtype=bool)
        new[0] = last is None or (h1[0], h2[0]) != last[:2]
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        run = np.cumsum(new) - 1                       # -1: goes on from the batch before
        firsts = doc[new]
        first = np.where(run < 0, last[2] if last else 0, firsts[np.maximum(run, 0)] if len(firsts) else 0)
        edges = run < (1 if last is None else 0) if edge else np.zeros(len(b), dtype=bool)
        edge = bool(edges[-1])
        last = (h1[-1], h2[-1], int(first[-1]))
        yield b.assign(first=first, edge=edges)
    if last is not None:
        yield pd.DataFrame({"h1": [last[0]], "h2": [last[1]], "doc": [last[2]], "rk": [0], "pos": [-1],
                            "first": [last[2]], "edge": [True]})


def _marked(docs: DataFrame) -> DataFrame:
    """(rk, pos, dropped) of every line with a long enough key."""
    lines = written(_lines(docs), "lines")          # the range partitioner reads its input twice
    spread = lines.repartitionByRange("h1", "h2", "doc", "pos").sortWithinPartitions("h1", "h2", "doc", "pos")
    marked = written(spread.mapInPandas(_stream, _MARKED), "line-marks")
    edges = marked.where("edge").groupBy("h1", "h2").agg(F.min("first").alias("whole_first"))
    rows = marked.where("pos >= 0").join(F.broadcast(edges), ["h1", "h2"], "left")   # two hashes a partition at most
    return rows.select("rk", "pos", (F.col("doc") != F.coalesce(
        F.least("whole_first", "first"), "first")).alias("dropped"))


def bitmap(n_lines: int, dropped) -> bytes:
    bits = np.ones(n_lines, dtype=np.uint8)
    bits[dropped] = 0
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes())


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """``(rk, n_lines, n_dropped, bitmap)`` by distinct document row that loses lines. They are written, so that the tasks that
    make texts of them don't make them as well, with a second Python worker each."""
    small_batches(docs.sparkSession)
    gone = _marked(docs).where("dropped").groupBy("rk").agg(F.collect_set("pos").alias("gone"))
    sizes = docs.select(row_key("doc_id", "text").alias("rk"),
                        F.size(F.split(F.coalesce("text", F.lit("")), "\n")).alias("n_lines")).groupBy("rk").agg(F.max("n_lines").alias("n_lines"))

    @F.pandas_udf("binary")
    def packed(n: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series([bitmap(a, b) for a, b in zip(n, gone, strict=True)], dtype=object)

    return written(gone.join(sizes, "rk").select("rk", "n_lines", F.size("gone").alias("n_dropped"), packed("n_lines", "gone").alias("bitmap")), "line-bitmaps")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with text without the lines that the bitmaps drop, and n_lines, n_dropped."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def kept(texts: pd.Series, maps: pd.Series) -> pd.Series:
        out = []
        for t, m in zip(texts, maps, strict=True):
            if m is not None:
                lines = t.split("\n")
                bits = np.unpackbits(np.frombuffer(zlib.decompress(m), dtype=np.uint8), bitorder="little")
                t = "\n".join([x for x, b in zip(lines, bits, strict=False) if b])
            out.append(t)
        return pd.Series(out, dtype=object)

    kept = kept.asNondeterministic()        # else a caller's filter on text makes every text twice, in two workers a task
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    d = docs.select(*keep).withColumn("__rk", row_key("doc_id", "text")) \
        .join(bitmaps.select(F.col("rk").alias("__rk"), F.col("n_dropped").alias("__d"), "bitmap"), "__rk", "left")
    out = d.withColumn("__new", F.when(F.col("bitmap").isNotNull(), kept("text", "bitmap")).otherwise(F.col("text")))
    return out.select(*[F.col("__new").alias("text") if c == "text" else F.col(c) for c in keep],
                      F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"),
                      F.coalesce("__d", F.lit(0)).cast("long").alias("n_dropped"))
