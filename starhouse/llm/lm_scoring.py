"""Language-model scoring of whole documents.

The model (`gru`) knows the ``VOCAB`` most frequent words of all training documents and is trained on all of them, whole:
each task trains on its own documents (`learn`), and the weights are averaged by tokens after each of ``ROUNDS`` rounds. Another word has
the model's probability of an unknown word times (c+1) / (N' + V' + 1), c its count in all training documents,
N' and V' the tokens and kinds of such words there.

Counts cover all training documents and are made once, by word. The head list, at most ``HEAD`` of the most frequent words (of a count,
all or none), goes to every task with its counts. A document's words outside it (hash, occurrences) are written beside its sums,
in one pass over the texts, and meet their counts in a join on the word, so no hot word is a large group. Words are identified by a 64-bit hash there.

Defined cases: null text is empty (one end token); rows without training documents score by the untrained
model; a row is identified by doc_id and text: repeated rows get equal results, and count as often in
the statistics; a null doc_id is a value of its own; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starhouse.llm.common import chunks, drop_written, row_key, written
from starhouse.llm.gru import END, GRU, UNK

VOCAB, HEAD = 900, 40_000
ROUNDS, STRETCH, STREAMS = 3, 200_000, 192
#: Each task reads its first words, up to this number, several times in few streams, and all others once in many.
FIRST = 20_000
CHUNK_CHARS = 2_000_000
#: A task sends its words' counts on whenever it holds so many.
COUNTED = 200_000


def tokens(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased (bytes methods know ASCII only)."""
    return text.encode().lower().split() if text else []


def _hashes(words: Iterable[bytes], n: int) -> np.ndarray:
    """The words' hashes, those of ``xxhash64`` in SQL."""
    return np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, n).view(np.int64)


def _places(words: list[bytes], at: dict[bytes, int]) -> np.ndarray:
    """The words' places, -1 for others."""
    return np.fromiter(map(at.get, words, repeat(-1)), dtype=np.int64, count=len(words))


def _pieces(texts):
    return chunks([len(t or "") + 1 for t in texts], CHUNK_CHARS)


def frequent(counts: DataFrame, most: int) -> list[bytes]:
    """The words (w, c) of largest count, by count and word: all those of a count, or none, and ``most`` at most."""
    return [w for w, _ in _frequent(counts, most)]


def _frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """`frequent` words and their counts. The least count is found first, from one row for each count, so that no other word reaches
    the driver."""
    spread = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    above = spread.withColumn("n", F.sum("n").over(Window.orderBy(F.desc("c")))).where(F.col("n") <= most)
    least = above.agg(F.min("c")).first()[0]
    rows = [] if least is None else counts.where(F.col("c") >= least).collect()
    return sorted(((bytes(r.w), r.c) for r in rows), key=lambda x: (-x[1], x[0]))


def learn(model: GRU, sequences: Iterable[list[int]]) -> int:
    """Train the model on a task's documents (token ids, END last) and return the tokens seen. The way a token is learned depends on
    its place alone: a document is learned like that whatever follows it."""
    state, seen, seq, first = {}, 0, [END], True
    for ids in sequences:
        if first and seen + len(seq) - 1 + len(ids) >= FIRST:        # the document that reaches the limit is cut there
            room = FIRST - (seen + len(seq) - 1)
            seq, ids, first = seq + ids[:room], ids[room:], False
            model.train(np.array(seq), state=state)
            seen, seq = seen + len(seq) - 1, seq[-1:]
        seq += ids
        if len(seq) >= STRETCH:
            model.train(np.array(seq), 1, STREAMS, state=state)
            seen, seq = seen + len(seq) - 1, seq[-1:]
    if len(seq) > 1:
        model.train(np.array(seq), *(() if first else (1, STREAMS)), state=state)
        seen += len(seq) - 1
    return seen


def word_counts(train: DataFrame) -> DataFrame:
    """(w, c) of all words of the training documents, written."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c: Counter = Counter()
        for batch in batches:
            for t in batch["text"]:
                c.update(tokens(t))
                if len(c) >= COUNTED:
                    yield pd.DataFrame({"w": list(c), "c": list(c.values())})
                    c.clear()
        if c:
            yield pd.DataFrame({"w": list(c), "c": list(c.values())})

    return written(train.select("text").mapInPandas(counted, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c")), "lm-words")


def fit(train: DataFrame) -> tuple[bytes, list[bytes], list[bytes]]:
    """(weights, vocabulary after UNK and END, head words) from all training documents. The vocabulary and the head are the most frequent
    words of all."""
    counts = word_counts(train)
    head = frequent(counts, HEAD)
    drop_written(counts)
    return train_model(train, head[:VOCAB]), head[:VOCAB], head


def train_model(train: DataFrame, vocab: list[bytes]) -> bytes:
    """The model's weights. Every task trains on its own documents; ``ROUNDS`` rounds, each over another part of the documents, start from
    the last round's weights, averaged by tokens."""
    spark = train.sparkSession
    weights = GRU(len(vocab) + 2).to_bytes()
    part = F.pmod(F.xxhash64(row_key("doc_id", "text"), F.lit(1)), F.lit(ROUNDS))
    for r in range(ROUNDS):
        sent = spark.sparkContext.broadcast((weights, vocab))

        def trained(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            weights, vocab = sent.value
            ids = {w: i + 2 for i, w in enumerate(vocab)}
            model = GRU.from_bytes(weights)
            seen = learn(model, ([ids.get(w, UNK) for w in tokens(t)] + [END] for batch in batches for t in batch["text"]))
            if seen:
                yield pd.DataFrame({"weights": [model.to_bytes()], "tokens": [seen]})

        def averaged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, whole = 0, {}
            for batch in batches:
                for data, n in zip(batch["weights"], batch["tokens"], strict=True):
                    model = GRU.from_bytes(data)
                    total += n
                    for k, w in model.p.items():
                        whole[k] = whole.get(k, 0.0) + w.astype(np.float64) * n
            if total:
                model.p = {k: (w / total).astype(np.float32) for k, w in whole.items()}
                yield pd.DataFrame({"weights": [model.to_bytes()], "tokens": [total]})

        parts = written(train.where(part == r).select("text").mapInPandas(trained, "weights binary, tokens long"), "lm-weights")
        groups = written(parts.mapInPandas(averaged, "weights binary, tokens long"), "lm-averages")
        made = groups.coalesce(1).mapInPandas(averaged, "weights binary, tokens long").collect()
        weights = bytes(made[0].weights) if made else weights
    return weights


def _tail(lists: list[list[bytes]], words: list[bytes], h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The kinds of words outside the head (place -1) in each text; their hashes and occurrences there, text by text."""
    tail = np.flatnonzero(h < 0)
    kinds: dict = {}                                              # such words, numbered as they come
    codes = np.fromiter((kinds.setdefault(words[i], len(kinds)) for i in tail.tolist()), np.int64, len(tail))
    doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])[tail]
    pair, tf = np.unique(doc * max(1, len(kinds)) + codes, return_counts=True)
    doc, code = np.divmod(pair, max(1, len(kinds)))
    return np.bincount(doc, minlength=len(lists)), _hashes(kinds, len(kinds))[code], tf


def score(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, boolean train) with n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    train = docs.where("train")
    counts = word_counts(train)
    found = _frequent(counts, HEAD)
    head, head_counts = [w for w, _ in found], np.array([c for _, c in found], dtype=np.int64)
    vocab = head[:VOCAB]
    weights = train_model(train, vocab)
    ends = train.count()
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, kinds = sums.n + ends, sums.v + (ends > 0)
    rest = float(np.log10(sums.n - head_counts[:len(vocab)].sum() + sums.v - len(vocab) + 1))
    sent = spark.sparkContext.broadcast((weights, head, head_counts, len(vocab), ends))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, head, counts, n_vocab, ends = sent.value
        model = GRU.from_bytes(weights)
        at = {w: i for i, w in enumerate(head)}
        logs = np.append(np.log10(counts + 1.0), 0.0)              # the last place: words outside the head
        for batch in batches:
            texts, parts, seqs, tails = batch.column(batch.num_columns - 1).to_pylist(), [], [], []
            if not texts:
                continue
            for a, b in _pieces(texts):
                lists = [tokens(t) for t in texts[a:b]]
                n = np.array([len(x) for x in lists])
                words = list(chain.from_iterable(lists))
                h = _places(words, at)
                ids = np.where((h >= 0) & (h < n_vocab), h + 2, UNK)
                seqs += np.split(np.insert(ids.astype(np.int32), np.cumsum(n), END), np.cumsum(n + 1)[:-1])
                tails.append(_tail(lists, words, h))
                doc = np.repeat(np.arange(len(n)), n)
                add = lambda v: np.bincount(doc, weights=v, minlength=len(n))  # noqa: B023, E731
                n_tail = add(h < 0).astype(np.int64)
                parts.append((n + 1, n_tail, n - n_tail + (ends > 0), add(logs[h]) + np.log10(ends + 1.0),
                              add(np.where(ids == UNK, logs[h] - rest, 0.0))))
            sizes, hashes, tf = (np.concatenate(x) for x in zip(*tails, strict=True))
            starts = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            made = [*(pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)), pa.array(model.score(seqs) / np.log(10)),
                    pa.ListArray.from_arrays(starts, pa.array(hashes)), pa.ListArray.from_arrays(starts, pa.array(tf, pa.int64()))]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + made, names=[*batch.schema.names[:-1], *made_names])

    keep = [c for c in docs.columns if c not in ("text", "n_tokens", "n_known", "train_tokens", "base_score", "score")]
    given = docs.select(*keep, row_key("doc_id", "text").alias("__rk"), "text")
    made_fields = [T.StructField(c, T.LongType()) for c in ("__n", "__n_tail", "__known")] + [
        T.StructField(c, T.DoubleType()) for c in ("__base", "__oov", "__lm")] + [
        T.StructField(c, T.ArrayType(T.LongType())) for c in ("__wh", "__tf")]
    made_names = [f.name for f in made_fields]
    rows = written(given.mapInArrow(scored, T.StructType(given.schema.fields[:-1] + made_fields)), "lm-rows")
    posts = rows.select("__rk", F.inline(F.arrays_zip(F.col("__wh").alias("wh"), F.col("__tf").alias("tf"))))
    rare = counts.where(F.col("c") < int(head_counts[-1])) if found else counts          # the head has all words of a count or none
    tail = posts.join(rare.groupBy(F.xxhash64("w").alias("wh")).agg(F.sum("c").alias("c")), "wh", "left").groupBy("__rk").agg(
        F.sum("tf").alias("tf"), F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("known"),
        F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("log"))
    joined = rows.join(tail.select("__rk", F.struct("tf", "known", "log").alias("__t")), "__rk", "left")
    times = F.coalesce(F.col("__t.tf") / F.col("__n_tail"), F.lit(1.0))        # rows of equal id and text are summed
    log = F.coalesce(F.col("__t.log") / times, F.lit(0.0))
    return joined.select(
        *keep, F.col("__n").alias("n_tokens"),
        (F.col("__known") + F.coalesce(F.col("__t.known") / times, F.lit(0.0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("__base") + log - F.col("__n") * F.lit(float(np.log10(total + kinds + 1)))).alias("base_score"),
        (F.col("__lm") + F.col("__oov") + log).alias("score"))
