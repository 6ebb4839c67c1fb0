"""Language identification: word-first backoff.

A known word votes with its log frequency in each language. An unseen word backs off to character
5-grams of the word with boundary marks, and if none of those is known to 4-grams, and so on down to
single characters; the mean log frequency of the known n-grams of that length votes. The language with
the largest sum wins; the score is its posterior probability under equal priors.

The model is fitted on a bounded sample of labelled rows: at most ``docs_per_lang`` rows of each
language (by a hash of the text), of which the ``max_words`` words and ``max_grams`` n-grams with the
largest relative frequency in some language are kept. Its size is bounded by these parameters, not by
the input, so it is sent to every task. Prediction reads every whole text.

Words are runs of letters of the NFC-normalised, lower-cased text.

Defined cases: null text, or text without a letter, is ``und`` with score 0; equal sums go to the
language first in alphabetical order; rows are predicted each on its own, so repeated rows get equal
results; rows without text or language are not learned from; without any row to learn from every text
is ``und``; other columns pass through (the new ones replace any of the same name).
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UND = "und"
LONGEST = 5
_WORD = re.compile(r"[^\W\d_]+")
#: Characters handled together inside a task; bounds the task's memory.
CHUNK_CHARS = 2_000_000
#: As many when texts are predicted: each word takes a row of votes.
PREDICT_CHARS = 500_000


def words(text: str | None) -> list[str]:
    if not text:
        return []
    found = _WORD.findall(unicodedata.normalize("NFC", text).lower())
    return found if text.isascii() else [w for w in found if any(map(str.isalpha, w))]


def grams(word: str, n: int) -> list[str]:
    if n == 1:
        return list(word)
    w = f"^{word}$"
    return [w[i:i + n] for i in range(len(w) - n + 1)]


@dataclass
class Model:
    """Rows of ``table`` are log frequencies by language; ``index`` has the row of (n, gram); n 0: a word."""

    langs: list[str]
    index: list[dict[str, int]]
    table: np.ndarray

    def vector(self, word: str) -> np.ndarray:
        """Votes of an unseen word: zeros if not even one of its characters is known."""
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            known = self.index[n]
            rows = [known[g] for g in grams(word, n) if g in known]
            if rows:
                return self.table[rows].mean(axis=0)
        return np.zeros(len(self.langs), dtype=np.float32)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, n, gram, count) of the words and n-grams, added up by piece of a batch."""
    for batch in batches:
        for lang, part in batch.groupby("lang"):
            texts = part["text"].tolist()
            for a, b in _pieces(texts):
                ws = Counter(w for t in texts[a:b] for w in words(t))
                out = [Counter() for _ in range(LONGEST + 1)]
                out[0] = ws
                for w, c in ws.items():
                    for n in range(1, min(LONGEST, len(w) + 2) + 1):
                        for g in grams(w, n):
                            out[n][g] += c
                for n, found in enumerate(out):
                    if found:
                        yield pd.DataFrame({"lang": lang, "n": n, "gram": list(found), "c": list(found.values())})


def _pieces(texts: list[str | None], limit: int = CHUNK_CHARS):
    from starhouse.llm.common import chunks
    return chunks([len(t or "") + 1 for t in texts], limit)


def fit(labelled: DataFrame, docs_per_lang: int = 2000, max_langs: int = 256,
        max_words: int = 60_000, max_grams: int = 120_000) -> Model:
    """Model of the ``text`` and ``lang`` columns of a labelled table. The sample and the model are bounded
    by the parameters: about ``docs_per_lang`` different texts of a language, chosen by their hashes (a text that many
    rows hold counts once), and at most ``max_langs`` languages, those with most different texts; a further language can't
    be predicted."""
    from starhouse.llm.common import drop_written, small_batches, written
    small_batches(labelled.sparkSession)
    rows = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.countDistinct(F.xxhash64("text")).alias("n"))
             .orderBy(F.desc("n"), "lang").limit(max_langs).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], [{} for _ in range(LONGEST + 1)], np.zeros((0, 0), dtype=np.float32))
    scale = 1 << 20
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, int(scale * min(1.0, docs_per_lang / sizes[k])))])
    sample = rows.where(F.col("lang").isin(langs)).where(F.pmod(F.xxhash64("text"), F.lit(scale)) < share[F.col("lang")]) \
        .groupBy("lang", F.xxhash64("text")).agg(F.first("text").alias("text")).select("text", "lang")
    counts = sample.mapInPandas(_counts, "lang string, n int, gram string, c long") \
        .groupBy("n", "gram").agg(*[F.sum(F.when(F.col("lang") == k, F.col("c")).otherwise(0)).alias(f"c{i}")
                                    for i, k in enumerate(langs)])
    counts = written(counts, "langid")
    columns = [f"c{i}" for i in range(len(langs))]
    totals = {r["n"]: r for r in counts.groupBy("n").agg(F.count("*").alias("v"), *[F.sum(c).alias(c) for c in columns]).collect()}
    totals_map = {c: F.create_map(*[F.lit(x) for n, r in totals.items() for x in (n, float(max(1, r[c])))]) for c in columns}
    top = F.greatest(*[F.col(c) / totals_map[c][F.col("n")] for c in columns]) if len(columns) > 1 else F.col("c0")
    ranked = counts.withColumn("top", top)
    kept = [ranked.where(cond).orderBy(F.desc("top"), "n", "gram").limit(most)
            for cond, most in (("n = 0", max_words), ("n > 0", max_grams))]
    found = pd.concat([k.drop("top").toPandas() for k in kept], ignore_index=True)
    drop_written(counts)
    n = found["n"].to_numpy()
    total = np.array([[totals[i][c] for c in columns] if i in totals else [0] * len(columns) for i in range(LONGEST + 1)], dtype=float)
    kinds = np.array([totals[i]["v"] if i in totals else 0 for i in range(LONGEST + 1)], dtype=float)
    table = np.log((found[columns].to_numpy(dtype=float) + 0.5) / (total[n] + 0.5 * (kinds[n][:, None] + 1)))
    index: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    for row, (k, g) in enumerate(zip(n, found["gram"], strict=True)):
        index[k][g] = row
    return Model(langs, index, table.astype(np.float32))


def _predictor(model: Model):
    seen: dict[str, int] = {}
    store = np.empty((1024, len(model.langs)), dtype=np.float32)

    def rows_of(ws) -> np.ndarray:
        """Vectors of distinct words; those of unseen words are kept for later batches, up to a bound."""
        nonlocal store
        if len(seen) > 300_000:
            seen.clear()
        known, at, out = model.index[0], [], np.empty((len(ws), len(model.langs)), dtype=np.float32)
        for i, w in enumerate(ws):
            row = known.get(w)
            if row is not None:
                at.append((i, row))
                continue
            k = seen.get(w)
            if k is None:
                k = len(seen)
                if k == len(store):
                    store = np.concatenate([store, np.empty_like(store)])
                store[k] = model.vector(w)
                seen[w] = k
            out[i] = store[k]
        if at:
            i, row = np.array(at).T
            out[i] = model.table[row]
        return out

    def predict(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        lists = [words(t) for t in texts]
        n = np.array([len(x) for x in lists])
        label, score = [UND] * len(texts), np.zeros(len(texts))
        if not n.sum() or not model.langs:
            return label, score
        codes, distinct = pd.factorize(np.array([w for x in lists for w in x], dtype=object))
        votes = rows_of(distinct)[codes]
        some = np.flatnonzero(n)
        starts = np.concatenate([[0], np.cumsum(n[some])[:-1]])
        sums = np.add.reduceat(votes.astype(np.float64), starts, axis=0)
        best = sums.argmax(axis=1)
        score[some] = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        for i, b in zip(some, best, strict=True):
            label[i] = model.langs[b]
        return label, score

    return predict


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) of each whole text."""
    from starhouse.llm.common import small_batches
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predictor = _predictor(sent.value)
        for texts in batches:
            texts = texts.tolist()
            labels, scores = [], []
            for a, b in _pieces(texts, PREDICT_CHARS):
                label, score = predictor(texts[a:b])
                labels += label
                scores.append(score)
            yield pd.DataFrame({"lang_pred": pd.Series(labels, dtype=object), "score": np.concatenate(scores) if scores else np.zeros(0)})

    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "__p")]
    return docs.select(*keep, scored("text").alias("__p")).select(*keep, "__p.lang_pred", "__p.score")
