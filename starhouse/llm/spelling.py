"""Spelling variant grouping: words one edit apart by blocked Gram matrices of letter counts.

`word_counts` takes the maximal runs of letters of every whole text, lower-cases A-Z, deletes one code point
of the few runs that a checksum picks, and counts the results. `near_pairs` finds all pairs of words that differ
by one inserted, deleted or replaced code point:

* Letters are dealt to ``k`` classes (code point modulo k). A word's block is its number of letters in each
  class, so its length as well. An edit moves a word to one of few neighbour blocks: one class less (a
  deletion), or one less and another, or the same, more (a replacement). Each word stays at home in its own block
  and visits those neighbours, so that every pair of blocks meets once. ``k`` grows until the largest
  block has at most `BLOCK` words; should no k do, blocks are split by a hash of the word and visitors
  go to every piece.
* In a block the letter counts of home words are a matrix. Its product with the counts of visitors,
  which stream by in bounded pieces, gives all squared distances. One edit leaves at most 2 (replacement) or 1
  (insertion), and the few pairs within that are verified letter by letter.

`group` adds each word's form, the near word of largest count if that is at least `RATIO` times its own, and
its root, found by following forms with doubling steps.

Defined cases: null and empty texts have no words; a null doc_id counts as an empty id; repeated rows
count each; no table limits a word's length; near words of equal count are taken in code-point order; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import drop_written, written

MIN_LETTERS = 6
MIN_COUNT = 5
RATIO = 5
#: One run in so many loses a letter.
DIVISOR = 199
#: Words of a block at most, and letter classes from the fewest to the most.
BLOCK = 4096
CLASSES = (4, 14)
#: Distinct words that a counting task holds, and visitors compared at once.
HELD_WORDS = 200_000
VISITORS = 1024


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, divisor: int = DIVISOR) -> DataFrame:
    """``(word, n)`` of all texts; shorter runs can't give a word that is long enough and aren't looked at."""
    run = re.compile(f"[A-Za-zÀ-ÿ]{{{min_letters},}}")

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch["id"].tolist(), batch["text"].tolist(), strict=True):
                if not text:
                    continue
                start = zlib.crc32(f"{doc}:".encode())
                for w, n in Counter(run.findall(text.encode().lower().decode())).items():       # bytes: A-Z only
                    h = zlib.crc32(w.encode(), start)
                    if h % divisor == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                    total[w] += n
                if len(total) > HELD_WORDS:
                    yield pd.DataFrame({"word": list(total.keys()), "n": list(total.values())})
                    total.clear()
        if total:
            yield pd.DataFrame({"word": list(total.keys()), "n": list(total.values())})

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    return rows.mapInPandas(made, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .where((F.length("word") >= min_letters) & (F.col("n") >= min_count))


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each; all letters have code points under 256."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)


def _by_length(words: list[str]):
    """(indexes, codes) of the words of each length."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, _codes([words[i] for i in at])


def _class_counts(codes: np.ndarray, k: int) -> np.ndarray:
    return np.stack([(codes % k == c).sum(1) for c in range(k)], 1).astype(np.int32)


def _keys(counts: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in counts.astype(">i4")]


def _homes(k: int):
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = batch["word"].tolist()
            for _, codes in _by_length(words):
                yield pd.DataFrame({"key": _keys(_class_counts(codes, k))})
    return made


def _visits(k: int, splits: int):
    """(key, split, role, word, n): each word at home (role 0) and as a visitor (1) of its neighbour blocks."""
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words, n = np.array(batch["word"].tolist(), dtype=object), batch["n"].to_numpy()
            for at, codes in _by_length(words.tolist()):
                counts, own = _class_counts(codes, k), np.array([zlib.crc32(w.encode()) % splits for w in words[at]])

                def rows(counts, split, role, keep, at=at):
                    return pd.DataFrame({"key": _keys(counts[keep]), "split": split[keep].astype(np.int32), "role": np.int32(role),
                                         "word": words[at[keep]], "n": n[at[keep]]})

                out = [rows(counts, own, 0, np.ones(len(at), dtype=bool))]
                for s in range(splits):
                    there = np.full(len(at), s)
                    if s:
                        out.append(rows(counts, there, 1, own < s))
                    for i in range(k):
                        less = counts.copy()
                        less[:, i] -= 1
                        have = less[:, i] >= 0
                        out.append(rows(less, there, 1, have))
                        for j in range(i + 1, k):
                            other = less.copy()
                            other[:, j] += 1
                            out.append(rows(other, there, 1, have))
                yield pd.concat(out)
    return made


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def one_inserted(long: np.ndarray, short: np.ndarray) -> np.ndarray:
    """Rows of ``long`` that lose one letter to give the row of ``short``: their common prefix and suffix cover it."""
    m = short.shape[1]
    prefix = np.cumprod(long[:, :m] == short, axis=1).sum(1)
    suffix = np.cumprod((long[:, 1:] == short)[:, ::-1], axis=1).sum(1)
    return prefix + suffix >= m


class _Home:
    """Words at home in a block, of one length, and their letter counts."""

    def __init__(self, words: list[str], n: list[int]):
        self.words, self.n, self.codes = np.array(words, dtype=object), np.array(n, dtype=np.int64), _codes(words)
        self.letters = np.unique(self.codes)
        kind = np.float32 if self.codes.shape[1] < 2048 else np.float64          # products are exact
        self.counts = self._counts(self.codes).astype(kind)
        self.norms = (self.counts * self.counts).sum(1)

    def _counts(self, codes: np.ndarray) -> np.ndarray:
        return np.stack([(codes == c).sum(1) for c in self.letters], 1)

    def _near(self, codes: np.ndarray, below: bool) -> tuple[np.ndarray, np.ndarray]:
        """(visitor, home) indexes of pairs one edit apart; ``below``: visitors are the home words, each pair once."""
        same = codes.shape[1] == self.codes.shape[1]
        known = self._counts(codes).astype(self.counts.dtype)
        other = np.stack([(codes == c).sum(1) for c in np.setdiff1d(np.unique(codes), self.letters)] or [np.zeros(len(codes), dtype=int)], 1)
        norms = (known * known).sum(1) + (other * other).sum(1)
        found = []
        for a in range(0, len(codes), VISITORS):
            b = slice(a, a + VISITORS)
            distance = norms[b, None] + self.norms[None, :] - 2 * (known[b] @ self.counts.T)
            v, h = np.nonzero(distance <= (2 if same else 1))
            v += a
            if below:
                v, h = v[v < h], h[v < h]
            ok = (one_replaced if same else one_inserted)(codes[v], self.codes[h])
            found.append((v[ok], h[ok]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2

    def pairs(self, words: list[str] | None = None, n: list[int] | None = None) -> Iterator[pd.DataFrame]:
        """Both directions of the near pairs of visitors and home words, or of home words among themselves."""
        groups = [(np.arange(len(self.words)), self.codes)] if words is None else _by_length(words)
        names, counts = (self.words, self.n) if words is None else (np.array(words, dtype=object), np.array(n, dtype=np.int64))
        for at, codes in groups:
            v, h = self._near(codes, words is None)
            v = at[v]
            if len(v):
                yield pd.DataFrame({"word": np.r_[names[v], self.words[h]], "near": np.r_[self.words[h], names[v]],
                                    "near_n": np.r_[self.n[h], counts[v]]})


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Near pairs of rows sorted by (key, split, role): a block's home words come before its visitors."""
    current, words, n, home = None, [], [], None

    def built():
        return _Home(words, n) if words else None

    for batch in batches:
        rows = zip(batch["key"].tolist(), batch["split"].tolist(), batch["role"].tolist(), batch["word"].tolist(), batch["n"].tolist(), strict=True)
        for (key, split, role), group in groupby(rows, key=lambda r: r[:3]):
            group = list(group)
            if (key, split) != current:
                if home is None and words:
                    yield from built().pairs()
                current, words, n, home = (key, split), [], [], None
            if role == 0:
                words += [g[3] for g in group]
                n += [g[4] for g in group]
            elif words:
                if home is None:
                    home = built()
                    yield from home.pairs()
                yield from home.pairs([g[3] for g in group], [g[4] for g in group])
    if home is None and words:
        yield from built().pairs()


def near_pairs(words: DataFrame) -> DataFrame:
    """``(word, near, near_n)``, both directions of every pair one edit apart; ``words`` (word, n) is written."""
    least, most = CLASSES
    for k in range(least, most + 1):
        largest = words.select("word").mapInPandas(_homes(k), "key binary").groupBy("key").count().agg(F.max("count")).first()[0] or 0
        if largest <= BLOCK:
            break
    visits = words.mapInPandas(_visits(k, -(-largest // BLOCK) or 1), "key binary, split int, role int, word string, n long")
    return visits.repartition("key", "split").sortWithinPartitions("key", "split", "role", "word") \
        .mapInPandas(_compared, "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words that have a form: the last of the chain, by steps of doubled length."""
    roots = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = written(roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        drop_written(roots)
        roots = step
        if roots.where("moved").limit(1).count() == 0:
            return roots.select("word", "root")


def group(docs: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word."""
    words = written(word_counts(docs), "spelling-words")
    near = near_pairs(words).groupBy(F.col("word").alias("w")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word"))).alias("best"))
    enough = -F.col("best.less") >= RATIO * F.col("n")
    rows = written(words.join(near, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = _roots(rows.where("form IS NOT NULL")).withColumnRenamed("word", "w")
    return rows.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
