"""Benchmark decontamination (native): a distributed positional inverted index.

Items are cut into windows of ``WINDOW`` consecutive words (a shorter item is one window). The number of
training postings of every item term is counted over the whole corpus; each window is represented by
its ``RAREST`` rarest positions, and only postings (term, document row, position) of such terms are stored.
Postings meet item positions on the term; a posting at p for item position i lies on the diagonal p - i,
so the offset-adjusted lists intersect where one (row, item, diagonal) has all rare positions of a window.
The few windows found that way are compared with the document's own words at that place, so that a match
is always the exact phrase. `proximity` reports windows whose rarest terms stand within a slop instead.

Words: A-Z lower-cased, runs of characters other than ASCII non-alphanumerics.

Defined cases: null or wordless texts have no words and no hits; a null doc_id or item_id is a value of
its own (item: the empty id); items of equal words are searched once and report all their ids; repeated
rows get equal results; without documents there are no rows, without items no hits; other columns of the
documents pass through unless a result column has their name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import ascii_lower, row_key, written

WINDOW = 13
RAREST = 3
#: Terms (short strings) up to which the item vocabulary is sent to every task; beyond, a shuffle join.
BROADCAST_TERMS = 100_000


def words_of(text: Column) -> Column:
    lower = ascii_lower(F.coalesce(text, F.lit("")))
    return F.filter(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def _small(terms: DataFrame) -> DataFrame:
    """A written table of distinct terms, marked for broadcast if it is known to be small."""
    return F.broadcast(terms) if terms.count() <= BROADCAST_TERMS else terms


def item_windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(ik, words, ids, windows)`` by distinct word sequence; windows: (start, rare positions)."""
    seqs = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), words_of(F.col("text")).alias("words")) \
        .where(F.size("words") > 0).groupBy("words").agg(F.sort_array(F.collect_set("id")).alias("ids")) \
        .select(F.xxhash64("words").alias("ik"), "words", "ids")
    seqs = written(seqs, "decontam-items")
    terms = seqs.select("ik", F.posexplode("words").alias("pos", "term"))
    vocabulary = written(terms.select("term").distinct(), "decontam-terms")
    found = docs.select(F.explode(words_of(F.col("text"))).alias("term")).join(_small(vocabulary), "term")
    sizes = found.groupBy("term").agg(F.count("*").alias("n"))
    ranked = terms.join(sizes, "term", "left").groupBy("ik").agg(F.sort_array(F.collect_list(
        F.struct("pos", F.coalesce("n", F.lit(0)).alias("n")))).alias("ps"))
    w = F.least(F.lit(WINDOW), F.size("ps"))

    def window(s):
        inside = F.transform(F.slice("ps", s + 1, w), lambda p: F.struct(p.n.alias("n"), p.pos.alias("pos")))
        rare = F.slice(F.sort_array(inside), 1, RAREST)
        return F.struct(s.alias("start"), F.transform(rare, lambda r: r.pos).alias("rare"), rare[0].n.alias("n"))

    windows = F.filter(F.transform(F.sequence(F.lit(0), F.size("ps") - w), window), lambda x: x.n > 0)
    out = ranked.select("ik", windows.alias("windows")).where(F.size("windows") > 0)
    return written(seqs.join(out, "ik"), "decontam-windows")


def postings(docs: DataFrame, wins: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rare item positions (ik, apos, term) and the stored postings (term, rk, pos) of their terms."""
    rare = wins.select("ik", "words", F.explode(F.array_distinct(F.flatten(F.transform("windows", lambda w: w.rare)))).alias("apos")) \
        .select("ik", "apos", F.get("words", F.col("apos")).alias("term"))
    terms = written(rare.select("term").distinct(), "decontam-rare")
    index = docs.select(row_key("doc_id", "text").alias("rk"), F.posexplode(words_of(F.col("text"))).alias("pos", "term")) \
        .join(_small(terms), "term").select("term", "rk", "pos").distinct()
    return rare, written(index, "decontam-postings")


def _on_diagonals(rare: DataFrame, index: DataFrame) -> DataFrame:
    return index.join(rare, "term").select("rk", "ik", (F.col("pos") - F.col("apos")).alias("diag"), "apos")


def candidates(rare: DataFrame, index: DataFrame, wins: DataFrame) -> DataFrame:
    """(rk, ik, diag, starts): windows all of whose rare terms are at their places."""
    met = _on_diagonals(rare, index).groupBy("rk", "ik", "diag").agg(F.collect_set("apos").alias("at")) \
        .where(F.size("at") >= 1).join(wins.select("ik", "windows"), "ik")
    whole = F.filter("windows", lambda w: F.size(F.array_except(w.rare, F.col("at"))) == 0)
    return met.select("rk", "ik", "diag", F.transform(whole, lambda w: w.start).alias("starts")).where(F.size("starts") > 0)


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` with n_words, n_hit, and items (sorted ids of the items with an occurring window)."""
    wins = item_windows(docs, items)
    rare, index = postings(docs, wins)
    found = candidates(rare, index, wins).join(wins.select("ik", "words", "ids"), "ik") \
        .groupBy("rk").agg(F.collect_list(F.struct("diag", "starts", "words", "ids")).alias("__found")) \
        .withColumnRenamed("rk", "__rk")
    keep = [c for c in docs.columns if c not in ("n_words", "n_hit", "items")]
    d = docs.select(*keep).withColumn("__rk", row_key("doc_id", "text")).join(found, "__rk", "left") \
        .withColumn("__w", words_of(F.col("text")))

    def occurring(f):
        w = F.least(F.lit(WINDOW), F.size(f.words))
        same = F.filter(f.starts, lambda s: (f.diag + s >= 0) & (f.diag + s + w <= F.size("__w")) & F.when(
            f.diag + s >= 0, F.slice(F.col("__w"), F.greatest(f.diag + s, F.lit(0)) + 1, w) == F.slice(f.words, s + 1, w)))
        return F.struct(F.flatten(F.transform(same, lambda s: F.sequence(f.diag + s, f.diag + s + w - 1))).alias("hit"), f.ids.alias("ids"))

    d = d.withColumn("__m", F.filter(F.transform("__found", occurring), lambda m: F.size(m.hit) > 0))
    hits = F.size(F.array_distinct(F.flatten(F.transform("__m", lambda m: m.hit))))
    ids = F.sort_array(F.array_distinct(F.flatten(F.transform("__m", lambda m: m.ids))))
    return d.select(*keep, F.size("__w").cast("long").alias("n_words"),
                    F.when(F.col("__m").isNull(), 0).otherwise(hits).cast("long").alias("n_hit"),
                    F.when(F.col("__m").isNull(), F.array().cast("array<string>")).otherwise(ids).alias("items"))


def contaminated() -> Column:
    """A document is contaminated if at least a twentieth of its words is hit."""
    return (F.col("n_hit") > 0) & (F.lit(20) * F.col("n_hit") >= F.col("n_words"))


def proximity(docs: DataFrame, items: DataFrame, slop: int = 5) -> DataFrame:
    """``(rk, ik, ids, starts)``: windows whose rarest terms stand near their places, with diagonals no
    more than ``slop`` apart. Rows of a (document row, item) meet in overlapping stretches of diagonals."""
    wins = item_windows(docs, items)
    rare, index = postings(docs, wins)
    width = slop + 1
    near = _on_diagonals(rare, index).withColumn("b", F.explode(F.array(F.floor(F.col("diag") / width), F.floor(F.col("diag") / width) - 1)))
    met = near.groupBy("rk", "ik", "b").agg(F.collect_set(F.struct("diag", "apos")).alias("ds")).join(wins, "ik")

    def close(w):
        return F.exists("ds", lambda x: F.forall(w.rare, lambda a: F.exists(
            "ds", lambda y: (y.apos == a) & (y.diag >= x.diag) & (y.diag <= x.diag + slop))))

    starts = F.transform(F.filter("windows", close), lambda w: w.start)
    return met.select("rk", "ik", "ids", starts.alias("starts")).where(F.size("starts") > 0) \
        .groupBy("rk", "ik").agg(F.first("ids").alias("ids"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("starts")))).alias("starts"))
