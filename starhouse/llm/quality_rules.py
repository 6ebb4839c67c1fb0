"""Quality rules (native): counting rules and distribution divergence.

`stats` takes counts of every whole text inside its row. `references` builds, over all documents of a
language, the distribution of character classes and of its common words (those with at least
``MIN_SHARE`` of the language's words, so at most 1 / ``MIN_SHARE`` of them, and the rest as one more
cell). `histograms` counts each text's common words, found by a join with those small lists. `verdicts` compares
each document with its language's reference by Jensen-Shannon distance (base 2, 0 to 1). The counts of `stats`
are written once, without the texts, and both references and verdicts read them. A document fails if a distance is over its limit. Guards: a text under ``MIN_CHARS``
word characters has no character verdict, one under ``MIN_WORDS`` words no word verdict, and a language
whose documents hold fewer than ``MIN_REFERENCE`` words gives none.

Words of the histograms are stripped of ASCII marks at both ends and lower-cased; the rules' words are
the raw ones.

Defined cases: null or blank text has zero counts and fails the base rules; a null language is a
language of its own; repeated rows are judged alike and all count in the references; an empty table
gives no rows; other columns pass through unless a result column has their name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import row_key, split_words, written

MIN_SHARE = 0.004
MIN_WORDS, MIN_CHARS, MIN_REFERENCE = 100, 300, 5_000
#: Largest Jensen-Shannon distance to the language that a kept document may have.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.28, 0.36
CLASSES = ("letter", "upper", "digit", "mark", "other")


def _count(text: str, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _windows(hashes: Column) -> Column:
    """Hashes of the 3-word windows of a text of four words or more, from those of its words."""
    from_place = lambda k: F.slice(hashes, k, F.size(hashes) - 2)
    pairs = F.zip_with(from_place(1), from_place(2), lambda a, b: F.xxhash64(a, b))
    return F.when(F.size(hashes) < 4, F.array().cast("array<bigint>")).otherwise(
        F.zip_with(pairs, from_place(3), lambda a, b: F.xxhash64(a, b)))


#: A window's place in a text is put in this many lower bits beside its hash, to sort numbers and not pairs.
_PLACE_BITS = 26


def stats(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of the base rules and of the character classes."""
    d = docs.withColumn("__t", F.coalesce("text", F.lit("")))
    d = d.withColumn("__w", split_words(F.col("__t")))
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("__l", lines).withColumn("__x", F.transform("__w", lambda w: F.xxhash64(w)))
    d = d.withColumn("__h", _windows(F.col("__x")))
    # equal windows stand side by side when sorted by hash and place; what is left of the hash there only
    # orders them, whole hashes are compared
    d = d.withColumn("__s", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.sort_array(
        F.transform("__h", lambda h, i: F.shiftleft(h, _PLACE_BITS).bitwiseOR(i.cast("long"))))))
    place = lambda x: x.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int")
    hash_at = lambda i: F.get("__h", place(F.get("__s", i)))
    same = lambda x, y: F.shiftright(x, _PLACE_BITS) == F.shiftright(y, _PLACE_BITS)
    again = F.filter("__s", lambda x, i: (same(F.get("__s", i - 1), x) & (hash_at(i - 1) == hash_at(i)))
                     | (same(F.get("__s", i + 1), x) & (hash_at(i + 1) == hash_at(i))))
    d = d.withColumn("__r", F.transform(again, place))
    covered = F.size(F.array_distinct(F.flatten(F.transform("__r", lambda i: F.array(i, i + 1, i + 2)))))
    marks = r"[!-/:-@\[-`{-~]"
    out = d.select(
        *[c for c in docs.columns if c not in _STAT_COLUMNS],
        F.size("__w").cast("long").alias("n_words"),
        (F.length("__t") - _count("__t", r"[\x20\x09-\x0D]")).cast("long").alias("word_chars"),
        _count("__t", "[#*$%&|<>]").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("__r").isNotNull(), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        _count("__t", r"\p{Lu}").alias("n_upper"), _count("__t", r"\p{Nd}").alias("n_digit"),
        _count("__t", marks).alias("n_mark"), _count("__t", r"[^\p{L}\p{Nd}\x09-\x0D\x20-\x7E]").alias("n_other"))
    rest = F.greatest(F.lit(0), F.col("word_chars") - F.col("n_upper") - F.col("n_digit") - F.col("n_mark") - F.col("n_other"))
    return out.withColumn("n_letter", rest.cast("long"))


_STAT_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 "n_upper", "n_digit", "n_mark", "n_other", "n_letter")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def _plain_words(text: str) -> Column:
    """Words for the histogram: split at blanks and ASCII marks, lower-cased."""
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"),
                    lambda w: w != "")


def references(docs: DataFrame, counted: DataFrame) -> DataFrame:
    """One row per language: its words' number, common words with shares, and class shares. ``counted`` has
    the class counts by row (see `stats`) and ``lang``; ``docs`` has text and lang."""
    lang = F.coalesce("lang", F.lit("")).alias("lang")
    words = docs.select(lang, F.explode(_plain_words("text")).alias("w")).groupBy("lang", "w").agg(F.count("*").alias("n"))
    words = written(words, "quality-words")
    totals = written(words.groupBy("lang").agg(F.sum("n").alias("total")), "quality-totals")
    common = words.join(totals, "lang").where(F.col("n") >= F.lit(MIN_SHARE) * F.col("total")) \
        .groupBy("lang").agg(F.max("total").alias("total"),
                             F.sort_array(F.collect_list(F.struct("w", (F.col("n") / F.col("total")).alias("p")))).alias("common"))
    shares = counted.select(lang, *[f"n_{c}" for c in CLASSES]).groupBy("lang").agg(*[F.sum(f"n_{c}").alias(c) for c in CLASSES])
    whole = sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0]))
    return shares.join(common, "lang", "left").select(
        "lang", F.coalesce("total", F.lit(0)).alias("ref_words"),
        F.transform("common", lambda x: x.w).alias("ref_common"), F.transform("common", lambda x: x.p).alias("ref_p"),
        F.array(*[F.when(whole > 0, F.col(c) / whole).otherwise(0.0) for c in CLASSES]).alias("ref_classes"))


def _part(a: Column, b: Column) -> Column:
    return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)


def _both(p: Column, q: Column) -> Column:
    """A cell's share in the divergence of two distributions."""
    return (_part(p, q) + _part(q, p)) / 2


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)


def _distance(divergence: Column) -> Column:
    return F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), divergence)))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two arrays of shares."""
    return _distance(_sum(F.zip_with(p, q, _both)))


_KEY = "__key"


def histograms(docs: DataFrame, refs: DataFrame) -> DataFrame:
    """``(__key, n_plain, n_all, cells)`` of the different texts of a language (see `_key`): words of the text and of all
    its copies together, and over these the count of each common word, by its place in the reference. All other words are
    cell 0. Copies count together, which changes no share."""
    lang = F.coalesce("lang", F.lit(""))
    word = F.xxhash64("lang", "w").alias("word")           # a 64-bit hash stands for a word here
    entries = refs.select("lang", F.posexplode("ref_common").alias("at", "w")).select(word, (F.col("at") + 1).alias("cell"))
    entries = written(entries, "quality-common")          # Spark knows how small it is: a join without an exchange
    # the key is taken before the words are laid out: beside posexplode it would hash the text once a word
    listed = docs.select(lang.alias("lang"), _key().alias(_KEY), _plain_words("text").alias("ws"))
    words = listed.select("lang", _KEY, F.posexplode("ws").alias("place", "w")).select(_KEY, "place", word)
    counts = words.join(entries, "word", "left").groupBy(_KEY, F.coalesce("cell", F.lit(0)).alias("cell")) \
        .agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("place"))
    return counts.groupBy(_KEY).agg(F.sum("n").alias("n_all"), (F.max("place") + 1).alias("n_plain"), F.collect_list(F.struct("cell", "n")).alias("cells"))


def _key() -> Column:
    return row_key("lang", "text")


def verdicts(counted: DataFrame, refs: DataFrame, hists: DataFrame) -> DataFrame:
    """``counted`` (with lang, the counts of `stats` and `_key`) with char_distance, word_distance (null where
    a guard holds), base_failed and kept."""
    d = counted.withColumn("__k", F.coalesce("lang", F.lit("")))
    d = d.join(refs.withColumnRenamed("lang", "__k"), "__k", "left").join(hists, _KEY, "left")
    ready = F.col("ref_words") >= MIN_REFERENCE
    classes = F.array(*[F.col(f"n_{c}") / F.col("word_chars") for c in CLASSES])
    d = d.withColumn("char_distance", F.when(ready & (F.col("word_chars") >= MIN_CHARS), js_distance(classes, F.col("ref_classes"))))
    share = lambda x: x.n / F.col("n_all")
    common = F.transform(F.filter("cells", lambda x: x.cell > 0), lambda x: F.struct(x.n.alias("n"), F.get("ref_p", x.cell - 1).alias("q")))
    there, rest = _sum(F.transform(common, lambda x: x.q)), F.greatest(F.lit(0.0), 1.0 - _sum(F.transform(common, share)))
    whole = _sum(F.col("ref_p"))
    # a common word that the text lacks has half its reference share in the divergence
    divergence = _sum(F.transform(common, lambda x: _both(share(x), x.q))) + (whole - there) / 2 + _both(rest, F.greatest(F.lit(0.0), 1.0 - whole))
    d = d.withColumn("word_distance", F.when(ready & (F.col("n_plain") >= MIN_WORDS) & F.col("ref_common").isNotNull(), _distance(divergence)))
    far = (F.coalesce("char_distance", F.lit(0.0)) > MAX_CHAR_DISTANCE) | (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    d = d.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~far)
    return d.drop("__k", _KEY, "n_plain", "n_all", "cells", "ref_words", "ref_common", "ref_p", "ref_classes")


def judge(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document, against references over all of them."""
    counted = written(stats(docs).withColumn(_KEY, _key()).drop("text"), "quality-counts")
    # written, so that Spark knows how small it is and need not deal the documents by language
    refs = written(references(docs, counted), "quality-references")
    return verdicts(counted, refs, histograms(docs, refs))
