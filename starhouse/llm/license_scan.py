"""Licence scans (native): sparse TF-IDF cosine to templates, and inheritance by nearest ancestor directory.

Every line of a file (a header notice may stand anywhere), the whole text of a file named like a licence
file, and every run of a file's words that is as long as a template (a notice in a long line, or wrapped over lines) is
compared with licence templates. Weights are tf * idf; idf comes from the share of all files that hold the term, counted
over all files, and a share of less than one in ``RARE`` counts as that, so verdicts don't move with the table's size. Vectors are sparse: unit terms join template terms,
and their products are added up. A unit is compared if it holds a
marker: a template's heaviest terms are its markers, as many as leave too little weight in the others for a
cosine of ``MIN_COSINE`` (Cauchy-Schwarz), so units without one lose nothing however common a notice is. A file's own licence is its best template with a cosine of at
least ``MIN_COSINE``; equal cosines go to the template first in alphabetical order.

A licence file (by name, or by licence lines, or templates' words in licence runs, that are at least half of its words) speaks for its directory. A file without a licence of its own
inherits from the nearest ancestor directory (its own first) that has one: directories are expanded to
their ancestors, of which there are as many as the path is deep, and joined by path. A directory with several
licence files takes the one with the best cosine, then the least licence, then the least path.

The templates, a parameter, are the small side: they bound the vocabulary that tasks are given.

Defined cases: null text has no lines, null path is the root directory's unnamed file; rows of equal path and
text are one file each and get equal results; an empty table gives no rows, files without any licence in reach get licence null and
origin ``none``; other columns pass through unless a result column has their name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import row_key, written

MIN_COSINE, OWN_SHARE, RARE = 0.6, 0.5, 10_000
NAMED = r"(?i)^(licen[cs]e|copying|unlicense|notice)([._-].*)?$"
#: Short notices by SPDX id, fixed values.
TEMPLATES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0", "Apache License Version 2.0, January 2004"),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted", "Licensed under the BSD 3-Clause License"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC0-1.0": ("Released under CC0 1.0 Universal", "To the extent possible under law the author has waived all copyright"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "LGPL-3.0": ("Licensed under the GNU Lesser General Public License, version 3", "GNU LESSER GENERAL PUBLIC LICENSE Version 3"),
    "MIT": ("Released under the MIT License", "Licensed under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0"),
}
_TERM = r"[^a-z0-9]+"


def terms_of(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _TERM), lambda t: t != "")


def template_terms(templates: dict[str, tuple[str, ...]] = TEMPLATES) -> list[tuple[str, int, str, int]]:
    """(licence, number, term, occurrences) of every template."""
    out = []
    for licence, texts in sorted(templates.items()):
        for i, t in enumerate(texts):
            words = [w for w in "".join(c if c.isascii() and c.isalnum() else " " for c in t.lower()).split()]
            out += [(licence, i, w, words.count(w)) for w in sorted(set(words))]
    return out


def idf(n: float, df: float) -> float:
    """From the share of files alone: a term that fewer than one of ``RARE`` files hold weighs no more in larger tables."""
    return math.log(min(RARE, (n + 1) / (df + 1))) + 1


def markers_of(tt: list[tuple[str, int, str, int]], weight: dict[str, float]) -> list[tuple[str, int, str]]:
    """(licence, number, term): without all of them a cosine with the template is less than ``MIN_COSINE``, as it
    is at most the root of the share of the template's squared norm that the shared terms have."""
    squares: dict = {}
    for licence, i, t, tf in tt:
        squares.setdefault((licence, i), []).append(((tf * weight[t]) ** 2, t))
    out = []
    for (licence, i), terms in squares.items():
        spare = (MIN_COSINE - 1e-6) ** 2 * sum(q for q, _ in terms)
        for q, t in sorted(terms):
            spare -= q
            if spare <= 0:
                out.append((licence, i, t))
    return out


def own_licences(files: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """``(rk, licence, cosine, share)`` of the file rows with a licence notice; share: of the file's words that
    are in lines with one. ``files`` has path and text."""
    spark = files.sparkSession
    tt = template_terms(templates)
    vocabulary = sorted({t for _, _, t, _ in tt})
    held = F.array(*[F.lit(t) for t in vocabulary])
    rows = files.select(row_key("path", "text").alias("rk"), "text", F.substring_index(F.coalesce("path", F.lit("")), "/", -1).rlike(NAMED).alias("named"))
    n = files.count()
    df = {r.t: r.n for r in rows.select(F.explode(F.array_intersect(terms_of(F.col("text")), held)).alias("t"))
          .groupBy("t").agg(F.count("*").alias("n")).collect()}               # at most the templates' terms
    weight = {t: idf(n, df.get(t, 0)) for t in vocabulary}
    norms: dict = {}
    for licence, i, t, tf in tt:
        norms[licence, i] = norms.get((licence, i), 0.0) + (tf * weight[t]) ** 2
    small = spark.createDataFrame([(lic, i, t, tf * weight[t] ** 2 / math.sqrt(norms[lic, i])) for lic, i, t, tf in tt],
                                  "licence string, number int, term string, w double")
    shares = {k: F.array(*[F.struct(F.lit(t).alias("term"), F.lit((tf * weight[t]) ** 2 / norms[k]).alias("q"))
                           for lic, i, t, tf in tt if (lic, i) == k]) for k in norms}
    units = written(_lines(rows, held, markers_of(tt, weight), shares)
                    .unionByName(_windows(rows, tt, markers_of(tt, weight), shares)).distinct(), "licence-units")
    key = ["rk", "line", "of", "of_number", "start"]
    other = written(units.select(F.explode("ts").alias("term")).distinct().where(~F.col("term").isin(vocabulary)), "licence-terms")
    counts = rows.select(F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    known = other.join(counts, "term").select("term", (F.log(F.least(F.lit(float(RARE)), (F.lit(n) + 1) / (F.col("n") + 1))) + 1).alias("idf")) \
        .unionByName(spark.createDataFrame(sorted(weight.items()), "term string, idf double"))
    tf = units.select(*key, F.size("ts").alias("words"), F.explode("ts").alias("term")).groupBy(*key, "words", "term").agg(F.count("*").alias("tf"))
    norm = tf.join(known, "term").groupBy(*key, "words").agg(F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2))).alias("norm"))
    dot = tf.join(F.broadcast(small), "term").where((F.col("of") == "") | (F.col("of") == F.col("licence")) & (F.col("of_number") == F.col("number"))) \
        .groupBy(*key, "licence", "number").agg(F.sum(F.col("tf") * F.col("w")).alias("dot"))
    scored = written(dot.join(norm, key).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("cosine") >= MIN_COSINE), "licence-scores")
    best = scored.groupBy("rk").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("best"))
    in_lines = scored.where("of = ''").select("rk", "line", "words").distinct().groupBy("rk").agg(F.sum("words").alias("line_words"))
    in_windows = scored.where("of <> ''").select(*key).join(units, key) \
        .select("rk", F.col("of").alias("licence"), F.col("of_number").alias("number"), "start", F.posexplode("ts").alias("at", "term")) \
        .join(F.broadcast(small), ["licence", "number", "term"]).select("rk", (F.col("start") + F.col("at")).alias("at")).distinct() \
        .groupBy("rk").agg(F.count("*").alias("window_words"))
    size = rows.select("rk", F.size(terms_of(F.col("text"))).alias("all_words")).groupBy("rk").agg(F.max("all_words").alias("all_words"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return best.join(in_lines, "rk", "left").join(in_windows, "rk", "left").join(size, "rk").select(
        "rk", F.col("best.licence").alias("licence"), (-F.col("best.c")).alias("cosine"),
        F.least(F.lit(1.0), F.greatest(zero("line_words"), zero("window_words")) / F.col("all_words")).alias("share"))


def _enough(parts: Column, terms: Column) -> Column:
    """Whether the template's terms among ``terms`` have the share of its squared norm that the least cosine needs."""
    return F.aggregate(F.filter(parts, lambda p: F.array_contains(terms, p.term)), F.lit(0.0), lambda a, p: a + p.q) >= MIN_COSINE**2 - 1e-6


def _lines(rows: DataFrame, held: Column, marks: list, shares: dict) -> DataFrame:
    """Every line, and the whole text of files named like a licence file, that can reach the least cosine with some template."""
    markers = F.array(*[F.lit(t) for t in sorted({t for _, _, t in marks})])
    return rows.select("rk", F.posexplode(F.concat(
        F.split(F.coalesce("text", F.lit("")), "\n"), F.when(F.col("named"), F.array("text")).otherwise(F.array().cast("array<string>")))).alias("line", "unit")) \
        .select("rk", "line", terms_of(F.col("unit")).alias("ts")).where(F.arrays_overlap("ts", markers)) \
        .where(F.exists(F.array(*shares.values()), lambda parts: _enough(parts, F.array_intersect(F.col("ts"), held)))) \
        .select("rk", "line", F.lit("").alias("of"), F.lit(-1).alias("of_number"), F.lit(-1).alias("start"), "ts")


def _windows(rows: DataFrame, tt: list, marks: list, shares: dict) -> DataFrame:
    """Every run of words of a file, as long as a template and across line ends, that can reach the least cosine with it. Only
    the words around a marker travel."""
    sizes: dict = {}
    for licence, i, _, tf in tt:
        sizes[licence, i] = sizes.get((licence, i), 0) + tf
    reach = max(sizes.values(), default=1) - 1
    markers = F.array(*[F.lit(t) for t in sorted({t for _, _, t in marks})])
    spark = rows.sparkSession
    begins = spark.createDataFrame([(t, lic, i, sizes[lic, i]) for lic, i, t in marks], "term string, of string, of_number int, size int")
    parts = spark.createDataFrame(sorted(shares), "of string, of_number int").withColumn("parts", F.coalesce(*[
        F.when((F.col("of") == lic) & (F.col("of_number") == i), c) for (lic, i), c in shares.items()]))
    hits = F.filter(F.transform("ts", lambda t, i: F.struct(i.alias("i"), t.alias("term"))), lambda x: F.array_contains(markers, x.term))
    near = F.transform(hits, lambda h: F.struct(
        h.i.alias("i"), h.term.alias("term"), F.greatest(F.lit(0), h.i - reach).alias("first"),
        F.slice(F.col("ts"), F.greatest(F.lit(0), h.i - reach) + 1, F.lit(2 * reach + 1)).alias("near")))
    around = rows.select("rk", terms_of(F.col("text")).alias("ts")).where(F.arrays_overlap("ts", markers)) \
        .select("rk", F.size("ts").alias("n"), F.explode(near).alias("h")).select("rk", "n", "h.*")
    starts = around.join(F.broadcast(begins.join(parts, ["of", "of_number"])), "term").where((F.col("n") >= F.col("size")) & _enough(F.col("parts"), F.col("near"))) \
        .withColumn("start", F.explode(F.sequence(F.greatest(F.lit(0), F.col("i") - F.col("size") + 1), F.least("i", F.col("n") - F.col("size")))))
    return starts.withColumn("ts", F.slice("near", F.col("start") - F.col("first") + 1, F.col("size"))).where(_enough(F.col("parts"), F.col("ts"))) \
        .select("rk", F.lit(-1).alias("line"), "of", "of_number", "start", "ts")


def directory(path: Column) -> Column:
    """The path up to its last slash; the root is the empty string."""
    p = F.coalesce(path, F.lit(""))
    return F.regexp_replace(F.substring(p, F.lit(1), F.length(p) - F.length(F.substring_index(p, "/", -1))), "/+$", "")


def ancestors(path: Column) -> Column:
    """A directory, its parent, and so on to the root, as (dir, up) with the number of steps up."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.when(path == "", 0).otherwise(F.size(parts))), lambda k: F.struct(
        F.array_join(F.slice(parts, F.lit(1), F.size(parts) - k), "/").alias("dir"), k.alias("up")))


def scan(files: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """``files`` with licence, cosine, origin (own, inherited, none) and licence_dir (where it comes from)."""
    own = written(own_licences(files.select("path", "text"), templates), "licences")
    keep = [c for c in files.columns if c not in ("licence", "cosine", "origin", "licence_dir")]
    f = files.select(*keep).withColumn("__rk", row_key("path", "text")).withColumn("__dir", directory(F.col("path")))
    o = own.withColumnRenamed("rk", "__rk").withColumnsRenamed({"licence": "__own", "cosine": "__cos"})
    located = f.select("__rk", "__dir", "path").join(o, "__rk").where(
        (F.col("share") >= OWN_SHARE) | F.substring_index(F.coalesce("path", F.lit("")), "/", -1).rlike(NAMED))
    speaks = located.groupBy("__dir").agg(F.min(F.struct((-F.col("__cos")).alias("c"), F.col("__own").alias("licence"), "path")).alias("s"))
    speaks = written(speaks.select(F.col("__dir").alias("dir"), "s"), "licence-dirs")
    dirs = f.select("__dir").distinct().select("__dir", F.explode(ancestors(F.col("__dir"))).alias("a")).select("__dir", "a.dir", "a.up")
    near = dirs.join(speaks, "dir").groupBy("__dir").agg(F.min(F.struct("up", "dir", "s")).alias("near"))
    out = f.join(o.drop("share"), "__rk", "left").join(near, "__dir", "left")
    return out.select(
        *keep, F.coalesce("__own", "near.s.licence").alias("licence"), F.coalesce("__cos", -F.col("near.s.c")).alias("cosine"),
        F.when(F.col("__own").isNotNull(), "own").when(F.col("near").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("__own").isNull(), F.col("near.dir")).otherwise(F.col("__dir")).alias("licence_dir"))
