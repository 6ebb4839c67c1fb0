"""Every document operator on nulls, empty and long texts, ties, repeated rows, clashing extra columns and
an empty table; results against brute force where SQL has no oracle."""

import math
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from starhouse.llm import decontam, language_id, license_scan, line_dedup, lm_scoring, minhash_dedup, quality_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, rk string, n_hit string, slot string, label string"
BASE = "the quick brown fox jumps over the lazy dog while many other animals look at it from far away and then go home again"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
SHARED = "A line that quite a few documents share"


def rows():
    words = BASE.split()
    texts = {
        1: BASE, 2: BASE, 3: BASE + " now", 4: "  " + BASE.upper() + "\n", 5: None, 6: "", 7: " \n\t ", 8: "two words", 9: "Two  WORDS",
        10: SHARED + "\nown line number ten\n" + SHARED, 11: "  " + SHARED.upper() + "\nown eleven", 12: LONG, 13: LONG + " end", 14: "12 34 !!",
        15: " ".join(words[:18] + ["x", "y"] + words[18:]), 16: "\n\n", 17: SHARED, 18: "éÀ ß 漢字 ÉCOLE été", 9007199254740993: BASE + " again and again",
    }
    out = [(i, t, None if i % 4 == 0 else ("en", "fr")[i % 2], None if i == 3 else f"s{min(i, 3)}", None, 0.5, "rk", "n", "s", "l") for i, t in texts.items()]
    return out + [out[0], out[0], (None, BASE + " null id", "en", "s1", 3, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


def empty(docs):
    return docs.limit(0)


def test_minhash_against_brute_force(docs):
    got = minhash_dedup.dedup(docs, k=4).collect()
    data = [(r[0], minhash_dedup.shingle_sets([r[1]], 4)[0]) for r in rows()]
    parent = {i: i for i, _ in data if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in data:
        for j, b in data:
            if i is not None and j is not None and len(a) and len(b):
                common = len(set(a.tolist()) & set(b.tolist()))
                if 100 * common >= 80 * (len(a) + len(b) - common):
                    x, y = root(i), root(j)
                    parent[max(x, y)] = min(x, y)
    want = Counter((i, len(s), None if i is None else root(i)) for i, s in data)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert minhash_dedup.dedup(empty(docs)).count() == 0


def test_minhash_large_groups_with_unlinked_members(spark):
    """Buckets over the size at which all pairs are compared: copies, chains, and texts that only share a passage."""
    import random
    rng = random.Random(3)
    word = lambda: f"v{rng.randrange(10**6)}"
    base, passage, texts = [word() for _ in range(120)], [word() for _ in range(150)], []
    for i in range(260):
        t = list(base)
        for _ in range(rng.randrange(0, 7)):
            t[rng.randrange(len(t))] = word()
        texts.append(" ".join(t))
        texts.append(" ".join(passage + [word() for _ in range(30 + i % 30)]))
    got = {r.doc_id: r.component_id for r in minhash_dedup.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), k=4).collect()}
    sets = [set(s.tolist()) for s in minhash_dedup.shingle_sets(texts, 4)]
    comp = list(range(len(texts)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            c = len(a & sets[j])
            if 100 * c >= 80 * (len(a) + len(sets[j]) - c):
                x, y = root(i), root(j)
                comp[max(x, y)] = min(x, y)
    assert got == {i: root(i) for i in range(len(texts))}


def test_line_dedup(docs):
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).collect()
    assert len(out) == len(rows())
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    assert (by[10].n_lines, by[10].n_dropped) == (3, 0)          # the first holder keeps all its lines
    assert by[11].text == "own eleven" and by[17].text == "" and by[17].n_dropped == 1
    assert by[5].text is None and by[5].n_lines == 1 and by[6].n_lines == 1 and by[7].n_lines == 2
    assert by[2].text == "" and by[1].text == BASE and by[8].text == "two words"
    assert by[4].text == "" and by[9].rk == "rk"
    assert line_dedup.keep_bitmaps(empty(docs)).count() == 0


def test_line_dedup_hot_line_over_many_partitions(spark):
    data = [(i, SHARED + f"\nsome line {i % 7} of many\n" + SHARED) for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    saved = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = {r.doc_id: r.n_dropped for r in line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", saved)
    assert out == {i: (0 if i == 0 else 2 if i < 7 else 3) for i in range(400)}


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, BASE), (1, BASE), (2, "two words"), (3, None), (4, "..."), (None, "own eleven"), (5, "absent words here")], "item_id long, text string")
    out = decontam.decontaminate(docs, items).collect()
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    n = len(BASE.split())
    assert (by[1].n_words, by[1].n_hit, by[1].items) == (n, n, ["1"]) and by[4].n_hit == n and by[3].n_hit == n
    assert by[15].n_hit == 18 and by[8].items == by[9].items == ["2"] and by[11].items == [""] and by[11].n_hit == 2
    assert by[5].n_words == by[6].n_words == 0 and by[12].n_hit == 0 and by[12].n_words == 60_000
    assert decontam.decontaminate(empty(docs), items).count() == 0
    assert {r.n_hit for r in decontam.decontaminate(docs, items.limit(0)).collect()} == {0}
    near = decontam.proximity(docs, spark.createDataFrame([(1, BASE)], "item_id long, text string"), slop=3).collect()
    assert len({r.rk for r in near}) == 7       # rows of equal id and text are one


def test_language(docs):
    model = language_id.fit(docs)
    out = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert {out[i].lang_pred for i in (5, 6, 7, 14, 16)} == {"und"} and out[5].score == 0
    assert all(0 <= r.score <= 1 for r in out.values()) and out[1].lang_pred in ("en", "fr")
    assert language_id.predict(docs, language_id.fit(empty(docs))).where("lang_pred <> 'und'").count() == 0
    assert language_id.predict(empty(docs), model).count() == 0


def test_quality(docs):
    out = quality_rules.judge(docs).collect()
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    assert len(out) == len(rows()) and by[5].n_words == 0 and by[5].base_failed and not by[5].kept
    assert by[10].n_dup_lines == 1 and by[12].n_words == 60_000 and by[12].n_repeat_words == 60_000
    assert quality_rules.judge(empty(docs)).count() == 0


def test_lm_against_brute_force(docs, spark):
    import pyspark.sql.functions as F
    marked = docs.withColumn("train", F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True)))
    out = lm_scoring.score(marked).collect()
    c, n_docs = Counter(), 0
    toks = lambda t: (t or "").encode().lower().split() + [None]
    for r in rows():
        if r[0] is None or r[0] % 3 != 0:
            c.update(toks(r[1]))
    n, v = sum(c.values()), len(c)
    texts = {r[0]: r[1] for r in rows() if r[0] is not None}
    assert len(out) == len(rows())
    for r in out:
        if r.doc_id is None:
            continue
        ws = toks(texts[r.doc_id])
        want = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert abs(r.base_score - want) <= 1e-9 * abs(want) + 1e-9 and math.isfinite(r.score) and r.score < 0
    assert lm_scoring.score(empty(marked)).count() == 0


def test_licences(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = [("a/LICENSE", mit, 1), ("a/x.c", "code", 2), ("a/b/y.c", "code\n" + gpl + "\n" + BASE, 3), ("a/b/z.c", None, 4), ("q.c", "", 5),
             ("d/COPYING.txt", gpl + "\n" + BASE * 3, 6), ("d/e/f/g.c", LONG, 7), (None, None, 8), ("a/x.c", "code", 2)] + [(f"n/{i}.c", BASE, 100 + i) for i in range(60)]
    out = license_scan.scan(spark.createDataFrame(files, "path string, text string, licence long")).collect()
    by = {r.path: (r.licence, r.origin, r.licence_dir) for r in out}
    assert len(out) == len(files)
    assert by["a/LICENSE"] == ("MIT", "own", "a") and by["a/x.c"] == ("MIT", "inherited", "a") and by["a/b/y.c"][:2] == ("GPL-3.0", "own")
    assert by["a/b/z.c"] == ("MIT", "inherited", "a") and by["q.c"][1] == by[None][1] == "none" and by["d/e/f/g.c"] == ("GPL-3.0", "inherited", "d")
    assert license_scan.scan(spark.createDataFrame([], "path string, text string")).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    spark.createDataFrame([(1, " ".join(LONG.split()[100:140]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, at, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{i}")
        assert name == "mixing" or out.columns == docs.columns
        none = stage(spark, docs.limit(0), str(tmp_path))
        assert none.count() == 0
        at = spark.read.parquet(f"{tmp_path}/{i}")
    left = [r.doc_id for r in at.collect()]
    assert len(left) == len(set(left)) and 1 in left and not {2, 4, 5, 6, 7, 14, 16, 17} & set(left)
    assert zlib.crc32(b"1") % 4 >= 0
