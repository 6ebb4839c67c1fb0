"""Language ID: the bounded sample counts different texts, and texts without evidence."""

from starhouse.llm import language_id as L


def test_a_hot_text_counts_once(spark):
    """A text in a third of the rows doesn't outweigh the others' words, nor fill the sample."""
    rows = [(f"eins zwei drei wort{i % 300} noch{i}", "de") for i in range(600)] + [("one two three hot text again", "en")] * 500 \
        + [(f"one two word{i % 300} more{i}", "en") for i in range(300)]
    labelled = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    once = spark.createDataFrame(sorted(set(rows)), "text string, lang string").repartition(3)
    a, b = L.fit(labelled, docs_per_lang=200), L.fit(once, docs_per_lang=200)
    assert a.langs == b.langs == ["de", "en"]
    assert [set(x) for x in a.index] == [set(x) for x in b.index]
    docs = spark.createDataFrame([(1, "eins zwei unbekannt"), (2, "one word more"), (3, None), (4, "123 !")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs, a).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4)] == ["de", "en", L.UND, L.UND] and all(0 <= s <= 1 for _, s in got.values())
