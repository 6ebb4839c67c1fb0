"""What a task sends to Python workers: batches bounded by bytes, and one worker at a time."""

import pandas as pd
import pytest

import corpus_pipeline
from starhouse.llm import language_id, line_dedup, minhash_dedup
from starhouse.llm.common import BATCH_BYTES

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def default_limit(spark):
    before = spark.conf.get(LIMIT)
    spark.conf.unset(LIMIT)
    yield
    spark.conf.set(LIMIT, before)


def texts(spark, n, width):
    return spark.range(0, n, 1, 1).selectExpr("id AS doc_id", f"concat('word', id, repeat(' more', {width}), '\\na line that all documents hold') AS text", "'en' AS lang")


def largest(docs):
    def sizes(batches):
        for b in batches:
            yield pd.DataFrame({"n": [int(b["text"].str.len().sum())]})

    return max(r.n for r in docs.select("text").mapInPandas(sizes, "n long").collect())


@pytest.mark.parametrize("step", [
    language_id.fit,
    lambda docs: language_id.predict(docs, language_id.Model([], [{} for _ in range(language_id.LONGEST + 1)], None)),
    line_dedup.keep_bitmaps,
    lambda docs: minhash_dedup.signatures(docs, 5),
])
def test_whole_texts_go_to_python_in_small_batches(spark, default_limit, step):
    docs = texts(spark, 6_000, 500)
    assert largest(docs) > 2 * BATCH_BYTES
    step(docs.limit(20))
    assert largest(docs) <= 1.1 * BATCH_BYTES


def test_a_smaller_limit_stays(spark, default_limit):
    for given, left in (("100000", "100000"), ("64k", "64k"), ("1MB", "1MB"), ("64MB", str(BATCH_BYTES)), ("1g", str(BATCH_BYTES))):
        spark.conf.set(LIMIT, given)
        minhash_dedup.signatures(texts(spark, 2, 5), 5)
        assert spark.conf.get(LIMIT) == left


def test_bitmaps_are_made_before_the_tasks_that_apply_them(spark):
    docs = texts(spark, 40, 5)
    out = corpus_pipeline.drop_repeated_lines(spark, docs, "")
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    kept = {r.doc_id: r.text for r in out.collect()}
    assert kept == {i: f"word{i}" + " more" * 5 + "\na line that all documents hold" * (i == 0) for i in range(40)}
