"""Texts of classes: a row each, whatever rows repeat, by one exchange of the texts."""

from starhouse.llm import minhash_dedup
from starhouse.llm.common import written


def test_one_text_of_a_class_without_another_exchange(spark):
    rows = [(i % 50, f"word{i % 50 // 2} and some more words") for i in range(200)]       # rows repeat, and two ids share a text
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sigs = written(minhash_dedup.signatures(docs, 3), "t-sigs")
    one = minhash_dedup._one_text(docs, sigs, sigs.select("cid").distinct())
    got = one.collect()
    assert len(got) == len({r.cid for r in got}) == len({r.text for r in got}) == 25
    plan = one._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    above = plan[:plan.index("SortMergeJoin")]
    assert "Exchange" not in above and "Sort [" not in above
