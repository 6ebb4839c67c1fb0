"""Corpus pipeline: language ID, line dedup, near-duplicate removal, decontamination, source mixing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of documents; a stage's own columns are
dropped. Null and empty texts, repeated rows, clashing extra columns and empty tables are handled as
the operators say; rows of equal doc_id and text are the same document to the joins below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.llm import decontam, language_id, line_dedup, minhash_dedup, mixing
from starhouse.llm.common import row_key, table, written
from starhouse.llm.queries import held_out

#: A document whose best language has less than this posterior probability is rejected.
MIN_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognisable language stay: not ``und``, and a score of `MIN_LANGUAGE_SCORE` or more."""
    model = language_id.fit(docs.where(~held_out(4)))
    marked = docs.select(F.struct(*docs.columns).alias("d"), "text")
    known = (F.col("lang_pred") != language_id.UND) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return language_id.predict(marked, model).where(known).select("d.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines seen in an earlier document go; n_chars follows. Documents that lose all their words go too."""
    thin = docs.select("doc_id", "text", F.struct(*docs.columns).alias("d"))
    out = line_dedup.apply_bitmaps(thin, line_dedup.keep_bitmaps(docs.select("doc_id", "text")))
    blank = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("d.n_chars")) if "n_chars" in docs.columns else None}
    return out.where(blank | (F.col("n_dropped") == 0)).select(
        *[changed[c].alias(c) if changed.get(c) is not None else F.col(f"d.{c}") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5-word shingles, similarity 0.8) stays, and one row of
    rows of equal doc_id and text."""
    found = minhash_dedup.dedup(docs.select("doc_id", "text"))
    gone = found.where("NOT kept").select(F.col("rk").alias("__rk")).distinct()
    marked = docs.select(F.struct(*docs.columns).alias("d"), row_key("doc_id", "text").alias("__rk"))
    return marked.join(gone, "__rk", "left_anti").dropDuplicates(["__rk"]).select("d.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least a twentieth is in benchmark passages go."""
    marked = docs.select("doc_id", "text", F.struct(*docs.columns).alias("d"))
    out = decontam.decontaminate(marked, table(spark, sf_dir, "benchmark"))
    return out.where(~decontam.contaminated()).select("d.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its slot in the mixture, and the phase of the slot."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("minhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: Language ID and MinHash are no SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
