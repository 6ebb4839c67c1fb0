"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.llm import (
    chat_format,
    decontam,
    html_extract,
    language_id,
    license_scan,
    line_dedup,
    lm_scoring,
    minhash_dedup,
    mixing,
    quality_rules,
    spelling,
    suffix_dedup,
    vector_codes,
)
from starhouse.llm.common import table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    events = chat_format.from_turns(turns.unionByName(probe))
    return chat_format.digest(chat_format.read_back(chat_format.render(chat_format.fold(events))))


def held_out(divisor: int):
    """Documents kept from learning: the crc32 of the id as text leaves remainder 2."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(divisor)) == 2


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole document, learned from the rows that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(4).alias("held_out"))
    model = language_id.fit(docs.where(~F.col("held_out")))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model) \
        .select("doc_id", "held_out", "lang_pred", "score")


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash_dedup.dedup(docs, k=4, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(7).alias("held_out"))
    return lm_scoring.score(docs.withColumn("train", ~F.col("held_out"))).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages, html_extract.fit(pages)).select("page_id", "url", "text", "n_chars")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source / language / hundreds of the id / id."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    path = F.concat_ws("/", part("source"), part("lang"), F.coalesce(F.floor(F.col("doc_id") / 100).cast("string"), F.lit("null")),
                       F.concat(part("doc_id"), F.lit(".txt")))
    docs = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return license_scan.scan(docs).select("doc_id", "path", "licence", "cosine", "origin", "licence_dir")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      decontam.contaminated().alias("contaminated"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in the mixture of sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "source", "slot", "phase")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words, form and root."""
    return spelling.group(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated strings."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffix_dedup.remove(docs, suffix_dedup.repeated_spans(docs))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as four codebook indexes."""
    out = vector_codes.encode(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_format": op1_chat_format,
        "op2_language_id": op2_language_id,
        "op3_minhash_dedup": op3_minhash_dedup,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_quality_rules": op5_quality_rules,
        "op6_line_dedup": op6_line_dedup,
        "op7_html_extract": op7_html_extract,
        "op8_license_scan": op8_license_scan,
        "op9_decontamination": op9_decontamination,
        "op10_mixing": op10_mixing,
        "op11_spelling": op11_spelling,
        "op12_suffix_dedup": op12_suffix_dedup,
        "op13_vector_codes": op13_vector_codes,
    }
