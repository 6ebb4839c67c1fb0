"""Shared helpers of the training-data operators: word rules, row keys, written intermediate tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.session import delete_path, scratch_path

#: Blank characters of the word rule: space and \t \n \v \f \r, as bytes.split() has them.
BLANK = r"[\x20\x09-\x0D]"
#: Bytes of rows that go to a Python worker at once. Arrow buffers, outside the heap, and the worker's copies follow it.
BATCH_BYTES = 4 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column) -> Column:
    """Maximal runs of non-blank characters; an empty array for null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK + "+"), lambda w: w != "")


def row_key(*cols: str) -> Column:
    """64-bit key of a row's contents. Equal rows share it, whatever scan they come from."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in cols])


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder and read from there: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._starhouse_path = path
    return out


def drop_written(*frames: DataFrame | None) -> None:
    """Delete written tables that no later step reads."""
    for df in frames:
        path = getattr(df, "_starhouse_path", None)
        if path:
            delete_path(df.sparkSession, path)


def small_batches(spark: SparkSession) -> None:
    """From now on whole texts go to Python workers in batches of at most `BATCH_BYTES`: 10,000 texts at once, as rows are
    counted by default, take tens of MB a task in the JVM's buffers and again in the worker. A smaller limit stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = re.fullmatch(r"(\d+)([bkmgt]?)b?", spark.conf.get(name).lower())      # as 67108864b, 64m, 64MB
    if not size or int(size[1]) << 10 * "bkmgt".index(size[2] or "b") > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def chunks(sizes, limit: int):
    """Consecutive (start, end) ranges whose sizes add up to about ``limit``; one item may exceed it."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
