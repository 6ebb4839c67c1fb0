"""Staged, re-runnable replacement of a Parquet target.

Each publish writes a new immutable directory ``v=<n>`` and only then appends
one row to the ``_commits`` log. Readers resolve the last committed version,
so a failure mid-write leaves the previous version in force, and a re-run
overwrites the uncommitted directory. Nothing is ever written onto the path
being read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffles_freed
from .verify import Watched, verify

PARQUET_OPTIONS = {"compression": "snappy"}

COMMIT_SCHEMA = T.StructType([
    T.StructField("version", T.LongType(), False),
    T.StructField("max_key", T.LongType(), True),
    T.StructField("as_of", T.StringType(), True),
    T.StructField("base", T.LongType(), True),                              # first run whose closed rows count
    T.StructField("buckets", T.ArrayType(T.IntegerType()), True),           # buckets that the run wrote
])


def path_missing(exc: AnalysisException) -> bool:
    """True only for 'path does not exist'; any other failure must surface."""
    cond = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass", None)
    return (cond() if cond else "") == "PATH_NOT_FOUND"


class CommitLog:
    """Append-only log of committed versions: one tiny Parquet file per commit."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/_commits"

    def rows(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(COMMIT_SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if path_missing(e):
                return None
            raise

    def last(self):
        """The newest commit row, or None when the target has never been committed."""
        log = self.rows()
        return None if log is None else log.orderBy(F.col("version").desc()).first()

    def append(self, version: int, max_key: int | None = None, as_of: str | None = None,
               base: int | None = None, buckets: list[int] | None = None) -> None:
        row = self.spark.createDataFrame([(version, max_key, as_of, base, buckets)], COMMIT_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path)


class VersionedTable:
    """A Parquet table replaced by whole versions under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, self.root)

    def version_path(self, n: int) -> str:
        return f"{self.root}/v={n:06d}"

    def version(self) -> int | None:
        last = self.log.last()
        return None if last is None else last["version"]

    def exists(self) -> bool:
        return self.version() is not None

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        n = self.version()
        if n is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.version_path(n))

    def publish(self, df: DataFrame, partition_by: list[str] | None = None,
                options: dict | None = None, as_of: str | None = None,
                single_file: bool = False, verified: bool = False) -> int:
        """Write ``df`` as the next version, then commit it.

        ``verified``: read it back first and compare rows and content; a version that differs isn't committed.

        ``single_file``: write one file, by one task. It is the caller's
        choice, for tables that are small by their nature (a calendar).
        """
        if single_file:
            df = df.repartition(1)      # computed by all tasks, written by one
        n = (self.version() or 0) + 1
        watched = Watched(df) if verified else None
        columns, df = df.columns, watched.df if verified else df
        writer = df.write.mode("overwrite").format("parquet").options(**{**PARQUET_OPTIONS, **(options or {})})
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with shuffles_freed(self.spark):
            writer.save(self.version_path(n))
        if verified:
            back = self.spark.read.schema(df.schema).parquet(self.version_path(n))
            verify(watched.fingerprint, back, columns, self.version_path(n))
        self.log.append(n, as_of=as_of)
        return n

    def publish_parts(self, parts: Iterable[DataFrame], as_of: str | None = None) -> int:
        """Write the frames of ``parts`` one after another as the next version, then commit it."""
        n = (self.version() or 0) + 1
        for at, df in enumerate(parts):
            with shuffles_freed(self.spark):
                df.write.mode("append" if at else "overwrite").format("parquet").options(**PARQUET_OPTIONS).save(self.version_path(n))
        self.log.append(n, as_of=as_of)
        return n

    def replace_partitions(self, df: DataFrame, partition_by: list[str],
                           options: dict | None = None) -> int:
        """Replace, in the committed version, exactly the partitions present in ``df``.

        Dynamic partition overwrite: Spark stages the new files and swaps each
        touched partition directory at job commit; partitions absent from
        ``df`` are left as they are. Used for re-runs over a partition range
        (e.g. late orders for past dates) without rewriting the whole table.
        """
        n = self.version()
        if n is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        (df.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .options(**{**PARQUET_OPTIONS, **(options or {})})
         .partitionBy(*partition_by)
         .parquet(self.version_path(n)))
        return n

