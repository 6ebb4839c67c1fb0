"""Append-only silver transaction tables, safe to re-run.

Appending the same batch twice must not duplicate orders (a duplicated order
multiplies fact rows). Only rows whose key the whole target does not hold yet
are written: one left-anti join on the key column, whatever the batch's size
(after a bitmap of the batch's keys has kept most of the target out of it),
so a key re-sent in another partition is skipped too. A row without a key is
compared as a whole row, with the target's rows without a key only; lineage
columns (the run's time) are no part of it, or every re-run would write it again.

``scope='partition'`` is an opt-in for sources that never re-send a key under
another partition value: the target scan is then limited to the range of the
batch's partition values (two scalars), and partition value and key must match.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.sieve import sifted
from ..session import scratch_scope, shuffles_freed, staged
from .versioned import PARQUET_OPTIONS, path_missing

#: Columns that say when a row was processed, not what it is.
LINEAGE = ("processing_timestamp",)


def _target(df: DataFrame, path: str) -> DataFrame | None:
    try:
        # declared schema: partition values keep their string type on read
        return df.sparkSession.read.schema(df.schema).parquet(path)
    except AnalysisException as e:
        if path_missing(e):
            return None
        raise


def _in_batch_range(existing: DataFrame, df: DataFrame, partition_by: str) -> DataFrame:
    low, high = df.agg(F.min(partition_by), F.max(partition_by)).first()
    p = F.col(partition_by)
    return existing.filter(p.isNull() if low is None else p.between(low, high) | p.isNull())


def unseen(df: DataFrame, path: str, key: str, partition_by: str | None = None,
           scope: str = "table", keys_first: bool = False) -> DataFrame:
    """Rows of ``df`` that the table at ``path`` does not hold yet, by key (rows without one: as a whole).

    ``keys_first``: the batch's keys that the table holds are found by the key columns alone and written to scratch. There are
    none or few as a rule, so the batch's rows are compared with a small list and need no exchange."""
    if scope not in ("table", "partition"):
        raise ValueError(f"scope must be 'table' or 'partition', got {scope!r}")
    existing = _target(df, path)
    if existing is None:
        return df
    same = [key]
    if partition_by is not None and scope == "partition":
        existing = _in_batch_range(existing, df, partition_by)
        same = [key, partition_by]

    def missing(rows: DataFrame, held: DataFrame, columns: list[str]) -> DataFrame:
        d, t = rows.alias("d"), held.select(*columns).alias("t")
        return d.join(t, [F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in columns], "left_anti")

    null = F.col(key).isNull()
    # most of a large target's keys are ruled out before the join's exchange
    near = sifted(existing.filter(~null).select(*same), df, key)
    if keys_first:
        d, t = df.filter(~null).select(*same).alias("d"), near.alias("t")
        near = staged(d.join(t, [F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in same], "left_semi").distinct(), "append-held")
    return missing(df.filter(~null), near, same).unionByName(
        missing(df.filter(null), existing.filter(null), [c for c in df.columns if c not in LINEAGE]))


def append_new(df: DataFrame, path: str, key: str, partition_by: str = "partition_date",
               dedupe: bool = True, scope: str = "table", reread: bool = False) -> int:
    """Append ``df`` partitioned by ``partition_by``; with ``dedupe`` skip rows already loaded.
    Returns the number of rows written.

    Rows are range-partitioned on (partition value, key): each task writes a
    contiguous run of partition directories (few files), and a hot partition
    value still spreads over tasks by key. The same exchange clusters equal
    rows, so dropping exact in-batch duplicates (a file delivered twice) adds
    no shuffle; rows that share a key but differ are kept for the audit.

    The batch is written to scratch once, as several steps read it. With ``reread`` (rows that are merely
    parsed from files) the first load, which has no target to compare with, parses it again for the ranges instead.
    """
    with scratch_scope(df.sparkSession):
        if dedupe:
            # read by the bitmap, the join and the range partitioner: computed once
            if not reread or _target(df, path) is not None:
                df = staged(df, "append-batch")
            rows = unseen(df, path, key, partition_by, scope, keys_first=True).repartitionByRange(F.col(partition_by), F.col(key)).distinct()
        else:
            rows = df.repartitionByRange(F.col(partition_by), F.col(key))
        written = Observation()
        with shuffles_freed(df.sparkSession):
            (rows.observe(written, F.count(F.lit(1)).alias("rows"))
             .write.mode("append").partitionBy(partition_by)
             .options(**PARQUET_OPTIONS).parquet(path))
        return written.get["rows"]


def read_transactions(spark, path: str, schema) -> DataFrame:
    """Read a partitioned silver table with its declared schema (no partition type inference)."""
    return spark.read.schema(schema).parquet(path)
