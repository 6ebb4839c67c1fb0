"""Star tables in the Spark catalog: definition, positional bulk load, verification, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.schemas import STAR, TableRules
from .verify import ContentMismatch, Watched, fingerprint, verify

DIM_WRITE_OPTIONS = {"compression": "snappy", "parquet.enable.dictionary": "true",
                     "parquet.page.size": "1048576"}


def table_ddl(database: str, rules: TableRules, location: str | None = None,
              buckets: int | None = None) -> str:
    cols = ",\n  ".join(f"{c} {t}" for c, t in rules.columns)
    layout = ""
    if buckets and rules.cluster_by:
        layout = f"\nCLUSTERED BY ({', '.join(rules.cluster_by)})"
        if rules.sort_by:
            layout += f" SORTED BY ({', '.join(rules.sort_by)})"
        layout += f" INTO {buckets} BUCKETS"
    loc = f"\nLOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {database}.{rules.table} (\n  {cols}\n) USING parquet{layout}{loc}"


def create_star(spark: SparkSession, database: str, root: str | None = None,
                buckets: int | None = None) -> list[str]:
    """Create the schema and the four star tables if absent (re-runnable).

    Keys are not declared (Parquet tables reject them); the audit checks them.
    VARCHAR(n) limits are enforced by Spark on insert. With ``buckets`` the
    fact is bucketed by its distribution key (product) and sorted by its sort
    key (order date, customer) within buckets, and dim_product is bucketed
    the same way, so joining them needs no exchange on either side.
    """
    db_loc = f" LOCATION '{root.rstrip('/')}/_database'" if root else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{db_loc}")
    for rules in STAR.values():
        loc = f"{root.rstrip('/')}/{rules.table}" if root else None
        spark.sql(table_ddl(database, rules, loc, buckets))
    return [f"{database}.{t}" for t in STAR]


def arranged(df: DataFrame, rules: TableRules, partition: str | None = None, balanced: bool = False) -> DataFrame:
    """``df`` laid out for its files: rows of a partition value together in balanced tasks (AQE splits a large value and
    joins small ones), each task's rows sorted by the declared sort key, strings as strings.
    ``balanced``: its tasks are even already and hold ranges of the sort key, as the fact's do, so rows stay where they are."""
    spread = df if balanced else df.hint("rebalance", partition) if partition else df.hint("rebalance")
    return spread.sortWithinPartitions(*([partition] if partition else []), *rules.sort_by)


def load_table(spark: SparkSession, path: str, table: str, partition_cols: tuple[str, ...] = (),
               overwrite: bool = False) -> None:
    """Append gold Parquet files into a star table (``overwrite``: replace its rows), matching columns by position.

    Partition columns discovered from directory names are not file columns
    and are dropped first (the fact's ``date_partition`` feeds the table's
    trailing ``order_date_key``). No dedupe, like a bulk COPY.
    """
    df = spark.read.parquet(path)
    files = df.select(*[c for c in df.columns if c not in partition_cols])
    files.write.insertInto(table, overwrite=overwrite)


def load_verified(spark: SparkSession, path: str, table: str, partition_cols: tuple[str, ...] = (), overwrite: bool = True) -> dict:
    """`load_table`, then the table's rows against the files': counts and content, by position. Raises on a difference."""
    df = spark.read.parquet(path)
    columns = [c for c in df.columns if c not in partition_cols]
    watched = Watched(df.select(*columns))
    before = None if overwrite else fingerprint(spark.table(table))
    watched.df.write.insertInto(table, overwrite=overwrite)
    if before is not None:
        found = fingerprint(spark.table(table))
        if found.rows - before.rows != watched.fingerprint.rows or found.total - before.total != watched.fingerprint.total:
            raise ContentMismatch(f"{table}: wrote {watched.fingerprint}, grew from {before} to {found}")
        return {"rows_written": watched.fingerprint.rows, "rows_read": found.rows - before.rows, "columns": len(columns)}
    back = spark.table(table)
    found = verify(watched.fingerprint, back.toDF(*columns), columns, table)
    return {"rows_written": watched.fingerprint.rows, "rows_read": found.rows, "columns": len(back.columns)}


def verify_load(spark: SparkSession, path: str, expected_rows: int | None = None,
                expected_columns: int | None = None) -> dict:
    """Read a written target back: row count, column count, schema."""
    back = spark.read.parquet(path)
    n = back.count()
    report = {"rows": n, "columns": len(back.columns), "schema": back.schema.simpleString()}
    report["ok"] = ((expected_rows is None or n == expected_rows)
                    and (expected_columns is None or len(back.columns) == expected_columns))
    return report


def export_dim(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write a dimension to ``path``, one file per task; ``single_file``: one file, by the caller's choice.
    The rows are computed in as many tasks as ever, and one more writes them."""
    (df.repartition(1) if single_file else df).write.mode("overwrite") \
        .options(**DIM_WRITE_OPTIONS).parquet(path)
