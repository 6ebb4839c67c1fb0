"""Constraint audit: declared keys, NOT NULL and VARCHAR byte limits, checked over data.

The audited frame is computed once: its key columns and a boolean for each null
and length check are written to the shared folder, and all checks read that.
Null and length checks share one scan of it (a single global aggregate); each key
rule is a ``groupBy(key).count()`` whose partial aggregation collapses a hot
key map-side. The result has one row per (check, column).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from ..sources.schemas import TableRules


def _dup_rows(df: DataFrame, cols: tuple[str, ...], table: str, check: str) -> DataFrame:
    """Rows whose key (all parts non-null) occurs more than once."""
    keyed = df.select(*cols)
    for c in cols:
        keyed = keyed.filter(F.col(c).isNotNull())
    dups = (keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1)
            .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations")))
    return dups.select(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                       F.lit(",".join(cols)).alias("column_name"), "violations")


def audit(df: DataFrame, rules: TableRules) -> DataFrame:
    """Violation counts: primary_key / unique duplicates, not_null, max_bytes."""
    checks = [("not_null", c, F.col(c).isNull()) for c in rules.not_null]
    checks += [("max_bytes", c, F.octet_length(F.col(c)) > n) for c, n in rules.max_bytes.items()]
    parts = []
    keys = dict.fromkeys(c for cols in ([rules.primary_key] if rules.primary_key else []) + list(rules.unique) for c in cols)
    df = staged(df.select(*keys, *[cond.alias(f"v{i}") for i, (_, _, cond) in enumerate(checks)]), "audit")
    if checks:
        agg = df.agg(*[F.sum(F.when(F.col(f"v{i}"), 1).otherwise(0)).cast("long").alias(f"v{i}")
                       for i in range(len(checks))])
        rows = F.array(*[F.struct(F.lit(rules.table).alias("table_name"),
                                  F.lit(kind).alias("check_name"),
                                  F.lit(col).alias("column_name"),
                                  F.coalesce(F.col(f"v{i}"), F.lit(0)).cast("long").alias("violations"))
                         for i, (kind, col, _) in enumerate(checks)])
        parts.append(agg.select(F.inline(rows)))
    if rules.primary_key:
        parts.append(_dup_rows(df, rules.primary_key, rules.table, "primary_key"))
    for cols in rules.unique:
        parts.append(_dup_rows(df, cols, rules.table, "unique"))
    return reduce(DataFrame.unionByName, parts)
