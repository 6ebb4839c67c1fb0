"""Dense surrogate keys without a single-partition window.

``row_number()`` over an unpartitioned window moves every row to one task. Here a key is the rows in
earlier ranges plus the position in the row's own range:

1. *Frozen bounds.* A sampled pass over the ordering columns alone gives the ranges' bounds, tuples of all
   ordering columns, so that trailing columns split a leading value that most rows share. A caller whose input
   is a join can hand in a sample from a narrower source, so that the join isn't run for it.
2. *Range of a row*: a binary search over the bounds, as an expression. It depends on the row alone, so a task
   that runs again deals its rows as before (a range exchange that is planned again could sample other bounds).
3. *One exchange*, by range. Counts per range are aggregated from it and their running sum, one row a range, is
   joined back by broadcast to the sorted rows. Spark runs an exchange that occurs twice in a plan once;
   the counts and the positions therefore read every column, by a hash, or column pruning would make two exchanges, and
   two runs of the input, out of it for a caller that selects some columns only.

Nothing is written while the plan is built; no row is stored besides the shuffle's own files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sampled rows per range. The driver holds (ranges x this) tuples while it chooses bounds.
SAMPLES_PER_RANGE = 20
#: Rows that a range holds at least, if the caller doesn't say how many ranges there are: a small input has few tasks.
ROWS_PER_RANGE = 10_000
_SEED = 11
_LOCAL = (1 << 33) - 1      # monotonically_increasing_id: the position is in the lower 33 bits


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def default_ranges(spark) -> int:
    """As many ranges as Spark would start a shuffle with."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


def sampled(keys: DataFrame, ranges: int) -> DataFrame:
    """About ``ranges * SAMPLES_PER_RANGE`` rows of ``keys``; all of them if it has no more."""
    return _sample(keys, keys.count(), ranges)


def _sample(keys: DataFrame, n: int, ranges: int) -> DataFrame:
    want = ranges * SAMPLES_PER_RANGE
    return keys if n <= want else keys.sample(fraction=want / n, seed=_SEED)


def sized_sample(keys: DataFrame, ranges: int | None = None) -> tuple[int, DataFrame]:
    """Ranges for the rows of ``keys``, `default_ranges` at most if not given, and a sample to choose their bounds from."""
    n = keys.count()
    ranges = ranges or min(default_ranges(keys.sparkSession), max(2, -(-n // ROWS_PER_RANGE)))
    return ranges, _sample(keys, n, ranges)


def frozen_bounds(sample: DataFrame, ranges: int) -> list[str]:
    """At most ``ranges - 1`` distinct tuples (as JSON) at even steps of the sorted sample, ascending."""
    rows = sample.orderBy(*sample.columns).select(F.to_json(F.struct(*sample.columns))).collect()
    out = []
    for i in range(1, ranges):
        row = rows[i * len(rows) // ranges][0] if rows else None
        if row is not None and (not out or row != out[-1]):
            out.append(row)
    return out


def range_of(key: Column, bounds: list[str], schema: T.StructType) -> Column:
    """Number of bounds that are not greater than ``key`` (a struct of the bounds' fields): a binary search."""
    if not bounds:
        return F.lit(0)
    held = F.from_json(F.lit(f"[{','.join(bounds)}]"), T.ArrayType(schema))     # a constant: read once a plan
    steps = [1 << b for b in range(len(bounds).bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda at, step: at + F.when(F.get(held, at + step - 1) <= key, step).otherwise(0))


def assign_dense_key(df: DataFrame, order_by: Sequence[Column | str], key_col: str,
                     start: int = 0, num_partitions: int | None = None,
                     sample: DataFrame | None = None) -> DataFrame:
    """Add ``key_col`` = ``start`` + 1..n following ``order_by`` (ascending, nulls first).

    ``sample``: rows of the ordering columns, in order, to choose bounds from (see `sampled`); by default
    they are sampled from ``df``. Bad bounds make uneven ranges, never wrong keys. Rows equal on every
    ordering column get consecutive keys in any order; give a unique ordering when the key must be
    reproducible per row.
    """
    names = [f"_k{i}" for i in range(len(order_by))]
    cols = [_as_col(c).alias(n) for c, n in zip(order_by, names, strict=True)]
    if sample is None:
        ranges, sample = sized_sample(df.select(*cols), num_partitions)
    else:
        ranges = num_partitions or default_ranges(df.sparkSession)
    sample = sample.toDF(*names)
    bounds = frozen_bounds(sample, ranges)
    at = range_of(F.struct(*cols), bounds, sample.schema)
    ranged = df.withColumn("_k_range", at).repartitionById(len(bounds) + 1, F.col("_k_range"))
    every = F.xxhash64(*df.columns)
    counts = ranged.groupBy("_k_range").agg(F.count(F.lit(1)).alias("_k_n"), F.max(every).alias("_k_read"))
    before = Window.orderBy("_k_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.where(F.col("_k_read").isNotNull()) \
        .select("_k_range", F.coalesce(F.sum("_k_n").over(before), F.lit(0)).alias("_k_off"))
    local = F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL)) + every.bitwiseAND(F.lit(0))
    rows = ranged.sortWithinPartitions(*[_as_col(c) for c in order_by]).withColumn("_k_pos", local)
    key = (F.lit(start).cast("long") + F.col("_k_off") + F.col("_k_pos") + F.lit(1)).cast("long")
    # one row a range. A struct as the join's key: from an equality of the ranges themselves Spark infers a filter of the
    # offsets by the ordering columns, which they don't have, and the first plan of a session can fail by it.
    offsets = F.broadcast(offsets.select(F.struct("_k_range").alias("_k_at"), "_k_off"))
    return rows.join(offsets, F.struct("_k_range") == F.col("_k_at")).select(*df.columns, key.alias(key_col))
