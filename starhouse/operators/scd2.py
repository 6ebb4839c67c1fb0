"""Type-2 history for versioned entities (customers, products).

A batch row is *new* when no current row has its key (null keys never match,
so they are new on every run), *changed* when some current row with its key
has a different hash, else *unchanged*. Keys missing from the batch stay
current (no delete detection).

The merge is one left join of the batch to per-key hash bounds of the current
rows (the bounds collapse map-side, so a hot key costs one row), one left join
of the current rows to the changed keys (expiry), and a dense key for the
inserted versions: changed rows first, then new rows, each by key. Changed keys
come from the hash bounds of both sides, one row per key, so a batch key
holding most rows doesn't meet the expiry join. The batch is parsed and hashed
once, into a written table that all of these read; the ranges of the inserted
versions' keys are sampled from it too, so the classification runs once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import change_hash, standardized
from ..sources.schemas import FAR_FUTURE, EntitySpec
from ..session import staged
from .keys import assign_dense_key, sized_sample

VERSION_COLS = ("is_current", "valid_from", "valid_to")


def _ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


def standardize(df: DataFrame, spec: EntitySpec, null_safe: bool = False) -> DataFrame:
    """``lower(trim())`` on the entity's text columns, then the change hash."""
    return (df.withColumns(standardized(spec.text_cols))
              .withColumn("hash_key", change_hash(spec.hash_cols, null_safe)))


def dedupe_latest(batch: DataFrame, spec: EntitySpec, order_col: str) -> DataFrame:
    """Optional latest-wins: one row per non-null key, the one with the greatest ``order_col``.

    ``max_by`` aggregates partially, so a key holding many rows never
    gathers in one task. Null-key rows pass through untouched.
    """
    row = F.struct(*[F.col(c) for c in batch.columns])
    keyed = batch.filter(F.col(spec.key).isNotNull())
    latest = (keyed.groupBy(spec.key)
              .agg(F.max_by(row, F.struct(F.col(order_col), F.col("hash_key"))).alias("_r"))
              .select("_r.*"))
    return latest.unionByName(batch.filter(F.col(spec.key).isNull()))


def entity_columns(spec: EntitySpec, df: DataFrame) -> list[str]:
    base = [c for c in df.columns if c not in (spec.sk, "hash_key", "change_type", *VERSION_COLS)]
    return base + ["hash_key"]


def _bounds(df: DataFrame, spec: EntitySpec, prefix: str) -> DataFrame:
    """Least and greatest hash of each key; partial aggregation leaves one row per key and task."""
    return (df.groupBy(spec.key)
            .agg(F.min("hash_key").alias(f"{prefix}_lo"), F.max("hash_key").alias(f"{prefix}_hi")))


def changed_keys(batch: DataFrame, current: DataFrame, spec: EntitySpec) -> DataFrame:
    """Keys with a batch row and a current row of different hash, each once."""
    differ = (F.col("_b_lo") != F.col("_h_lo")) | (F.col("_b_hi") != F.col("_h_hi")) | (F.col("_h_lo") != F.col("_h_hi"))
    return (_bounds(batch, spec, "_b").join(_bounds(current, spec, "_h"), spec.key)
            .filter(differ).select(spec.key))


def classify(batch: DataFrame, current: DataFrame, spec: EntitySpec) -> DataFrame:
    """Batch rows plus ``change_type`` in {new, changed, unchanged}."""
    bounds = _bounds(current, spec, "_h")
    cols = batch.columns
    h = F.col("hash_key")
    change = (F.when(F.col("_h_lo").isNull(), F.lit("new"))
              .when((F.col("_h_lo") != h) | (F.col("_h_hi") != h), F.lit("changed"))
              .otherwise(F.lit("unchanged")))
    return (batch.join(bounds, spec.key, "left")
            .select(*cols, change.alias("change_type")))


def profile(classified: DataFrame, current: DataFrame, spec: EntitySpec) -> DataFrame:
    """Row and distinct-key counts per change type, plus the current rows."""
    by_type = (classified.groupBy("change_type")
               .agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(spec.key).alias("n_keys")))
    cur = current.agg(F.lit("current").alias("change_type"),
                      F.count(F.lit(1)).alias("n_rows"), F.countDistinct(spec.key).alias("n_keys"))
    return by_type.unionByName(cur)


def initial(batch: DataFrame, spec: EntitySpec, as_of: str) -> DataFrame:
    """First load: every row current, surrogate keys 1..n by key."""
    cols = entity_columns(spec, batch)
    rows = batch.select(*cols).withColumns({
        "is_current": F.lit(True),
        "valid_from": _ts(as_of),
        "valid_to": _ts(FAR_FUTURE),
    })
    keyed = assign_dense_key(rows, [spec.key, "hash_key"], spec.sk, start=0)
    return keyed.select(*cols, spec.sk, *VERSION_COLS)


@dataclass
class MergeResult:
    classified: DataFrame   # batch rows with change_type
    rows: DataFrame         # every row the run writes: prior current rows (some closed) + inserted versions

    @property
    def closed(self) -> DataFrame:
        return self.rows.filter(F.col("is_current") == False)  # noqa: E712

    @property
    def current(self) -> DataFrame:
        return self.rows.filter(F.col("is_current") == True)  # noqa: E712


def changes(current: DataFrame, batch: DataFrame, spec: EntitySpec, as_of: str,
            max_sk: int) -> MergeResult:
    """The rows a batch produces from the current rows: closed, kept and inserted versions.

    Expiry is a projection over one left join of the current rows to the
    changed keys, so closed and kept rows come out of one pass.
    """
    batch = staged(batch, "scd2-batch")
    classified = classify(batch, current, spec)
    cols = entity_columns(spec, batch)
    to_close = changed_keys(batch, current, spec).withColumn("_expire", F.lit(True))
    expire = F.coalesce(F.col("_expire"), F.lit(False))
    prior = (current.join(to_close, spec.key, "left")
             .withColumn("is_current", F.when(expire, F.lit(False)).otherwise(F.col("is_current")))
             .withColumn("valid_to", F.when(expire, _ts(as_of)).otherwise(F.col("valid_to")))
             .select(*cols, spec.sk, *VERSION_COLS))
    inserts = (classified.filter(F.col("change_type") != "unchanged")
               .withColumns({
                   "_is_new": (F.col("change_type") == "new").cast("int"),
                   "is_current": F.lit(True),
                   "valid_from": _ts(as_of),
                   "valid_to": _ts(FAR_FUTURE),
               }))
    ranges, some = sized_sample(batch.select(spec.key, "hash_key"))
    either = some.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("_is_new"), spec.key, "hash_key")
    keyed = assign_dense_key(inserts, ["_is_new", spec.key, "hash_key"], spec.sk, start=max_sk, num_partitions=ranges, sample=either)
    inserted = keyed.select(*cols, spec.sk, *VERSION_COLS)
    return MergeResult(classified=classified, rows=prior.unionByName(inserted))


def max_key(existing: DataFrame, spec: EntitySpec) -> int:
    """Largest surrogate key so far (one scalar to the driver), 0 when empty."""
    return existing.agg(F.max(spec.sk)).first()[0] or 0


def merge(existing: DataFrame, batch: DataFrame, spec: EntitySpec, as_of: str,
          max_sk: int | None = None) -> DataFrame:
    """Full history after one batch: history ∪ closed ∪ kept current ∪ inserted versions.

    Rows whose ``is_current`` is null are neither history nor current and drop out.
    """
    if max_sk is None:
        max_sk = max_key(existing, spec)
    current = existing.filter(F.col("is_current") == True)  # noqa: E712
    history = existing.filter(F.col("is_current") == False)  # noqa: E712
    result = changes(current, batch, spec, as_of, max_sk)
    cols = entity_columns(spec, batch)
    return history.select(*cols, spec.sk, *VERSION_COLS).unionByName(result.rows)
