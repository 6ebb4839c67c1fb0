"""Type-2 history over several dated batches at once, and for a batch that arrives late.

`backfill` gives the history that merging the batches one after another would give, in one pass. The state of a key
before a batch is the hash it had in the latest earlier batch that holds it, or else among the current rows;
a batch row is a version where the hash differs from that (a lag over the key's batches). A version ends where
the key's next one begins. Surrogate keys follow (batch, changed before new, key, hash), as single merges
number them.

`back_dated` puts a batch between runs that are already committed. Versions of its keys that began later
are taken back, the version that was valid at its time is opened again, and the batch and the later ones,
cut to its keys, are folded on top. Versions that come out as they were keep their surrogate keys.

A key that a batch holds several times counts once, with its greatest hash (partial aggregation: a key with
most rows costs one row a task). Rows without a key are new in every batch, as in a single merge.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from ..sources.schemas import FAR_FUTURE, EntitySpec
from .keys import assign_dense_key
from .scd2 import VERSION_COLS, entity_columns, max_key

Drops = Sequence[tuple[DataFrame, str]]


def _ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


def _stacked(drops: Drops, spec: EntitySpec) -> DataFrame:
    """All batches' rows with their number (from 1) and time, one row a key and batch; parsed and hashed once."""
    cols = entity_columns(spec, drops[0][0])
    rows = reduce(DataFrame.unionByName, [
        batch.select(*cols, F.lit(i).alias("_drop"), _ts(as_of).alias("_at")) for i, (batch, as_of) in enumerate(drops, 1)])
    rows = staged(rows, "scd2-drops")
    keyed = rows.where(F.col(spec.key).isNotNull())
    once = keyed.groupBy(spec.key, "_drop").agg(F.max_by(F.struct(*rows.columns), "hash_key").alias("r")).select("r.*")
    return once.unionByName(rows.where(F.col(spec.key).isNull()))


def versions(current: DataFrame, drops: Drops, spec: EntitySpec) -> DataFrame:
    """The versions that the batches begin, with ``_drop``, ``_is_new`` and VERSION_COLS; ``_first``: ends the current rows."""
    rows = _stacked(drops, spec)
    cols = entity_columns(spec, drops[0][0])
    held = current.where(F.col(spec.key).isNotNull()).groupBy(spec.key).agg(
        # rows of one key that differ among themselves are equal to no batch row
        F.when(F.min("hash_key") == F.max("hash_key"), F.min("hash_key")).otherwise("").alias("_held"))
    by_key = Window.partitionBy(spec.key).orderBy("_drop")
    keyed = rows.where(F.col(spec.key).isNotNull()).join(held, spec.key, "left")
    before = F.coalesce(F.lag("hash_key").over(by_key), F.col("_held"))
    begun = keyed.withColumn("_before", before).where("_before IS NULL OR _before <> hash_key")
    after = F.lead("_at").over(by_key)
    first = F.row_number().over(by_key) == 1
    chained = begun.select(*cols, "_drop", "_at", F.col("_before").isNull().cast("int").alias("_is_new"),
                           after.alias("_end"), (first & F.col("_held").isNotNull()).alias("_first"))
    alone = rows.where(F.col(spec.key).isNull()).select(
        *cols, "_drop", "_at", F.lit(1).alias("_is_new"), F.lit(None).cast("timestamp_ntz").alias("_end"), F.lit(False).alias("_first"))
    return chained.unionByName(alone).withColumns({
        "is_current": F.col("_end").isNull(), "valid_from": F.col("_at"), "valid_to": F.coalesce("_end", _ts(FAR_FUTURE))}).drop("_end")


def _closed(current: DataFrame, begun: DataFrame, spec: EntitySpec) -> DataFrame:
    """The current rows, ended where their key's first version of the batches begins."""
    ends = begun.where("_first").select(spec.key, F.col("_at").alias("_end"))
    ended = F.col("_end").isNotNull()
    return current.join(ends, spec.key, "left").withColumns({
        "is_current": F.when(ended, F.lit(False)).otherwise(F.col("is_current")),
        "valid_to": F.coalesce("_end", "valid_to")}).drop("_end")


def _numbered(begun: DataFrame, spec: EntitySpec, start: int) -> DataFrame:
    order = ["_drop", "_is_new", spec.key, "hash_key"]
    return assign_dense_key(begun, order, spec.sk, start=start)


def backfill(existing: DataFrame, drops: Drops, spec: EntitySpec, max_sk: int | None = None) -> DataFrame:
    """Full history after merging the (batch, as_of) pairs of ``drops``, in order of time, into ``existing``."""
    if not drops:
        return existing
    if max_sk is None:
        max_sk = max_key(existing, spec)
    out = [*entity_columns(spec, drops[0][0]), spec.sk, *VERSION_COLS]
    current, history = existing.where("is_current"), existing.where("NOT is_current")
    begun = staged(versions(current, drops, spec), "scd2-versions")
    parts = [history, _closed(current, begun, spec), _numbered(begun, spec, max_sk)]
    return reduce(DataFrame.unionByName, [p.select(*out) for p in parts])


def back_dated(existing: DataFrame, batch: DataFrame, as_of: str, later: Drops, spec: EntitySpec) -> DataFrame:
    """Full history with ``batch`` merged as of a time before those of the ``later`` batches, which ``existing`` holds
    already. Apart from surrogate keys it is the history of loading all in order."""
    cols = entity_columns(spec, batch)
    out = [*cols, spec.sk, *VERSION_COLS]
    at = _ts(as_of)
    batch = staged(batch.select(*cols), "scd2-late")
    touched = staged(batch.where(F.col(spec.key).isNotNull()).select(spec.key).distinct(), "scd2-late-keys")
    mine = existing.join(touched, spec.key, "left_semi")
    others = existing.join(touched, spec.key, "left_anti")       # and rows without a key
    past = mine.where(F.col("valid_from") <= at)
    ended = past.where(F.col("valid_to") <= at)
    reopened = past.where(F.col("valid_to") > at).withColumns({"is_current": F.lit(True), "valid_to": _ts(FAR_FUTURE)})
    drops = [(batch, as_of), *[(b.select(*cols).join(touched, spec.key, "left_semi"), t) for b, t in later]]
    begun = staged(versions(reopened, drops, spec), "scd2-versions")
    known = mine.where(F.col("valid_from") > at).select(spec.key, "valid_from", "hash_key", F.col(spec.sk).alias("_sk")) \
        .groupBy(spec.key, "valid_from", "hash_key").agg(F.min("_sk").alias("_sk"))
    kept = staged(begun.join(known, [spec.key, "valid_from", "hash_key"], "left"), "scd2-versions")
    fresh = _numbered(kept.where("_sk IS NULL").drop("_sk"), spec, max_key(existing, spec))
    same = kept.where("_sk IS NOT NULL").withColumn(spec.sk, F.col("_sk"))
    parts = [others, ended, _closed(reopened, begun, spec), same, fresh]
    return reduce(DataFrame.unionByName, [p.select(*out) for p in parts])
