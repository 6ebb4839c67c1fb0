"""Durable SCD2 entity store: append-only history, and current rows by key bucket.

Layout under ``root``::

    runs/run=<n>/is_current=false/bucket=<b>/   versions closed by run n (written once, never rewritten)
    runs/run=<n>/is_current=true/bucket=<b>/    the current rows of bucket b after run n, if run n changed any
    _commits/                                   one row per committed run (run, largest key, as_of, buckets written)

A key's bucket is a hash of it. A run reads the buckets of its batch's keys, rewrites those that hold a new or
changed key in a directory of its own, and then commits; the others stay in the run that wrote them last. So
a run costs its touched buckets, not all current rows, and history is never rewritten. The current rows are each
bucket's newest committed directory; the table is those and the closed rows of all committed runs. An
uncommitted run is invisible, and a retried run overwrites its own directory. Only a missing target means first
load; any other read failure propagates.

Batches are merged in order of time. One that is older than the last run needs the batches after it, for which
see `scd2_fold.back_dated`; such a run writes the whole history anew and becomes the ``base`` of later ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scd2, scd2_fold
from ..session import staged
from ..sources.schemas import EntitySpec
from .versioned import PARQUET_OPTIONS, CommitLog

#: Buckets of a new store. A store keeps its number; more buckets make small batches cheaper and files smaller.
BUCKETS = 16


@dataclass
class RunStats:
    run: int
    first_load: bool
    max_key: int
    profile: dict | None = None     # change_type -> (rows, distinct keys), when asked for
    buckets: list | None = None     # current-row buckets that the run wrote


def _time(as_of) -> datetime:
    """A run time as an instant: '2025-03-03' is '2025-03-03 00:00:00'."""
    return datetime.fromisoformat(str(as_of))


class Scd2Store:
    def __init__(self, spark: SparkSession, root: str, spec: EntitySpec, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec
        self.buckets = buckets
        self.log = CommitLog(spark, self.root)

    @property
    def _runs(self) -> str:
        return f"{self.root}/runs"

    def _run_path(self, n: int) -> str:
        return f"{self._runs}/run={n:06d}"

    def bucket(self, key: str):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def last_run(self):
        return self.log.last()

    def _committed(self):
        last = self.last_run()
        if last is None:
            raise FileNotFoundError(f"no committed run under {self.root}")
        return last

    def _columns(self, df: DataFrame) -> list:
        # partition values are discovered as strings: is_current is cast back
        order = [c for c in df.columns if c not in ("run", "bucket", "is_current", "valid_from", "valid_to")]
        return order + [F.col("is_current").cast("boolean").alias("is_current"), "valid_from", "valid_to"]

    def newest(self) -> dict[int, int]:
        """Run that wrote each bucket's current rows last; at most ``buckets`` entries."""
        log = self.log.rows()
        rows = log.select(F.explode("buckets").alias("b"), "version").groupBy("b").agg(F.max("version").alias("n")).collect()
        return {r.b: r.n for r in rows}

    def current(self, buckets: list[int] | None = None) -> DataFrame:
        """The current rows, of some buckets only if given; no other directory is listed or read."""
        self._committed()
        newest = self.newest()
        wanted = sorted(newest if buckets is None else set(buckets) & set(newest))
        paths = [f"{self._run_path(newest[b])}/is_current=true/bucket={b}" for b in wanted]
        none = not paths
        if none:            # a frame of the same columns
            b, n = next(iter(newest.items()))
            paths = [f"{self._run_path(n)}/is_current=true/bucket={b}"]
        rows = self.spark.read.parquet(*paths).withColumn("is_current", F.lit("true"))
        return (rows.limit(0) if none else rows).select(*self._columns(rows))

    def read(self) -> DataFrame:
        """The full history table (closed versions and current rows)."""
        last = self._committed()
        rows = self.spark.read.option("basePath", self._runs).parquet(self._runs)
        closed = rows.where((F.col("is_current") == "false") & F.col("run").between(last["base"] or 1, last["version"]))
        return closed.select(*self._columns(closed)).unionByName(self.current())

    def _write(self, rows: DataFrame, run: int) -> None:
        (rows.withColumn("bucket", self.bucket(self.spec.key)).repartition("is_current", "bucket")
         .write.mode("overwrite").partitionBy("is_current", "bucket").options(**PARQUET_OPTIONS).parquet(self._run_path(run)))

    def _commit(self, run: int, as_of: str, prev_max: int, base: int | None, buckets: list[int]) -> int:
        top = self.spark.read.parquet(self._run_path(run)).agg(F.max(self.spec.sk)).first()[0] if buckets else None
        max_key = max(top or 0, prev_max)
        self.log.append(run, max_key=max_key, as_of=str(as_of), base=base, buckets=buckets)
        return max_key

    def _buckets_of(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(self.bucket(self.spec.key)).distinct().collect())

    def apply(self, batch: DataFrame, as_of: str, profile: bool = False, later: scd2_fold.Drops | None = None) -> RunStats:
        """Merge one standardised batch (with ``hash_key``) and commit it.

        ``profile=True`` also returns row and distinct-key counts per change
        type and for the prior current rows (one small aggregate job).
        ``later``: for a batch older than the last run, the (batch, as_of) pairs merged after its time.
        """
        last = self.last_run()
        if last is None:
            return self._first(batch, as_of, profile)
        if last["as_of"] is not None and _time(as_of) < _time(last["as_of"]):      # equal: a re-run
            if later is None:
                raise ValueError(f"as_of {as_of} is before the last committed run's ({last['as_of']}): give the later batches")
            return self._rewrite(batch, as_of, later, last)
        batch = staged(batch, "scd2-run")
        held = self.current(self._buckets_of(batch))
        stats = None
        if profile:
            classified = scd2.classify(batch, held, self.spec)
            stats = {r.change_type: (r.n_rows, r.n_keys)
                     for r in scd2.profile(classified, self.current(), self.spec).collect()}
        key = self.spec.key
        moved = scd2.classify(batch.select(key, "hash_key"), held, self.spec).where("change_type <> 'unchanged'")
        touched = self._buckets_of(moved)
        run = last["version"] + 1
        if touched:
            mine = batch.where(self.bucket(key).isin(touched))
            self._write(scd2.changes(self.current(touched), mine, self.spec, as_of, last["max_key"] or 0).rows, run)
        max_key = self._commit(run, as_of, last["max_key"] or 0, last["base"], touched)
        return RunStats(run=run, first_load=False, max_key=max_key, profile=stats, buckets=touched)

    def _first(self, batch: DataFrame, as_of: str, profile: bool) -> RunStats:
        if batch.limit(1).count() == 0:
            raise ValueError(f"empty first batch for {self.spec.name}: nothing to load")
        stats = None
        if profile:
            agg = batch.agg(F.count(F.lit(1)), F.countDistinct(self.spec.key)).first()
            stats = {"new": (agg[0], agg[1])}
        batch = staged(batch, "scd2-run")
        buckets = self._buckets_of(batch)
        self._write(scd2.initial(batch, self.spec, as_of), 1)
        return RunStats(run=1, first_load=True, max_key=self._commit(1, as_of, 0, None, buckets), profile=stats, buckets=buckets)

    def apply_all(self, drops: scd2_fold.Drops) -> RunStats:
        """Merge several (batch, as_of) pairs, in order of time, in one run."""
        last = self._committed()
        times = [_time(t) for t in (last["as_of"], *[t for _, t in drops]) if t is not None]
        if times != sorted(times):
            raise ValueError("as_of of the batches must follow the last run's and each other")
        drops = [(staged(b, "scd2-run"), t) for b, t in drops]
        buckets = sorted({b for rows, _ in drops for b in self._buckets_of(rows)})
        run, prev = last["version"] + 1, last["max_key"] or 0
        self._write(scd2_fold.backfill(self.current(buckets), drops, self.spec, max_sk=prev), run)
        max_key = self._commit(run, drops[-1][1], prev, last["base"], buckets)
        return RunStats(run=run, first_load=False, max_key=max_key, buckets=buckets)

    def _rewrite(self, batch: DataFrame, as_of: str, later: scd2_fold.Drops, last) -> RunStats:
        run, prev = last["version"] + 1, last["max_key"] or 0
        rows = staged(scd2_fold.back_dated(self.read(), batch, as_of, later, self.spec), "scd2-run")
        buckets = self._buckets_of(rows.where("is_current"))
        self._write(rows, run)
        max_key = self._commit(run, last["as_of"], prev, run, buckets)
        return RunStats(run=run, first_load=False, max_key=max_key, buckets=buckets)
