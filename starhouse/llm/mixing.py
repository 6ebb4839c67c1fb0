"""Mixing sources to target weights (native): Pfair scheduling of source blocks.

Documents of a source are dealt into blocks of about ``block_chars`` characters by a hash of the row.
A source with weight w gives its i-th block (from 1) the release time floor((i-1)/w) and the deadline
ceil(i/w), in slots of one block. Earliest deadline first among released blocks then places one block in
each slot. Weights are used as given, not rounded. Every block is placed exactly once: when a source runs out, the others
go on in their own proportions. The stretch between two such events is a phase. A phase is cut into segments of
about ``resolution`` slots (more if the least weight needs more for one block), and what is left. How many blocks of
a source a segment has follows from its unrounded weight and the segment's number alone, so segments are independent: each is
a Pfair problem of its own counts, solved in one row of a DataFrame by a fold over its slots, all in parallel.

Deviation: at the end of each segment a source has its weight's share of the slots of its phase to within less than a block,
whatever the length of the phase; in between to less than two, as the segment's schedule is within less than a block
of the segment's counts. In the last piece of a phase, of at most some segments, what sources have left of a block at the phase's
end (less than one block each, placed in the next phase) comes on top. All documents only join with the result.

Sources and weights are the small side (a source is a corpus, not a document): the phase tables have
sources x sources rows, and one row a segment. Sizes by source are written before documents join them, so that Spark knows their
size and needn't deal documents by source; blocks are numbered by stretches of ``STRETCH`` buckets. Nothing of
a hot source meets in one task.

Defined cases: a null source is a source of its own; null text has no characters (a document counts as
one character more than its text); documents of equal id and text stay separate rows of one block;
sources without a given weight get the smallest one; weights of absent sources don't matter; an empty
table gives no rows; a weight that isn't positive counts as not given; other columns pass through unless
a result column has their name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.llm.common import row_key, written

RESOLUTION = 400
BLOCK_CHARS = 64_000
#: Buckets of a source whose blocks are numbered in one group of rows.
STRETCH = 16_384
#: Default target: the source's share of characters to this power (temperature), so that small sources gain.
TEMPERATURE = 0.5


def _source() -> Column:
    return F.coalesce(F.col("source"), F.lit("\x00null"))


def dealt(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, DataFrame]:
    """``docs`` with __source and __bucket, and blocks ``(source, bucket, i, n_docs, chars)``; i from 1."""
    chars = F.length(F.coalesce("text", F.lit(""))).cast("long") + 1
    sizes = written(docs.groupBy(_source().alias("__source")).agg(F.sum(chars).alias("__chars")), "mix-sizes")
    n = F.ceil(F.col("__chars") / F.lit(block_chars))
    d = docs.withColumn("__source", _source()).join(sizes, "__source") \
        .withColumn("__bucket", F.pmod(row_key("doc_id", "text"), n)).drop("__chars")
    blocks = d.groupBy(F.col("__source").alias("source"), F.col("__bucket").alias("bucket")) \
        .agg(F.count("*").alias("n_docs"), F.sum(chars).alias("chars"))
    return d, _numbered(written(blocks, "mix-buckets"))


def _numbered(blocks: DataFrame) -> DataFrame:
    """``blocks`` with i, 1.. without gaps in order of the bucket: the place within a stretch of buckets, after the
    blocks of all earlier stretches of the source."""
    rows = blocks.withColumn("__stretch", F.floor(F.col("bucket") / F.lit(STRETCH)))
    earlier = Window.partitionBy("source").orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("source", "__stretch").agg(F.count("*").alias("__n")) \
        .select("source", "__stretch", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    within = Window.partitionBy("source", "__stretch").orderBy("bucket")
    return rows.withColumn("__at", F.row_number().over(within)).join(before, ["source", "__stretch"]) \
        .withColumn("i", F.col("__before") + F.col("__at")).drop("__stretch", "__before", "__at")


def source_weights(blocks: DataFrame, weights: dict[str, float] | None = None,
                   resolution: int = RESOLUTION) -> DataFrame:
    """``(source, blocks, w)``: w is the source's target in blocks of a segment, not rounded. A segment has ``resolution`` slots,
    or as many more as give the least target one block."""
    s = blocks.groupBy("source").agg(F.count("*").alias("blocks"), F.sum("chars").alias("chars"))
    if weights is None:
        s = s.withColumn("share", F.pow("chars", F.lit(TEMPERATURE)))
    else:
        given = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, float(v))])
        s = s.withColumn("share", given[F.col("source")])
    every = Window.partitionBy(F.lit(0))                        # one row a source
    s = s.withColumn("share", F.when(F.col("share") > 0, F.col("share")))
    s = s.withColumn("share", F.coalesce("share", F.min("share").over(every), F.lit(1.0)))
    total, least = F.sum("share").over(every), F.min("share").over(every)
    return s.select("source", "blocks", (F.col("share") * F.greatest(F.lit(float(resolution)) / total, 1 / least)).alias("w"))


def phases(sources: DataFrame) -> DataFrame:
    """``(phase, source, w, first, a)``: a phase ends when a source runs out; ``a`` blocks after the first
    ``first`` ones of the source fall into it. The time, in periods, of a source's end is blocks / w."""
    sources = sources.withColumn("end", F.col("blocks") / F.col("w"))
    order = Window.orderBy("until")                             # one row a source at most
    ends = sources.select(F.col("end").alias("until")).distinct().select(
        "until", F.row_number().over(order).alias("phase"), F.coalesce(F.lag("until").over(order), F.lit(0.0)).alias("since"))
    upto = lambda t: F.when(F.col("end") <= t, F.col("blocks")).otherwise(F.floor(F.col("w") * t + 1e-9))
    last = sources.join(ends.select(F.col("until").alias("end"), F.col("phase").alias("last")), "end")
    live = last.withColumn("phase", F.explode(F.sequence(F.lit(1), F.col("last")))).join(ends, "phase")
    return live.select("phase", "source", "w", upto(F.col("since")).alias("first"), (upto(F.col("until")) - upto(F.col("since"))).alias("a"))


def instances(ph: DataFrame) -> DataFrame:
    """Pfair problems ``(phase, kind, begin, slots, jobs)``: one for each segment of a phase, kind 0.., the last is what is left.
    Jobs are (source, n, from): n blocks after the first ``from`` ones of the source in the phase. After k segments
    a source has floor(k C) - floor(k C') blocks, C and C' the sums of w up to and before the source, w scaled to a whole number
    of slots in all: less than one from k w, and never fewer than before as w is at least 1."""
    per = Window.partitionBy("phase")
    order = per.orderBy("source")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = ph.withColumn("slots", F.ceil(F.sum(F.col("w").cast("double")).over(per) - 1e-9)).withColumn("w", F.col("w") * (F.col("slots") / F.sum(F.col("w").cast("double")).over(per)))
    p = p.withColumn("times", F.min(F.floor(F.col("a") / F.col("w"))).over(per)) \
        .withColumn("c", F.when(F.lead("source").over(order).isNull(), F.col("slots").cast("double")).otherwise(F.sum("w").over(upto))) \
        .withColumn("before", F.coalesce(F.lag("c").over(order), F.lit(0.0))).drop("slots")
    done = lambda k: F.floor(k * F.col("c")) - F.floor(k * F.col("before"))
    k = p.withColumn("kind", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times")))).withColumn("from", done(F.col("kind"))) \
        .withColumn("n", F.when(F.col("kind") < F.col("times"), done(F.col("kind") + 1)).otherwise(F.col("a")) - F.col("from"))
    some = F.when(F.col("n") > 0, F.struct("source", "n", (F.col("first") + F.col("from")).alias("from")))
    problems = k.groupBy("phase", "kind").agg(F.sum("from").alias("since"), F.sum("n").alias("slots"), F.sort_array(F.collect_list(some)).alias("jobs"))
    lengths = ph.groupBy("phase").agg(F.sum("a").alias("length"))
    earlier = Window.orderBy("phase").rowsBetween(Window.unboundedPreceding, -1)   # one row a phase
    begins = lengths.select("phase", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("earlier"))
    return problems.where("slots > 0").join(begins, "phase").select(
        "phase", "kind", (F.col("earlier") + F.col("since")).alias("begin"), "slots", "jobs")


def schedule(problems: DataFrame) -> DataFrame:
    """``(phase, slot, source, i)``: earliest deadline first over the slots of each problem; i from 1 over all phases."""
    total = F.col("slots")

    def step(state, t):
        """Place one block: of the sources whose next block is released, the one with the nearest deadline."""
        ready = F.filter(F.transform("jobs", lambda job, s: F.struct(
            F.ceil((F.get(state.done, s) + 1) * total / job.n).alias("deadline"), s.alias("s"),
            ((F.get(state.done, s) < job.n) & (F.floor(F.get(state.done, s) * total / job.n) <= t)).alias("ready"))), lambda x: x.ready)
        s = F.array_min(ready).s
        done = F.transform(state.done, lambda d, i: d + F.when(i == s, 1).otherwise(0).cast("long"))
        return F.struct(done.alias("done"), F.concat(state.placed, F.array(s)).alias("placed"))

    zero = F.struct(F.transform("jobs", lambda _: F.lit(0).cast("long")).alias("done"), F.array().cast("array<int>").alias("placed"))
    placed = F.aggregate(F.sequence(F.lit(0).cast("long"), total - 1), zero, step, lambda st: st.placed)
    slots = problems.select("phase", "kind", "begin", "jobs", F.posexplode(placed).alias("slot", "s")) \
        .select("phase", "kind", (F.col("begin") + F.col("slot")).alias("slot"), F.get("jobs", F.col("s")).alias("job"))
    turn = Window.partitionBy("phase", "kind", "job.source").orderBy("slot")
    return slots.select("phase", "slot", "job.source", (F.col("job.from") + F.row_number().over(turn)).cast("long").alias("i"))


def block_slots(blocks: DataFrame, sources: DataFrame) -> DataFrame:
    """``(source, bucket, slot, phase)``: the place of every block, slots 0.. without gaps."""
    ph = written(phases(sources), "mix-phases")
    places = written(schedule(written(instances(ph), "mix-problems")), "mix-schedule")
    return blocks.select("source", "bucket", "i").join(places, ["source", "i"]).select(
        "source", "bucket", F.col("slot").cast("long").alias("slot"), "phase")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_chars: int = BLOCK_CHARS,
        resolution: int = RESOLUTION) -> DataFrame:
    """``docs`` with the slot and the phase of their blocks; ordered by slot they are the mixture."""
    keep = [c for c in docs.columns if c not in ("slot", "phase")]
    d, blocks = dealt(docs.select(*keep), block_chars)
    blocks = written(blocks, "mix-blocks")
    sources = written(source_weights(blocks, weights, resolution), "mix-sources")
    places = written(block_slots(blocks, sources), "mix-slots").withColumnsRenamed({"source": "__source", "bucket": "__bucket"})
    return d.join(places, ["__source", "__bucket"]).select(*keep, "slot", "phase")
