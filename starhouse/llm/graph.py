"""Connected components of a link table by label propagation with shortcuts, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import drop_written, written


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``(node, comp)`` for the nodes of ``links`` (a, b), comp the smallest node of the component.

    Large-star and small-star steps in turn: each node's larger neighbours, then its not larger ones, are
    linked to the smallest of its neighbourhood, until nothing changes. The smallest neighbour is a
    pre-aggregated minimum and neighbours are never gathered, so a node with very many links is
    no large group. Each round is written to the shared folder. Null and equal ends are ignored; repeated
    links count once."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        star = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = star.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        large = written(large, name)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")) \
            .select("e.*").where("u <> v").distinct()
        small = written(small, name)
        changed = small.join(edges, ["u", "v"], "left_anti").limit(1).count() or edges.join(small, ["u", "v"], "left_anti").limit(1).count()
        drop_written(edges, large)
        edges = small
        if not changed:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
