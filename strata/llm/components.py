"""Connected components of a link table, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freeze, join_spread


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``links(u, v)``, undirected, to ``(u, root)``: one row per linked node
    with the smallest node of its component.

    Alternates the large-star and small-star steps: each node's larger
    neighbours, then its smaller ones, are linked to its smallest neighbour,
    until nothing changes.  The number of links never grows, and each round's
    table is written to the shared scratch space.  A hub's links are dealt over as many
    parts as they fill.  Self-links and repeated links are harmless; no links give no rows.
    """
    edges = freeze(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    n_links, before = edges.count(), None
    for _ in range(most_rounds):
        # large star
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = _least(both).withColumn("m", F.least("m", "u"))
        large = join_spread(both.filter("v > u"), m, "u", ["v"], 2 * n_links)
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: every link now points from the larger to the smaller node
        m = _least(large)
        small = join_spread(large, m, "u", ["v"], 2 * n_links)
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = freeze(small.unionByName(m.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = edges.agg(
            F.count(F.lit(1)).alias("links"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")
        ).first()
        if after == before:
            return edges.select("u", F.col("v").alias("root"))
        n_links, before = after["links"], after
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
