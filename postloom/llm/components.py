"""Connected components of links, by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.storage import stored


def components(links: DataFrame) -> DataFrame:
    """id and component (smallest id reachable) of every id in ``links`` (a, b).

    Each round points neighbours at the smallest one near them: first the larger
    neighbours of every node, then the smaller ones. The number of rounds grows
    with the logarithm of the longest path. Smallest neighbours are found by
    aggregates and stored, so that a node with very many links only makes a
    skewed join, which adaptive execution splits. Links of a node with itself and
    with null are left out; no links give no rows.
    """
    pairs = stored(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        state = pairs.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest"),
        ).first()
        if state == before:
            return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                pairs.select("v", "v").distinct()
            )
        before = state
        both = pairs.union(pairs.select("v", "u"))
        lowest = stored(
            both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("low")),
            "links-low",
        )
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(lowest, "u")
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .distinct()
        )
        # A larger node keeps its smallest neighbour, and its others get it too.
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u")
        ends = F.array(F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))
        pairs = stored(
            small.select(F.explode(ends).alias("e"))
            .select("e.u", "e.v")
            .where(F.col("u") != F.col("v"))
            .distinct(),
            "links",
        )
