"""Connected components of a link table by alternating stars, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wharf.llm.common import scratch, stored
from wharf.plans.joins import lookup


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (a, b) with a > b; node groups are folded by a partial minimum."""
    if large:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # Settled, so that the join deals rows anew and can split the rows of a frequent root.
    least = stored(least, "stars")
    joined = lookup(around, least, ["u"])
    if large:
        pairs = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        pairs = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return pairs.where(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the least node reachable.

    Stars alternate until nothing changes; rounds grow with the logarithm of the longest
    path. Each round is written to the shared folder, so a lost executor costs one round.
    """
    edges = links.select(
        F.greatest("a", "b").cast("bigint").alias("a"), F.least("a", "b").cast("bigint").alias("b")
    ).where(F.col("a") != F.col("b"))
    spark = links.sparkSession
    edges = stored(edges.distinct(), "links")

    def mark(df: DataFrame) -> tuple:
        folded = F.xxhash64("a", "b").cast("decimal(38,0)")
        return tuple(df.agg(F.count("*"), F.sum(folded)).first())

    now = mark(edges)
    while now[0]:
        with scratch(spark) as keep:
            edges = keep(_star(_star(edges, True), False), "links")
        last, now = now, mark(edges)
        if now == last:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
