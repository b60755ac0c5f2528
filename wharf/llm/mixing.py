"""Mixing sources to target weights by exponential keys (Efraimidis and Spirakis).

Every source gets a target of words. Whole epochs of a source come first; what is left of its
target is filled by weighted sampling without replacement: a document's key is an
exponential variate divided by its quality weight, documents are taken in the order of their
keys, and a prefix sum of their sizes stops at the budget. The document at the edge is taken
whole when more than half of it fits, so a source misses its target by half a document at most.

Only DataFrame functions are used. A source is never one window: keys are cut into buckets
at quantiles of its own keys, and the bucket totals are carried forward.

Defined cases: a null text has size 0; a null source is a source of its own, the last one; a
source without words has target 0; repeated rows count each, and rows that agree in every
column are interchangeable; an empty table stays empty. Columns named like an output are
replaced. Reruns agree: keys depend on the seed and on the row's own id and size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wharf.llm.common import BLOCK_ROWS, exclusive_prefix, n_words, stored
from wharf.plans.joins import lookup

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Quantiles that a source's keys are cut at; each stretch is cut further as its rows ask for.
CUTS = 64


def quality_weight(text: Column, size: Column) -> Column:
    """A document's weight in (0, 1]: less for texts full of symbols."""
    symbols = F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("double")
    return F.lit(1.0) / (F.lit(1.0) + symbols / F.greatest(size, F.lit(1)).cast("double"))


def sampling_key(row_id: Column, size: Column, weight: Column, seed: int) -> Column:
    """Exponential variate over weight, from a digest of seed, id and size."""
    label = F.concat_ws(":", F.lit(str(seed)), F.coalesce(row_id.cast("string"), F.lit("")), size)
    digits = F.conv(F.substring(F.md5(label.cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.ln((digits + F.lit(0.5)) * F.lit(2.0**-52)) / weight


def targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """(source_key, source_size, target) from (source_key, source, source_size).

    The level rises until the targets, each ``weight * level`` but at most ``most`` times its
    source's size, add up to ``share`` of all sizes. Sources reach their limit in the order of
    size by weight, so the level is the largest of the levels found along that order. The
    table of sources is the mix's configuration: one small row per source, in one window.
    """
    listed = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(listed) - 1) % len(weights)
    ranked = sources.withColumn("__turn", turn).withColumn(
        "__weight", F.get(F.array(*[F.lit(w) for w in weights]), F.col("__turn")).cast("double")
    )
    limit = most * F.col("source_size").cast("double")
    by_limit = Window.orderBy(limit / F.col("__weight"), "source_key")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(
        F.sum(limit).over(before), F.lit(0.0)
    )
    weight_left = F.sum("__weight").over(everything) - F.coalesce(
        F.sum("__weight").over(before), F.lit(0.0)
    )
    level = ranked.withColumn("__level", left / weight_left)
    top = F.max("__level").over(everything)
    return level.select(
        "source_key", "source_size", F.least(limit, top * F.col("__weight")).alias("target")
    )


def mix(
    df: DataFrame,
    row_id: str = "doc_id",
    source: str = "source",
    size: str = "size",
    weight: str = "weight",
    seed: int = 0,
) -> DataFrame:
    """``df`` with source_size, target, ``copies`` (how often the row is taken) and taken."""
    made = ["source_size", "target", "copies", "taken"]
    kept = [c for c in df.columns if c not in made]
    # Boxed, so that columns of the rows meet none of the names used here.
    keyed = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("__row"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("")).alias("source_key"),
        F.col(f"`{source}`").alias("source"),
        F.col(f"`{row_id}`").alias("id"),
        F.col(f"`{size}`").cast("bigint").alias("__size"),
        sampling_key(F.col(f"`{row_id}`"), F.col(f"`{size}`"), F.col(f"`{weight}`"), seed).alias("__key"),
    )
    totals = keyed.groupBy("source_key").agg(
        F.first("source").alias("source"),
        F.sum("__size").cast("bigint").alias("source_size"),
        F.count("*").alias("__n"),
        F.percentile_approx("__key", [n / CUTS for n in range(1, CUTS)], 1000).alias("__cuts"),
        F.max("__key").alias("__last"),
    )
    totals = stored(totals, "mix-sources")
    largest = totals.agg(F.coalesce(F.max("__n"), F.lit(0))).first()[0]
    parts = max(1, -(-largest // (CUTS * BLOCK_ROWS)))
    goals = stored(targets(totals.select("source_key", "source", "source_size")), "mix-targets")
    placed = lookup(keyed, totals.select("source_key", "__cuts", "__last"), ["source_key"])
    # The bucket grows with the key: the stretch between two quantiles, and the part of it.
    stretch = F.size(F.filter("__cuts", lambda cut: cut <= F.col("__key")))
    low = F.when(F.col("__s") > 0, F.get("__cuts", F.col("__s") - 1)).otherwise(F.lit(0.0))
    high = F.when(F.col("__s") < CUTS - 1, F.get("__cuts", F.col("__s"))).otherwise(F.col("__last"))
    part = F.floor((F.col("__key") - low) / F.nullif(high - low, F.lit(0.0)) * parts)
    within = F.least(F.greatest(F.coalesce(part, F.lit(0)), F.lit(0)), F.lit(parts - 1))
    bucketed = placed.withColumn("__s", stretch).withColumn(
        "__bucket", (F.col("__s") * parts + within).cast("int")
    )
    summed = exclusive_prefix(
        bucketed.drop("__cuts", "__last", "__s", "source"),
        ["source_key"],
        "__bucket",
        [F.col("__key"), F.col("id"), F.col("__size")],
        "__size",
        "__before",
    )
    joined = lookup(summed, goals, ["source_key"])
    epochs = F.when(
        F.col("source_size") > 0,
        F.least(F.lit(MOST), F.floor(F.col("target") / F.col("source_size")).cast("int")),
    ).otherwise(F.lit(0))
    part = F.col("target") - F.col("__epochs") * F.col("source_size")
    extra = 2 * F.col("__before") + F.col("__size") < 2 * part
    copies = F.col("__epochs") + F.when(extra, 1).otherwise(0)
    return (
        joined.withColumn("__epochs", epochs)
        .withColumn("copies", copies)
        .select(
            *[F.col("__row").getField(c).alias(c) for c in kept],
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("__size")).cast("bigint").alias("taken"),
        )
    )


def sized(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the columns ``size`` (words) and ``weight`` of its texts."""
    base = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in ("size", "weight")])
    counted = base.withColumn("size", n_words(F.col(f"`{text}`")))
    return counted.withColumn("weight", quality_weight(F.col(f"`{text}`"), F.col("size")))
