"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows are permuted inside their own partition. How many rows each partition sends to each shard
is drawn exactly as a uniform permutation of all rows would give it: by multivariate
hypergeometric splits down a tree over the partitions. Rows take their shard from their local
rank and that matrix, are exchanged once, and are permuted again inside the shard. Shards
differ by at most one row.

Only DataFrame functions are used. The matrix has one row per input partition; neither a
shard nor a partition is ever handled as one group (shards are cut into blocks by their second
random key).

Defined cases: a shard may be empty when there are fewer rows than shards; null columns and
repeated rows do not matter, because a row's place depends on its position and the seed, not on
its values (equal texts are spread like any others); an empty table stays empty; columns of
the input keep their names and must not be called ``shard`` or ``slot``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wharf.functions.once import once
from wharf.llm.common import BLOCK_ROWS, exclusive_prefix, stored, uniform
from wharf.plans.joins import lookup

#: Children of a node in the tree over the partitions.
FAN = 16
_LOCAL_BITS = 33


def _long(c: Column | int) -> Column:
    return (F.lit(c) if isinstance(c, int) else c).cast("bigint")


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Marked items among ``drawn`` out of ``total``, by inversion at ``u`` in [0, 1).

    Weights follow the ratio of neighbouring probabilities; counts beyond ten standard
    deviations (less than 1e-20 of the mass) are left out.
    """
    n, k, m = (c.cast("double") for c in (total, marked, drawn))
    safe = F.greatest(n, F.lit(1.0))
    spread = F.sqrt(m * (k / safe) * ((n - k) / safe) * ((n - m) / F.greatest(n - 1, F.lit(1.0))))
    mode = F.floor((m + 1) * (k + 1) / (n + 2)).cast("bigint")
    reach = F.ceil(10 * spread).cast("bigint") + 10
    low = F.greatest(_long(0), drawn + marked - total, mode - reach)
    high = F.greatest(low, F.least(drawn, marked, mode + reach))

    def ratio(x: Column) -> Column:
        x = x.cast("double")
        return (k - x) * (m - x) / ((x + 1) * (n - k - m + x + 1))

    def steps(bounds: Column) -> Column:
        a, b = bounds["a"], bounds["b"]
        mass = F.aggregate(
            F.sequence(a, b),
            F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s")),
            lambda acc, x: F.struct(
                F.when(x < b, acc["w"] * ratio(x)).otherwise(F.lit(0.0)).alias("w"),
                (acc["s"] + acc["w"]).alias("s"),
            ),
            lambda acc: acc["s"],
        )
        return once(
            mass * u,
            lambda target: F.aggregate(
                F.sequence(a, b),
                F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"), a.alias("x")),
                lambda acc, x: F.struct(
                    F.when(x < b, acc["w"] * ratio(x)).otherwise(F.lit(0.0)).alias("w"),
                    (acc["s"] + acc["w"]).alias("s"),
                    F.when(acc["s"] + acc["w"] <= target, x + _long(1)).otherwise(acc["x"]).alias("x"),
                ),
                lambda acc: F.least(acc["x"], b),
            ),
        )

    return once(F.struct(low.alias("a"), high.alias("b")), steps)


def _shares(left: Column, size: Column, node: Column, seed: int) -> Column:
    """Rows of one child per shard, given what its node has left for each shard."""
    no_counts = F.array().cast("array<bigint>")

    def step(acc: Column, j: Column) -> Column:
        u = uniform(F.lit(seed), node, j)
        mine = F.get(left, j)
        drawn = hypergeometric(acc["total"], mine, acc["size"], u)
        return once(
            drawn,
            lambda x: F.struct(
                (acc["total"] - mine).alias("total"),
                (acc["size"] - x).alias("size"),
                F.concat(acc["out"], F.array(x)).alias("out"),
            ),
        )

    total = F.aggregate(left, _long(0), lambda a, x: a + x)
    start = F.struct(total.alias("total"), size.alias("size"), no_counts.alias("out"))
    return F.aggregate(
        F.sequence(F.lit(0), F.size(left) - 1), start, step, lambda acc: acc["out"]
    )


def communication_matrix(parts: DataFrame, sizes: list[int], seed: int) -> DataFrame:
    """Exact counts per partition and shard.

    ``parts`` has (part, n) with parts from 0; ``sizes`` are the shard sizes and add up to all
    n. Returns (part, counts). The tree is walked level by level, all nodes of a level at once.
    """
    top = parts.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0]
    height = 1
    while FAN**height <= top:
        height += 1
    whole = F.array(*[F.lit(s).cast("bigint") for s in sizes])
    nodes = None
    for level in range(height - 1, -1, -1):
        child = F.floor(F.col("part") / F.lit(FAN**level)).cast("bigint")
        kids = (
            parts.groupBy(child.alias("kid"))
            .agg(F.sum("n").cast("bigint").alias("n"))
            .groupBy(F.floor(F.col("kid") / FAN).cast("bigint").alias("node"))
            .agg(F.sort_array(F.collect_list(F.struct("kid", "n"))).alias("kids"))
        )
        none = F.array().cast("array<struct<node:bigint,counts:array<bigint>>>")

        offset = level << 40

        def give(acc: Column, kid: Column) -> Column:
            label = kid["kid"] + F.lit(offset).cast("bigint")
            return once(
                _shares(acc["left"], kid["n"], label, seed),
                lambda mine: F.struct(
                    F.zip_with(acc["left"], mine, lambda a, b: a - b).alias("left"),
                    F.concat(
                        acc["out"],
                        F.array(F.struct(kid["kid"].alias("node"), mine.alias("counts"))),
                    ).alias("out"),
                ),
            )

        split = F.aggregate(
            "kids",
            F.struct(F.col("counts").alias("left"), none.alias("out")),
            give,
            lambda acc: acc["out"],
        )
        # The top level is one node, which has all rows of every shard.
        known = kids.withColumn("counts", whole) if nodes is None else nodes.join(kids, "node")
        nodes = known.select(F.explode(split).alias("kid")).select("kid.node", "kid.counts")
    return nodes.withColumnRenamed("node", "part")


def shard(df: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot``, gapless from 0 per shard."""
    position = F.monotonically_increasing_id()
    # Boxed, so that columns of the rows meet none of the names used here.
    boxed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    permuted = (
        boxed.withColumn("__key", F.xxhash64(F.lit(seed), position))
        .sortWithinPartitions("__key")
        .drop("__key")
        .withColumn("__at", F.monotonically_increasing_id())
    )
    # Settled, so that a recomputed partition cannot change a row's rank.
    settled = stored(permuted, "shard")
    local = settled.withColumn("part", F.shiftright("__at", _LOCAL_BITS)).withColumn(
        "__rank", F.col("__at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    )
    parts = stored(local.groupBy("part").agg(F.count("*").alias("n")), "shard-parts")
    n = parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sizes = [n * (j + 1) // shards - n * j // shards for j in range(shards)]
    matrix = stored(communication_matrix(parts, sizes, seed), "shard-matrix")
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda j: F.aggregate(F.slice("counts", F.lit(1), j), _long(0), lambda a, x: a + x),
    )
    sent = lookup(local, matrix.select("part", ends.alias("__ends")), ["part"])
    rank = F.col("__rank")
    blocks = max(16, -(-n // (shards * BLOCK_ROWS)))
    again = F.xxhash64(F.lit(seed + 1), F.col("__at"))
    keyed = sent.select(
        "row",
        F.size(F.filter("__ends", lambda end: end <= rank)).alias("shard"),
        "__at",
        again.alias("__again"),
        F.floor(uniform(F.lit(seed + 2), F.col("__at")) * blocks).cast("int").alias("__block"),
        _long(1).alias("__one"),
    )
    placed = exclusive_prefix(
        keyed, ["shard"], "__block", [F.col("__again"), F.col("__at")], "__one", "slot"
    )
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c not in ("shard", "slot")]
    return placed.select(*kept, "shard", "slot")
