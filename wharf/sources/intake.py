"""How much is taken per pull: caps, fair shares, and the shard read budget."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from wharf.plans.joins import lookup
from wharf.plans.running import SPAN, Running, block_of, running
from wharf.session import settle

# Fetch and pull limits.
MAX_RECORDS_PER_FETCH = 10_000
DEFAULT_MESSAGES_PER_PULL = 100
MIN_FETCH_INTERVAL_NANOS = 200_000_000
READ_BYTES_PER_SECOND = 2 * 1024 * 1024

HOUR_NANOS = 3_600_000_000_000


def _first(df: DataFrame, keys: list[str], position: str, count: int, span: int) -> DataFrame:
    """The first ``count`` rows of each key in ``position`` order, with their ``__rank``.

    Keys are cut into blocks of positions. The row counts of the blocks tell where each key's
    cut lies, so only the blocks before it are ranked, each on its own.
    """
    blocked = df.withColumn("__block", block_of(F.col(position), span))
    sizes = blocked.groupBy(*keys, "__block").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    needed = settle(
        sizes.select(*keys, "__block", before.alias("__before")).where(F.col("__before") < count)
    )
    rows = lookup(blocked, needed, [*keys, "__block"], null_safe=True)
    in_block = F.row_number().over(Window.partitionBy(*keys, "__block").orderBy(position))
    # The plain limit on the rank lets every map task cut its own rows before the shuffle.
    ranked = rows.withColumn("__at", in_block).where(F.col("__at") <= count)
    return (
        ranked.withColumn("__rank", F.col("__before") + F.col("__at"))
        .where(F.col("__rank") <= count)
        .drop("__block", "__before", "__at")
    )


def capped(
    df: DataFrame, keys: list[str], position: str, cap: int, span: int = SPAN
) -> DataFrame:
    """The first ``cap`` rows of each partition: one pull of each. ``position`` is a BIGINT."""
    if not 0 < cap <= MAX_RECORDS_PER_FETCH:
        raise ValueError(f"a pull takes 1 to {MAX_RECORDS_PER_FETCH} records, got {cap}")
    return _first(df, keys, position, cap, span).drop("__rank")


def fair_share(
    df: DataFrame,
    topics: list[str],
    budget: int,
    pull_no: int,
    position: str = "pos_num",
    span: int = SPAN,
) -> DataFrame:
    """One pull over several topics, in visiting order (column ``visit_no``, from 1).

    Each of n topics yields at most max(1, budget / n) rows and all together at most
    ``budget``. Visiting starts at topic ``pull_no mod n``; an unused share stays unused.
    """
    if budget <= 0 or not topics:
        raise ValueError(f"a pull needs topics and a budget over 0, got {topics} and {budget}")
    topics = list(dict.fromkeys(topics))
    share = max(1, budget // len(topics))
    first = pull_no % len(topics)
    order = topics[first:] + topics[:first]
    taken = settle(_first(df.where(F.col("topic").isin(order)), ["topic"], position, share, span))
    # One count per topic of the list: rows of earlier turns come before a topic's own.
    counts = {r["topic"]: r["n"] for r in taken.groupBy("topic").agg(F.count("*").alias("n")).collect()}
    starts = [0, *accumulate(counts.get(t, 0) for t in order)]
    turn = F.array_position(F.array(*[F.lit(t) for t in order]), F.col("topic"))
    start = F.element_at(F.array(*[F.lit(s) for s in starts]), turn.cast("int"))
    visit = (start + F.col("__rank")).cast("int")
    return taken.withColumn("visit_no", visit).where(F.col("visit_no") <= budget).drop("__rank")


def read_nanos(size: Column) -> Column:
    """Nanoseconds a shard needs for ``size`` bytes, rounded up."""
    rate = F.lit(READ_BYTES_PER_SECOND).cast("bigint")
    scaled = size.cast("bigint") * F.lit(1_000_000_000).cast("bigint")
    return F.when(size > 0, F.call_function("div", scaled + rate - 1, rate)).otherwise(
        F.lit(0).cast("bigint")
    )


def read_budget(
    fetches: DataFrame,
    min_interval: int = MIN_FETCH_INTERVAL_NANOS,
    span: int = HOUR_NANOS,
) -> DataFrame:
    """Audit a fetch log ``(shard, at_nanos, bytes)``, times unique per shard.

    Adds ``allowed_at`` (earliest next fetch), ``ready_at`` (what the previous fetch set) and
    ``is_early``. An interval of zero or less switches the budget off.
    """
    if min_interval <= 0:
        never = F.lit(None).cast("bigint")
        return fetches.withColumns(
            {"allowed_at": never, "ready_at": never, "is_early": F.lit(False)}
        )
    wait = F.greatest(F.lit(min_interval).cast("bigint"), read_nanos(F.col("bytes")))
    timed = fetches.withColumn("allowed_at", F.col("at_nanos") + wait)
    latest = Running("max", F.struct("at_nanos", "allowed_at"), exclusive=True)
    out = running(timed, ["shard"], "at_nanos", {"__previous": latest}, span)
    return (
        out.withColumn("ready_at", F.col("__previous.allowed_at"))
        .withColumn("is_early", F.coalesce(F.col("at_nanos") < F.col("ready_at"), F.lit(False)))
        .drop("__previous")
    )
