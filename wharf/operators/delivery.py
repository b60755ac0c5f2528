"""Delivery ledger: acks, checkpoints, commits, redelivery and resume positions.

A ``delivered`` table has ``id, topic, part`` and a position; an ``acks`` table has
``id, ack_seq`` in the order the acks were made.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from wharf.functions import digits
from wharf.plans.joins import lookup
from wharf.plans.running import SPAN, Running, running
from wharf.session import settle
from wharf.sources.positions import AFTER_SEQUENCE_NUMBER, AT_SEQUENCE_NUMBER, Start

PARTITION = ["topic", "part"]

# Fixed value: refusal of an ack.
UNKNOWN_ACK_HEAD = "Unknown message: "
UNKNOWN_ACK_TAIL = ". Only messages returned by poll() can be acknowledged."


def partitions(delivered: DataFrame, position: Column, keys: list[str] = PARTITION) -> DataFrame:
    """One settled row per partition: ``keys, number, first_pos, last_pos``."""
    seen = delivered.groupBy(*keys).agg(
        F.min(position).alias("first_pos"), F.max(position).alias("last_pos")
    )
    return settle(seen.withColumn("number", F.monotonically_increasing_id()))


def ledger(
    delivered: DataFrame,
    acks: DataFrame,
    position: Column,
    parts: DataFrame,
    keys: list[str] = PARTITION,
    by_id: Column | None = None,
) -> DataFrame:
    """One row per delivered message: ``id, number, pos, ack_seq`` (null while unacked).

    Deliveries and acks of an id meet in one aggregate instead of a join: repeated
    deliveries and repeated acks fold together before the shuffle, so no id is ever hot.
    Partitions go by their number there; numeric buffers keep the aggregate hash-based. A
    text position would make it sort instead: give ``by_id``, the same position read from
    the ``id`` column, to leave it out.
    """
    carried = [position.alias("pos")] if by_id is None else []
    placed = lookup(
        delivered.select("id", *keys, *carried), parts.select(*keys, "number"), keys, null_safe=True
    ).drop(*keys)
    both = placed.unionByName(
        acks.select("id", F.col("ack_seq").cast("bigint").alias("ack_seq")),
        allowMissingColumns=True,
    )
    folded = both.groupBy("id").agg(*[F.min(c).alias(c) for c in both.columns if c != "id"])
    known = folded.where(F.col("number").isNotNull())
    return known if by_id is None else known.withColumn("pos", by_id)


def acked(delivered: DataFrame, acks: DataFrame) -> DataFrame:
    """Delivered messages with the order of their first ack (null while unacked)."""
    parts = partitions(delivered, F.col("off"))
    rows = ledger(delivered, acks, F.col("off"), parts)
    return lookup(rows, parts.select("number", *PARTITION), ["number"]).select(
        "id", *PARTITION, F.col("pos").alias("off"), "ack_seq"
    )


def partition_state(
    delivered: DataFrame,
    acks: DataFrame,
    position: Column,
    keys: list[str] = PARTITION,
    by_id: Column | None = None,
) -> DataFrame:
    """One row per partition: ``first_pos, last_pos, first_unacked, outstanding``.

    ``position`` is any orderable column, such as an offset or ``digits.order(pos)``. All
    aggregates combine map-side; no partition is sorted or gathered in one task.
    """
    parts = partitions(delivered, position, keys)
    held = (
        ledger(delivered, acks, position, parts, keys, by_id)
        .where(F.col("ack_seq").isNull())
        .groupBy("number")
        .agg(F.min("pos").alias("first_unacked"), F.count("*").alias("outstanding"))
    )
    return parts.join(held, "number", "left").fillna({"outstanding": 0}).drop("number")


def checkpoints(
    delivered: DataFrame,
    acks: DataFrame,
    position: Column,
    keys: list[str] = PARTITION,
    by_id: Column | None = None,
) -> DataFrame:
    """Per partition the last position of the longest fully acked prefix of what was delivered.

    Gaps between delivered positions do not matter. A partition whose first row is unacked
    has no row here.
    """
    state = settle(partition_state(delivered, acks, position, keys, by_id))
    return checkpoints_of(state, delivered, position, keys)


def checkpoints_of(
    state: DataFrame, delivered: DataFrame, position: Column, keys: list[str] = PARTITION
) -> DataFrame:
    """The same from a settled :func:`partition_state`."""
    done = state.where(F.col("first_unacked").isNull()).select(
        *keys, F.col("last_pos").alias("checkpoint")
    )
    # Only partitions that are held up need a second look at their rows.
    held = state.where(F.col("first_pos") < F.col("first_unacked")).select(*keys, "first_unacked")
    rows = delivered.select(*keys, position.alias("__pos"))
    partial = (
        lookup(rows, held, keys, null_safe=True)
        .where(F.col("__pos") < F.col("first_unacked"))
        .groupBy(*keys)
        .agg(F.max("__pos").alias("checkpoint"))
    )
    return done.unionByName(partial)


def sequence() -> Column:
    """A Kinesis position as sortable key."""
    return digits.order(F.col("pos"))


def sequence_of_id() -> Column:
    """The same from the message id: shard id, colon, sequence number."""
    return digits.order(F.substring_index("id", ":", -1))


def shard_state(delivered: DataFrame, acks: DataFrame) -> DataFrame:
    """Settled :func:`partition_state` of Kinesis shards."""
    return settle(partition_state(delivered, acks, sequence(), ["part"], sequence_of_id()))


def shard_checkpoints(
    delivered: DataFrame, acks: DataFrame, state: DataFrame | None = None
) -> DataFrame:
    """Kinesis checkpoints ``part, checkpoint`` (digit string), ready to be saved."""
    state = shard_state(delivered, acks) if state is None else state
    points = checkpoints_of(state, delivered, sequence(), ["part"])
    return points.select("part", F.col("checkpoint.digits").alias("checkpoint"))


def merge_checkpoints(*snapshots: DataFrame) -> DataFrame:
    """Checkpoints (digit strings) of several sessions; a checkpoint never moves back."""
    merged = snapshots[0]
    for more in snapshots[1:]:
        merged = merged.unionByName(more)
    return merged.groupBy("part").agg(
        F.max(digits.order(F.col("checkpoint")))["digits"].alias("checkpoint")
    )


def in_flight(delivered: DataFrame, acks: DataFrame, cap: int, keys: list[str]) -> DataFrame:
    """Delivered, unacked ids per consumer and whether that reaches the cap (0 = no cap)."""
    none = F.lit(0).cast("bigint")
    counted = partition_state(delivered, acks, none, keys).select(
        *keys, F.col("outstanding").alias("in_flight")
    )
    hit = F.lit(cap > 0) & (F.col("in_flight") >= cap)
    return counted.withColumn("cap_reached", hit)


def session_checkpoints(
    delivered: DataFrame, acks: DataFrame, position: Column, keys: list[str] = PARTITION
) -> DataFrame:
    """Checkpoints over several sessions (integer column ``session`` on both sides).

    A reset ends a session: acks beyond its prefix are forgotten, and what was not committed is
    delivered again in the next one. So each session stands for itself, an ack counts only in
    the session that made it, and the furthest session checkpoint holds.
    """
    own = F.concat_ws("#", "session", "id")
    points = checkpoints(
        delivered.withColumn("id", own), acks.withColumn("id", own), position, [*keys, "session"]
    )
    return points.groupBy(*keys).agg(F.max("checkpoint").alias("checkpoint"))


def refused_acks(delivered: DataFrame, acks: DataFrame, session: str | None = None) -> DataFrame:
    """Acks of ids that were never delivered, and every ack after the first of an id.

    With a ``session`` column on both sides, ids are in flight within their session only: an
    ack of an id that only an earlier session delivered is refused as well. Ids are judged
    first, one row each; only the rows of the faulty ids are then looked up.
    """
    keys = ["id"] if session is None else ["id", session]
    both = acks.select(*keys, "ack_seq").unionByName(
        delivered.select(*keys, F.lit(1).alias("known")), allowMissingColumns=True
    )
    judged = both.groupBy(*keys).agg(
        F.max("known").alias("known"),
        F.min("ack_seq").alias("first_seq"),
        F.max("ack_seq").alias("last_seq"),
    )
    strange = F.col("known").isNull()
    faulty = settle(judged.where(strange | (F.col("first_seq") < F.col("last_seq"))))
    rows = lookup(acks.select(*keys, "ack_seq"), faulty.select(*keys, "known", "first_seq"), keys)
    cause = F.when(strange, "never delivered").otherwise("already acknowledged")
    if session is not None:
        unknown = faulty.where(strange).select("id").distinct()
        before = lookup(delivered.select("id", session), unknown, ["id"])
        first = settle(before.groupBy("id").agg(F.min(session).alias("__first")))
        rows = lookup(rows, first, ["id"], "left")
        earlier = strange & (F.col("__first") < F.col(session))
        cause = F.when(earlier, "of an earlier session").otherwise(cause)
    return rows.where(strange | (F.col("ack_seq") > F.col("first_seq"))).select(
        *keys, "ack_seq", cause.alias("cause"), refusal(F.col("id")).alias("message")
    )


def refusal(message_id: Column) -> Column:
    """The text that refuses an ack."""
    return F.concat(F.lit(UNKNOWN_ACK_HEAD), message_id, F.lit(UNKNOWN_ACK_TAIL))


def latest_handles(deliveries: DataFrame) -> DataFrame:
    """The ack id to use per message: a redelivery replaces the older one."""
    return deliveries.groupBy("id").agg(
        F.max_by("ack_id", "delivered_at").alias("ack_id"), F.count("*").alias("deliveries")
    )


def commits(ledger: DataFrame, span: int = SPAN) -> DataFrame:
    """Commit history of a ledger ``(topic, part, off, ack_seq)``.

    Every ack that lengthens the acked prefix makes one commit, of the offset after it.
    """
    return commits_of(with_prefix(ledger, span))


def with_prefix(
    ledger: DataFrame,
    span: int = SPAN,
    more: Mapping[str, Running] | None = None,
    keys: list[str] = PARTITION,
) -> DataFrame:
    """Add ``in_prefix`` and ``at_ack``, the ack that brought the row into the prefix.

    ``more`` are further running columns to make in the same pass.
    """
    rows = running(
        ledger,
        keys,
        "off",
        {
            "__whole": Running("min", F.col("ack_seq").isNotNull().cast("int")),
            "at_ack": Running("max", F.col("ack_seq")),
            **(more or {}),
        },
        span,
    )
    return rows.withColumn("in_prefix", F.col("__whole") == 1).drop("__whole")


def commits_of(rows: DataFrame, keys: list[str] = PARTITION) -> DataFrame:
    return (
        rows.where("in_prefix")
        .groupBy(*keys, "at_ack")
        .agg((F.max("off") + 1).alias("commit_offset"))
    )


def commit_attempts(ledger: DataFrame, span: int = SPAN) -> DataFrame:
    """Every commit that was tried over a ledger with ``commit_ok``, the outcome of a commit
    made at that ack: ``topic, part, ack_seq, commit_offset, commit_ok``.

    A failed commit leaves its prefix as it is, so the next ack of the partition tries again,
    wherever its own row is, and the first success sweeps all of it. An ack thus tries when
    no success of an earlier ack could have taken in the last advance of the prefix.

    Every row is an ack of its own, also where several of a partition share an ``ack_seq``. Those
    try in turn, the failures first, for the prefix that they reach together: each failure is a row,
    and of the successes only the first one finds something to commit.
    """
    advances = commits(ledger, span).withColumnRenamed("at_ack", "ack_seq")
    made = ledger.where(F.col("ack_seq").isNotNull()).select(
        *PARTITION, "ack_seq", "commit_ok", F.lit(1).alias("__made")
    )
    ok = F.col("commit_ok")
    log = settle(
        made.unionByName(advances, allowMissingColumns=True)
        .groupBy(*PARTITION, "ack_seq")
        .agg(
            F.max(ok).alias("commit_ok"),
            F.count(F.when(~ok, 1)).alias("__failed"),
            F.count(F.when(ok.isNull(), F.col("__made"))).alias("__unknown"),
            F.max("commit_offset").alias("__advance"),
        )
    )
    ack = F.col("ack_seq")
    seen = running(
        log,
        PARTITION,
        "ack_seq",
        {
            "commit_offset": Running("max", F.col("__advance")),
            "__advanced": Running("max", F.when(F.col("__advance").isNotNull(), ack)),
            "__swept": Running("max", F.when(ok, ack), exclusive=True),
        },
        span,
    )
    pending = F.col("__advanced") > F.coalesce("__swept", F.col("__advanced") - 1)
    tries = F.concat(
        F.array_repeat(F.lit(None).cast("boolean"), F.col("__unknown").cast("int")),
        F.array_repeat(F.lit(False), F.col("__failed").cast("int")),
        F.array_repeat(F.lit(True), F.when(ok, 1).otherwise(0)),
    )
    return seen.where(pending).select(
        *PARTITION, "ack_seq", "commit_offset", F.explode(tries).alias("commit_ok")
    )


def seek_positions(delivered: DataFrame, acks: DataFrame) -> DataFrame:
    """Kafka restart or cap: seek to the first delivered offset that is not committed.

    Partitions with nothing outstanding are not moved and have no row.
    """
    state = partition_state(delivered, acks, F.col("off"))
    return state.where(F.col("first_unacked").isNotNull()).select(
        *PARTITION, F.col("first_unacked").alias("seek_to")
    )


def redelivered(delivered: DataFrame, acks: DataFrame) -> DataFrame:
    """Rows that come again after the seek: acks beyond the prefix are forgotten."""
    seeks = settle(seek_positions(delivered, acks))
    return lookup(delivered, seeks, PARTITION, null_safe=True).where(F.col("off") >= F.col("seek_to"))


def resume_positions(
    shards: DataFrame,
    delivered: DataFrame,
    acks: DataFrame,
    default: Start,
    overrides: DataFrame | None = None,
    saved: DataFrame | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Kinesis iterator expiry: where each shard of ``shards`` (``part``) goes on reading.

    After its checkpoint if it has one (saved or of this session); else at the lowest
    delivered record; else at its configured start.
    """
    keys = ["part"]
    state = shard_state(delivered, acks) if state is None else state
    now = shard_checkpoints(delivered, acks, state)
    reached = merge_checkpoints(now, saved) if saved is not None else now
    # Without a checkpoint nothing was drained, so the first delivered record is the lowest.
    lowest = state.select("part", F.col("first_pos.digits").alias("__lowest"))
    out = shards.select("part").distinct().join(reached, keys, "left").join(lowest, keys, "left")
    start = default.columns()
    if overrides is not None:
        out = out.join(overrides.select("part", *start), keys, "left")
        has_own = F.col("start_kind").isNotNull()
        start = {n: F.when(has_own, F.col(n)).otherwise(c) for n, c in start.items()}
    reads_on, again = F.col("checkpoint").isNotNull(), F.col("__lowest").isNotNull()
    return out.select(
        "part",
        F.when(reads_on, AFTER_SEQUENCE_NUMBER)
        .when(again, AT_SEQUENCE_NUMBER)
        .otherwise(start["start_kind"])
        .alias("start_kind"),
        F.when(~reads_on & ~again, start["start_ts"]).alias("start_ts"),
        F.coalesce("checkpoint", "__lowest", start["start_seq"]).alias("start_seq"),
    )


def touched_at_cap(
    delivered: DataFrame,
    acks: DataFrame,
    default: Start,
    overrides: DataFrame | None = None,
    saved: DataFrame | None = None,
) -> DataFrame:
    """Kinesis cap: resume positions of the shards with outstanding rows only, closed ones too."""
    state = shard_state(delivered, acks)
    outstanding = state.where(F.col("outstanding") > 0).select("part")
    return resume_positions(outstanding, delivered, acks, default, overrides, saved, state)
