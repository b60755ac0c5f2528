"""Publish outcomes: batch results, batch cuts, breaker trips, relay attempts.

An ``outcomes`` table has ``reg, batch_no, idx, id, ok, error``: one row per publish.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wharf.plans.running import SPAN, Running, running, streaks

BATCH = ["reg", "batch_no"]

# Breaker threshold default and the batch failure text.
FAILURE_THRESHOLD = 5
BATCH_FAILED = "publishBatch had "


def batch_results(outcomes: DataFrame, keys: list[str] = BATCH) -> DataFrame:
    """One row per batch: counts, the failure text and the cause with the lowest index.

    Batches of any size stay one narrow row; their entries are in :func:`batch_entries`.
    """
    failed = ~F.col("ok")
    rows = outcomes.groupBy(*keys).agg(
        F.count_if("ok").alias("succeeded"),
        F.count_if(failed).alias("failed"),
        F.min(F.when(failed, F.col("idx"))).alias("first_failed_idx"),
        F.min_by("error", F.when(failed, F.col("idx"))).alias("cause"),
    )
    count = F.col("failed")
    text = F.concat(
        F.lit(BATCH_FAILED),
        count.cast("string"),
        F.when(count == 1, F.lit(" failure")).otherwise(F.lit(" failures")),
    )
    # min_by returns some row's error when nothing failed; only failures have a cause.
    return rows.withColumn("message", F.when(count > 0, text)).withColumn(
        "cause", F.when(count > 0, F.col("cause"))
    )


def batch_entries(
    outcomes: DataFrame, keys: list[str] = BATCH, span: int = SPAN
) -> DataFrame:
    """The entries of each batch: ``success_no`` numbers the results in input order from 0.

    Failed entries keep their input index as key and their own error as cause.
    """
    before = Running("sum", F.col("ok").cast("bigint"), exclusive=True)
    rows = running(outcomes, keys, "idx", {"__before": before}, span)
    return rows.withColumn("success_no", F.when(F.col("ok"), F.col("__before"))).drop("__before")


def batch_cut(outcomes: DataFrame, span: int = SPAN) -> DataFrame:
    """Bridge batches stop at their first failure; adds ``state``.

    Rows before it are ``acked``, it is ``failed``, rows after it are ``not_attempted``.
    """
    before = Running("max", (~F.col("ok")).cast("int"), exclusive=True)
    rows = running(outcomes, BATCH, "idx", {"__stopped": before}, span)
    stopped = F.coalesce(F.col("__stopped") == 1, F.lit(False))
    state = (
        F.when(stopped, "not_attempted").when(F.col("ok"), "acked").otherwise("failed")
    )
    return rows.withColumn("state", state).drop("__stopped")


def batch_minima(outcomes: DataFrame) -> DataFrame:
    """Per batch the first success and the first failure; both combine across parts of a batch."""
    return outcomes.groupBy(*BATCH).agg(
        F.min(F.when(F.col("ok"), F.col("idx"))).cast("bigint").alias("first_ok"),
        F.min(F.when(~F.col("ok"), F.col("idx"))).cast("bigint").alias("first_fail"),
    )


def batch_flags(minima: DataFrame) -> DataFrame:
    """Per batch whether a publish succeeded and whether one failed (0 or 1).

    A batch stops at its first failure: what comes after it was never attempted and counts for
    nothing, so a success counts only before it.
    """
    fails = F.col("first_fail").isNotNull()
    before = F.col("first_ok").isNotNull() & (~fails | (F.col("first_ok") < F.col("first_fail")))
    return minima.withColumns({"any_ok": before.cast("int"), "fails": fails.cast("int")})


def failure_streaks(flags: DataFrame, span: int = SPAN) -> DataFrame:
    """Add ``streak``: failed batches in a row, a success in a batch counting first."""
    narrow = flags.withColumn("__reset", F.col("any_ok") == 1)
    return streaks(narrow, ["reg"], "batch_no", "__reset", "fails", "streak", span).drop("__reset")


def breaker_trips(
    outcomes: DataFrame, threshold: int = FAILURE_THRESHOLD, span: int = SPAN
) -> DataFrame:
    """Batches after which the breaker pauses a registration.

    After a trip the counter stands one below the threshold, so each further failure trips
    again until a success: exactly the failed batches with a streak at or over the threshold.
    """
    if threshold <= 0:
        raise ValueError(f"publishFailureThreshold must be > 0, got {threshold}")
    rows = failure_streaks(batch_flags(batch_minima(outcomes)), span)
    tripped = (F.col("fails") == 1) & (F.col("streak") >= threshold)
    return rows.where(tripped).select(*BATCH, "streak")


def relay_ledger(attempts: DataFrame, span: int = SPAN) -> DataFrame:
    """Relay attempts ``(reg, msg_no, at, ok)`` per message.

    Adds ``attempts, first_at, delivered_at, wait`` and ``in_order``: no attempt before every
    earlier message of the registration was delivered. Times are integers (ticks).
    """
    ledger = attempts.groupBy("reg", "msg_no").agg(
        F.count("*").alias("attempts"),
        F.min("at").alias("first_at"),
        F.min(F.when(F.col("ok"), F.col("at"))).alias("delivered_at"),
    )
    rows = running(
        ledger,
        ["reg"],
        "msg_no",
        {
            "__last": Running("max", F.col("delivered_at"), exclusive=True),
            "__open": Running("max", F.col("delivered_at").isNull().cast("int"), exclusive=True),
        },
        span,
    )
    first = F.col("__open").isNull()
    fine = (F.col("__open") == 0) & (F.col("first_at") >= F.col("__last"))
    return (
        rows.withColumn("wait", F.col("delivered_at") - F.col("first_at"))
        .withColumn("in_order", first | fine)
        .drop("__last", "__open")
    )


def ack_failures(acks: DataFrame) -> DataFrame:
    """Relay batches ``(reg, batch_no, id, ack_ok)``: failed acks and backoffs.

    A failed ack never stops the batch, and a batch backs off once at most.
    """
    return acks.groupBy(*BATCH).agg(
        F.count("*").alias("published"),
        F.count_if(~F.col("ack_ok")).alias("ack_failures"),
        F.max((~F.col("ack_ok")).cast("int")).alias("backoffs"),
    )


def duplicate_candidates(acks: DataFrame) -> DataFrame:
    """Published but not acked: these may be published again."""
    return acks.where(~F.col("ack_ok"))
