"""Request batches: prechecks, chunks of a bounded size, per-entry outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wharf.plans.joins import lookup
from wharf.plans.running import SPAN, Running, running
from wharf.session import settle

# Records per put request, and the two failure texts.
MAX_RECORDS_PER_PUT = 500
NULL_ENTRY = "messages contains null"
ENTRY_FAILED = "Kinesis PutRecords entry failed: "


def precheck(df: DataFrame, batch: list[str], entry: str) -> DataFrame:
    """Refuse a whole batch for one null entry; adds ``refusal`` (null for accepted rows)."""
    bad = settle(df.where(F.col(entry).isNull()).select(*batch).distinct())
    marked = lookup(df, bad.withColumn("refusal", F.lit(NULL_ENTRY)), batch, "left")
    return marked


def chunks(
    df: DataFrame,
    keys: list[str],
    position: str,
    size: int = MAX_RECORDS_PER_PUT,
    span: int = SPAN,
) -> DataFrame:
    """Number the requests per key: rows in input order, ``size`` per request.

    Adds ``chunk_no`` and ``entry_no``, both from 0.
    """
    if not 0 < size <= MAX_RECORDS_PER_PUT:
        raise ValueError(f"a request takes 1 to {MAX_RECORDS_PER_PUT} records, got {size}")
    before = Running("sum", F.lit(1).cast("bigint"), exclusive=True)
    ranked = running(df, keys, position, {"__before": before}, span)
    step = F.lit(size).cast("bigint")
    return (
        ranked.withColumn("chunk_no", F.call_function("div", F.col("__before"), step))
        .withColumn("entry_no", F.col("__before") % step)
        .drop("__before")
    )


def entry_outcomes(entries: DataFrame, calls: DataFrame) -> DataFrame:
    """Outcome of every entry of every put request.

    ``entries`` has ``stream, chunk_no, error_code, error_message, shard_id,
    sequence_number``; ``calls`` has ``stream, chunk_no, call_error``. A failed call fails all
    its entries; else an entry fails by its own error code. Requests are bounded in size, so
    the join has no hot keys.
    """
    joined = entries.join(calls, ["stream", "chunk_no"], "left")
    error = F.when(F.col("call_error").isNotNull(), F.col("call_error")).when(
        F.col("error_code").isNotNull(),
        F.concat(
            F.lit(ENTRY_FAILED),
            F.col("error_code"),
            F.lit(": "),
            F.coalesce(F.col("error_message"), F.lit("null")),
        ),
    )
    return (
        joined.withColumn("error", error)
        .withColumn("ok", F.col("error").isNull())
        .withColumn(
            "message_id",
            F.when(F.col("ok"), F.concat_ws(":", "shard_id", "sequence_number")),
        )
    )
