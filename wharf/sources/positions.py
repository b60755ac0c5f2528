"""Start positions: a global default with per-partition overrides."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wharf.functions import digits
from wharf.plans.joins import lookup

# The kinds of start position.
LATEST = "LATEST"
TRIM_HORIZON = "TRIM_HORIZON"
AT_TIMESTAMP = "AT_TIMESTAMP"
AT_SEQUENCE_NUMBER = "AT_SEQUENCE_NUMBER"
AFTER_SEQUENCE_NUMBER = "AFTER_SEQUENCE_NUMBER"


@dataclass(frozen=True)
class Start:
    """One start position; ``timestamp`` is UTC text, ``sequence`` a digit string."""

    kind: str
    timestamp: str | None = None
    sequence: str | None = None

    def __post_init__(self) -> None:
        if self.kind == AT_TIMESTAMP and self.timestamp is None:
            raise ValueError("AT_TIMESTAMP needs a timestamp")
        if self.kind in (AT_SEQUENCE_NUMBER, AFTER_SEQUENCE_NUMBER) and self.sequence is None:
            raise ValueError(f"{self.kind} needs a sequence number")

    def columns(self) -> dict[str, Column]:
        return {
            "start_kind": F.lit(self.kind),
            "start_ts": F.lit(self.timestamp).cast("timestamp_ntz"),
            "start_seq": F.lit(self.sequence).cast("string"),
        }


def start_at(df: DataFrame, default: Start, overrides: DataFrame | None = None) -> DataFrame:
    """Keep the rows at or after their partition's start.

    ``df`` has ``part, pos`` (digit string) and ``arrived_at``; ``overrides`` has
    ``part, start_kind, start_ts, start_seq``. LATEST keeps nothing that is already there.
    """
    fallback = default.columns()
    if overrides is None:
        kind, ts, seq = fallback["start_kind"], fallback["start_ts"], fallback["start_seq"]
        placed = df
    else:
        own = overrides.select("part", *fallback)
        placed = lookup(df, own, ["part"], "left")
        has_own = F.col("start_kind").isNotNull()
        kind, ts, seq = (
            F.when(has_own, F.col(name)).otherwise(value) for name, value in fallback.items()
        )
    here = digits.order(F.col("pos"))
    wanted = (
        F.when(kind == TRIM_HORIZON, F.lit(True))
        .when(kind == AT_TIMESTAMP, F.col("arrived_at") >= ts)
        .when(kind == AT_SEQUENCE_NUMBER, here >= digits.order(seq))
        .when(kind == AFTER_SEQUENCE_NUMBER, here > digits.order(seq))
        .otherwise(F.lit(False))
    )
    return placed.where(wanted).select(*df.columns)


def readable_shards(shards: DataFrame, default: Start, has_overrides: bool = False) -> DataFrame:
    """Drop closed shards (``closed_at`` set) that the default start can never read from."""
    if has_overrides or default.kind not in (LATEST, AT_TIMESTAMP):
        return shards
    is_open = F.col("closed_at").isNull()
    if default.kind == LATEST:
        return shards.where(is_open)
    return shards.where(is_open | (F.col("closed_at") > default.columns()["start_ts"]))


def restored(checkpoints: DataFrame) -> DataFrame:
    """Overrides that continue after exported checkpoints (``part, checkpoint``)."""
    return checkpoints.select(
        "part",
        F.lit(AFTER_SEQUENCE_NUMBER).alias("start_kind"),
        F.lit(None).cast("timestamp_ntz").alias("start_ts"),
        F.col("checkpoint").alias("start_seq"),
    )


# Option names of a Kafka scan, and the offsets that stand for its two ends.
OFFSETS, TIMESTAMPS = "startingOffsets", "startingOffsetsByTimestamp"
LATEST_OFFSET, EARLIEST_OFFSET = -1, -2


def kafka_start_texts(starts: DataFrame) -> DataFrame:
    """Where a Kafka scan begins, one row per topic and option: ``topic, option, partitions``.

    ``starts`` has ``topic, part, start_kind, start_ts, start_seq``, one row per partition (see
    :func:`kafka_restored`); ``partitions`` is the JSON text from partition to offset, or to
    milliseconds for AT_TIMESTAMP (the timestamp is UTC).
    """
    kind, seq = F.col("start_kind"), F.col("start_seq").cast("bigint")
    ts = F.col("start_ts")
    minutes = (F.unix_date(F.to_date(ts)) * F.lit(24) + F.hour(ts)) * F.lit(60) + F.minute(ts)
    within = F.floor(F.date_part(F.lit("SECOND"), ts) * 1000)
    millis = minutes.cast("bigint") * 60_000 + within
    value = (
        F.when(kind == LATEST, F.lit(LATEST_OFFSET))
        .when(kind == TRIM_HORIZON, F.lit(EARLIEST_OFFSET))
        .when(kind == AT_SEQUENCE_NUMBER, seq)
        .when(kind == AFTER_SEQUENCE_NUMBER, seq + 1)
        .when(kind == AT_TIMESTAMP, millis)
    )
    option = F.when(kind == AT_TIMESTAMP, TIMESTAMPS).otherwise(OFFSETS)
    entry = F.struct(F.col("part").cast("string").alias("part"), value.alias("value"))
    # A topic's partitions are few: broker metadata, not records.
    return starts.groupBy("topic", option.alias("option")).agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("partitions")
    )


def kafka_start_options(starts: DataFrame) -> dict[str, str]:
    """The options of one Kafka scan; a scan takes offsets or timestamps, not both."""
    texts: dict[str, dict] = {}
    for row in kafka_start_texts(starts).orderBy("topic").toLocalIterator():
        texts.setdefault(row.option, {})[row.topic] = json.loads(row.partitions)
    if len(texts) > 1:
        raise ValueError("scan the partitions with a timestamp apart from those with an offset")
    return {option: json.dumps(topics, sort_keys=True) for option, topics in texts.items()}


def kafka_read_from(df: DataFrame, starts: DataFrame) -> DataFrame:
    """The rows of a landed Kafka log (``topic, part, off``) at or after the starts of their partition.

    ``starts`` has offsets, as AT_SEQUENCE_NUMBER or AFTER_SEQUENCE_NUMBER (see
    :func:`kafka_restored`); partitions without a start are read in full.
    """
    after = (F.col("start_kind") == AFTER_SEQUENCE_NUMBER).cast("bigint")
    first = starts.select("topic", "part", (F.col("start_seq").cast("bigint") + after).alias("__first"))
    placed = lookup(df, first, ["topic", "part"], "left", null_safe=True)
    reached = F.coalesce(F.col("off") >= F.col("__first"), F.lit(True))
    return placed.where(reached).select(*df.columns)


def kafka_restored(checkpoints: DataFrame) -> DataFrame:
    """Starts that continue after Kafka checkpoints (``topic, part, checkpoint``)."""
    return restored(checkpoints.withColumn("part", F.struct("topic", "part"))).select(
        "part.topic", "part.part", "start_kind", "start_ts", F.col("start_seq").cast("string")
    )
