"""Routes: validity, topic plan, fan-in to the backbone, fan-out to destinations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wharf.functions import attributes as A
from wharf.functions.text import is_blank
from wharf.plans.joins import lookup
from wharf.plans.running import Running, running
from wharf.schemas import (
    BRIDGE_CHANNEL,
    BRIDGE_SOURCE_ID,
    BRIDGE_SOURCE_TOPIC,
    RELAY_DESTINATION_ID,
    RELAY_DOWNSTREAM_TOPIC,
    RELAY_SOURCE_TOPIC,
)

# Name patterns as shown in refusals, and the longest topic name.
ID_PATTERN = "^[a-zA-Z0-9_-]+$"
CHANNEL_PATTERN = "^[a-zA-Z0-9._-]+$"
MAX_TOPIC_LENGTH = 249

# The wording of refusals; the offending value or name is filled in.
NON_BLANK = " must be non-blank"
SOURCE_PATTERN = f"sourceId must match {ID_PATTERN}, got "
CHANNEL_MISMATCH = f"channel must match {CHANNEL_PATTERN}, got "
DESTINATION_PATTERN = f"destinationId must match {ID_PATTERN}, got "
TOO_LONG = f'sourceId + "." + channel must be at most {MAX_TOPIC_LENGTH} characters, got '
WRONG_TARGET = 'targetTopic must equal sourceId + "." + channel ('
BRIDGE_REPEATED = "(sourceId, channel) already registered: "
RELAY_REPEATED = "(destinationId, sourceTopic) already registered: "
NOT_NEGATIVE = " must be >= 0, got "
NOT_POSITIVE = " must be > 0, got "


def _matches(c: Column, pattern: str) -> Column:
    # '$' would accept a final line break; the refusal text still shows the plain pattern.
    return c.rlike(r"\A" + pattern[1:-1] + r"\z")


def _first_reason(checks: list[tuple[Column, Column]]) -> Column:
    """The reason of the first check that holds; null when none does."""
    return F.coalesce(*[F.when(broken, reason) for broken, reason in checks])


def _blank_checks(names: dict[str, str]) -> list[tuple[Column, Column]]:
    return [
        (is_blank(F.col(column)), F.lit(label + NON_BLANK))
        for column, label in names.items()
    ]


def target_topic() -> Column:
    """Backbone topic of a source and channel."""
    return F.concat(F.col("source_id"), F.lit("."), F.col("channel"))


def bridge_refusal() -> Column:
    """Why a bridge route is invalid (``source_id, channel, source_topic, target_topic``)."""
    length = F.length("source_id") + 1 + F.length("channel")
    return _first_reason(
        _blank_checks(
            {
                "source_id": "sourceId",
                "channel": "channel",
                "source_topic": "sourceTopic",
                "target_topic": "targetTopic",
            }
        )
        + [
            (
                ~_matches(F.col("source_id"), ID_PATTERN),
                F.concat(F.lit(SOURCE_PATTERN), F.col("source_id")),
            ),
            (
                ~_matches(F.col("channel"), CHANNEL_PATTERN),
                F.concat(F.lit(CHANNEL_MISMATCH), F.col("channel")),
            ),
            (
                length > MAX_TOPIC_LENGTH,
                F.concat(
                    F.lit(TOO_LONG),
                    length.cast("string"),
                ),
            ),
            (
                F.col("target_topic") != target_topic(),
                F.concat(
                    F.lit(WRONG_TARGET),
                    target_topic(),
                    F.lit("), got "),
                    F.col("target_topic"),
                ),
            ),
        ]
    )


def relay_refusal() -> Column:
    """Why a relay route is invalid (``destination_id, source_topic, downstream_topic``)."""
    return _first_reason(
        _blank_checks(
            {
                "destination_id": "destinationId",
                "source_topic": "sourceTopic",
                "downstream_topic": "downstreamTopic",
            }
        )
        + [
            (
                ~_matches(F.col("destination_id"), ID_PATTERN),
                F.concat(
                    F.lit(DESTINATION_PATTERN),
                    F.col("destination_id"),
                ),
            )
        ]
    )


def _registered(routes: DataFrame, invalid: Column, keys: list[str], repeat: Column) -> DataFrame:
    """Add ``refusal``: an invalid route, or one whose key an earlier valid route holds."""
    checked = routes.withColumn("refusal", invalid)
    sound = F.col("refusal").isNull()
    # Routes with a null key are refused above; the key stays non-null for the running count.
    keyed = checked.withColumns({f"__{k}": F.coalesce(F.col(k), F.lit("")) for k in keys})
    earlier = Running("sum", sound.cast("bigint"), exclusive=True)
    counted = running(keyed, [f"__{k}" for k in keys], "reg_no", {"__earlier": earlier})
    return counted.withColumn(
        "refusal", F.coalesce("refusal", F.when(F.col("__earlier") > 0, repeat))
    ).drop("__earlier", *[f"__{k}" for k in keys])


def check_bridge_routes(routes: DataFrame) -> DataFrame:
    """Register bridge routes in ``reg_no`` order; adds ``refusal`` (null = accepted)."""
    repeat = F.concat(F.lit(BRIDGE_REPEATED), target_topic())
    return _registered(routes, bridge_refusal(), ["source_id", "channel"], repeat)


def check_relay_routes(routes: DataFrame) -> DataFrame:
    """Register relay routes in ``reg_no`` order; one topic may feed many destinations."""
    repeat = F.concat(
        F.lit(RELAY_REPEATED),
        F.col("destination_id"),
        F.lit(" / "),
        F.col("source_topic"),
    )
    return _registered(routes, relay_refusal(), ["destination_id", "source_topic"], repeat)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("refusal").isNull()).drop("refusal")


def topic_plan(
    routes: DataFrame, default_partitions: int = 1, default_replication: int = 1
) -> DataFrame:
    """Topics the routes need; 0 partitions or replicas stand for the default.

    Adds ``effective_partitions``, ``effective_replication`` and ``option_refusal``.
    """
    if default_partitions <= 0:
        raise ValueError(f"defaultPartitions{NOT_POSITIVE}{default_partitions}")
    if default_replication <= 0:
        raise ValueError(f"defaultReplicationFactor{NOT_POSITIVE}{default_replication}")

    def effective(name: str, default: int) -> Column:
        return F.when(F.col(name) == 0, F.lit(default)).otherwise(F.col(name))

    def negative(name: str, label: str) -> tuple[Column, Column]:
        c = F.col(name)
        return c < 0, F.concat(F.lit(label + NOT_NEGATIVE), c.cast("string"))

    return routes.withColumns(
        {
            "effective_partitions": effective("partitions", default_partitions),
            "effective_replication": effective("replication", default_replication),
            "option_refusal": _first_reason(
                [
                    negative("partitions", "partitions"),
                    negative("replication", "replicationFactor"),
                ]
            ),
        }
    )


def to_create(plan: DataFrame, existing: DataFrame) -> DataFrame:
    """Planned topics (``target_topic``) that do not exist yet (``topic``)."""
    there = existing.select(F.col("topic").alias("target_topic")).distinct()
    return plan.where(F.col("option_refusal").isNull()).join(there, "target_topic", "left_anti")


def stamp_bridge(
    df: DataFrame, source_id: Column, channel: Column, source_topic: Column, target: Column
) -> DataFrame:
    """Rewrite to the backbone topic; bridge attributes overwrite what the caller set."""
    stamps = {
        BRIDGE_SOURCE_ID: source_id,
        BRIDGE_SOURCE_TOPIC: source_topic,
        BRIDGE_CHANNEL: channel,
    }
    return df.withColumns({"topic": target, "attributes": A.put(F.col("attributes"), stamps)})


def stamp_relay(
    df: DataFrame, destination_id: Column, source_topic: Column, downstream_topic: Column
) -> DataFrame:
    """Rewrite to the downstream topic; bridge attributes stay."""
    stamps = {
        RELAY_DESTINATION_ID: destination_id,
        RELAY_SOURCE_TOPIC: source_topic,
        RELAY_DOWNSTREAM_TOPIC: downstream_topic,
    }
    return df.withColumns(
        {"topic": downstream_topic, "attributes": A.put(F.col("attributes"), stamps)}
    )


def fan_in(messages: DataFrame, routes: DataFrame, source: str | None = None) -> DataFrame:
    """Route messages to the backbone by their source topic.

    ``source`` names the column with the id of the source a message was read from, where
    topics of different sources share a name. Without it every route of the topic applies.
    """
    table = routes.select(
        F.col("source_topic").alias("topic"), "source_id", "channel", "target_topic"
    )
    keys = ["topic"]
    if source is not None:
        table = table.withColumn(source, F.col("source_id"))
        keys.append(source)
    # The route's own columns get names that no message column has.
    named = {c: f"__{c}" for c in ("source_id", "channel", "target_topic")}
    table = table.select(*keys, *[F.col(c).alias(n) for c, n in named.items()])
    routed = lookup(messages, table, keys)
    stamped = stamp_bridge(
        routed,
        F.col("__source_id"),
        F.col("__channel"),
        F.col("topic"),
        F.col("__target_topic"),
    )
    return stamped.select(*messages.columns)


def fan_out(backbone: DataFrame, routes: DataFrame) -> DataFrame:
    """Copy each backbone message to every destination subscribed to its topic."""
    table = routes.select(
        F.col("source_topic").alias("topic"),
        F.col("destination_id").alias("__destination_id"),
        F.col("downstream_topic").alias("__downstream_topic"),
    )
    routed = lookup(backbone, table, ["topic"])
    stamped = stamp_relay(
        routed, F.col("__destination_id"), F.col("topic"), F.col("__downstream_topic")
    )
    return stamped.select(*backbone.columns)


def paths(messages: DataFrame) -> DataFrame:
    """How many messages took each source, channel, destination path."""

    def attribute(key: str) -> Column:
        return F.element_at("attributes", key)

    return messages.groupBy(
        attribute(BRIDGE_SOURCE_ID).alias("source_id"),
        attribute(BRIDGE_CHANNEL).alias("channel"),
        attribute(RELAY_DESTINATION_ID).alias("destination_id"),
        attribute(RELAY_DOWNSTREAM_TOPIC).alias("downstream_topic"),
    ).agg(F.count("*").alias("messages"))
