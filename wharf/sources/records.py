"""Raw broker records to the message envelope.

Each function is a projection, so it works on a batch table, a landed copy or a stream.
Besides the envelope columns it keeps where the message was delivered:
``backend, part, pos`` (text) and ``pos_num`` (Kafka offsets only).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wharf.functions import attributes as A
from wharf.functions.text import bytes_or_empty, instant_text
from wharf.schemas import ARRIVAL, KAFKA_KEY, MESSAGE_COLUMNS, PARTITION_KEY


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def kafka(df: DataFrame, keep_key: bool = False) -> DataFrame:
    """Kafka records. The record key is not surfaced unless ``keep_key`` asks for it."""
    attributes = A.from_headers(F.col("headers"))
    if keep_key:
        attributes = F.when(
            F.col("key").isNotNull(),
            A.put(attributes, {KAFKA_KEY: F.make_valid_utf8(F.col("key").cast("string"))}),
        ).otherwise(attributes)
    return df.select(
        F.concat_ws("-", "topic", "partition", "offset").alias("id"),
        F.col("topic"),
        bytes_or_empty(F.col("value")).alias("payload"),
        attributes.alias("attributes"),
        F.lit("kafka").alias("backend"),
        F.col("partition").cast("string").alias("part"),
        F.col("offset").cast("string").alias("pos"),
        F.col("offset").alias("pos_num"),
    )


def kinesis(df: DataFrame, stream: str) -> DataFrame:
    """Kinesis shard records of one stream."""
    arrival = instant_text(F.col("arrival"), df.schema["arrival"].dataType)
    carried = F.create_map(
        F.lit(PARTITION_KEY), F.col("partition_key"), F.lit(ARRIVAL), arrival
    )
    return df.select(
        F.concat_ws(":", "shard_id", "sequence_number").alias("id"),
        F.lit(stream).alias("topic"),
        bytes_or_empty(F.col("data")).alias("payload"),
        F.map_filter(carried, lambda _, v: v.isNotNull()).alias("attributes"),
        F.lit("kinesis").alias("backend"),
        F.col("shard_id").alias("part"),
        F.col("sequence_number").alias("pos"),
        F.lit(None).cast("bigint").alias("pos_num"),
        F.col("arrival").alias("arrived_at"),
    )


def pulsar(df: DataFrame) -> DataFrame:
    """Pulsar messages; the id carries the topic because positions repeat across topics."""
    return df.select(
        F.concat_ws("-", "topic", "message_id").alias("id"),
        F.col("topic"),
        bytes_or_empty(F.col("value")).alias("payload"),
        A.or_empty(F.col("properties")).alias("attributes"),
        F.lit("pulsar").alias("backend"),
        F.col("topic").alias("part"),
        F.col("message_id").alias("pos"),
        F.lit(None).cast("bigint").alias("pos_num"),
    )


def gcp(df: DataFrame, subscription: str) -> DataFrame:
    """Google Pub/Sub messages of one subscription; the subscription id is the topic."""
    return df.select(
        F.col("message_id").alias("id"),
        F.lit(subscription).alias("topic"),
        bytes_or_empty(F.col("data")).alias("payload"),
        A.or_empty(F.col("attributes")).alias("attributes"),
        F.lit("gcp").alias("backend"),
        _text(None).alias("part"),
        F.col("ack_id").alias("pos"),
        F.lit(None).cast("bigint").alias("pos_num"),
    )


def envelope(df: DataFrame) -> DataFrame:
    """Only the four envelope columns."""
    return df.select(*MESSAGE_COLUMNS)


def subscribed(df: DataFrame, topics: list[str]) -> DataFrame:
    """Rows of the subscribed topics; listing one twice changes nothing."""
    return df.where(F.col("topic").isin(sorted(set(topics))))
