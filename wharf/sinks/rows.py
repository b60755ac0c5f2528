"""Envelopes to broker rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wharf.functions import attributes as A
from wharf.schemas import KAFKA_KEY, PARTITION_KEY


def kafka(df: DataFrame) -> DataFrame:
    """``topic, key, value, headers``: the key attribute becomes the key, the rest headers."""
    return df.select(
        "topic",
        F.element_at("attributes", KAFKA_KEY).cast("binary").alias("key"),
        F.col("payload").alias("value"),
        A.to_headers(A.drop(F.col("attributes"), KAFKA_KEY)).alias("headers"),
    )


def kinesis(df: DataFrame, carry_attributes: bool = False) -> DataFrame:
    """``stream, partition_key, data``; attributes are not sent unless asked for."""
    key = F.coalesce(F.nullif(F.element_at("attributes", PARTITION_KEY), F.lit("")), F.col("id"))
    extra = [F.col("attributes")] if carry_attributes else []
    return df.select(
        F.col("topic").alias("stream"),
        key.alias("partition_key"),
        F.col("payload").alias("data"),
        *extra,
    )


def pulsar(df: DataFrame) -> DataFrame:
    """``topic, value, properties``; no properties column value for an empty map."""
    return df.select(
        "topic",
        F.col("payload").alias("value"),
        F.when(F.size("attributes") > 0, F.col("attributes")).alias("properties"),
    )


def gcp(df: DataFrame, project: str) -> DataFrame:
    """``topic`` as full resource name, ``data, attributes``."""
    return df.select(
        F.concat(F.lit(f"projects/{project}/topics/"), F.col("topic")).alias("topic"),
        F.col("payload").alias("data"),
        "attributes",
    )
