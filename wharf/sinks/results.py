"""Publish results of the four backends in one shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wharf.schemas import RESULT


def _shape(df: DataFrame, backend: str, message_id: Column, **known: Column) -> DataFrame:
    values = {"backend": F.lit(backend), "message_id": message_id, "topic": F.col("topic"), **known}
    return df.select(
        *[
            values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in RESULT
        ]
    )


def kafka(df: DataFrame) -> DataFrame:
    """From ``id, topic, partition, offset, timestamp``; the message keeps its own id."""
    return _shape(
        df,
        "kafka",
        F.col("id"),
        partition=F.col("partition"),
        offset=F.col("offset"),
        timestamp=F.col("timestamp"),
    )


def kinesis(df: DataFrame) -> DataFrame:
    """From ``topic, shard_id, sequence_number``."""
    return _shape(
        df,
        "kinesis",
        F.concat_ws(":", "shard_id", "sequence_number"),
        shard_id=F.col("shard_id"),
        sequence_number=F.col("sequence_number"),
    )


def pulsar(df: DataFrame) -> DataFrame:
    """From ``topic, broker_id``."""
    return _shape(df, "pulsar", F.concat_ws("-", "topic", "broker_id"))


def gcp(df: DataFrame) -> DataFrame:
    """From ``topic, broker_id``."""
    return _shape(df, "gcp", F.col("broker_id"))


def combined(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)
