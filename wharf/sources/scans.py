"""Where records come from: landed logs, Kafka, or any other deployed format."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def landed(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    form: str = "parquet",
    stream: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A landed raw log, as a table or as a stream of newly arriving files."""
    reader = (spark.readStream if stream else spark.read).format(form)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**(options or {})).load(path)


def kafka_scan(
    spark: SparkSession, topics: list[str], options: Mapping[str, str], stream: bool = True
) -> DataFrame:
    """Kafka records of several topics, headers included; needs the Kafka connector."""
    fixed = {"subscribe": ",".join(sorted(set(topics))), "includeHeaders": "true"}
    reader = (spark.readStream if stream else spark.read).format("kafka")
    return reader.options(**{**options, **fixed}).load()


def deployed(
    spark: SparkSession, form: str, options: Mapping[str, str], stream: bool = True
) -> DataFrame:
    """Any connector on the class path, by its format name (Kinesis, Pulsar, Pub/Sub)."""
    return (spark.readStream if stream else spark.read).format(form).options(**options).load()
