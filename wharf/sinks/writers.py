"""Writers for the backbone and for deployed connectors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from wharf.sinks import rows


def land(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write messages below one folder per topic.

    The rebalance hint lets adaptive execution split a hot topic over several files and pack
    small topics together, instead of every task writing a file for every topic.
    """
    df.hint("rebalance", "topic").write.mode(mode).partitionBy("topic").parquet(path)


def land_stream(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """The same for a stream; ``path`` belongs to this one query.

    Each micro-batch has a folder of its own there (``batch_id``, read as a column), so a
    replayed one replaces what it wrote.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        land(batch, f"{path}/batch_id={batch_id}", "overwrite")

    return df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)


def kafka_stream(
    df: DataFrame, options: Mapping[str, str], checkpoint: str
) -> DataStreamWriter:
    """Every row goes to the topic in its own ``topic`` column; needs the Kafka connector."""
    return (
        rows.kafka(df)
        .writeStream.format("kafka")
        .options(**{**options, "includeHeaders": "true"})
        .option("checkpointLocation", checkpoint)
    )


def kafka_table(df: DataFrame, options: Mapping[str, str]) -> None:
    rows.kafka(df).write.format("kafka").options(**{**options, "includeHeaders": "true"}).save()


def deployed_stream(
    df: DataFrame, form: str, options: Mapping[str, str], checkpoint: str
) -> DataStreamWriter:
    """Any connector on the class path, by its format name; ``df`` in that broker's row shape."""
    return (
        df.writeStream.format(form).options(**options).option("checkpointLocation", checkpoint)
    )
