"""A landed message log in segments, with an index of what each segment holds.

Segments lie at ``<path>/data`` below their topic and partition, and never change. ``<path>/index``
has one small row for each: readers plan from it and open no other file than they need.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Columns of a log row, in the order in which the reader gives them.
LOG = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("arrived_at", T.TimestampNTZType()),
    ]
)

INDEX = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("first_at", T.TimestampNTZType()),
        T.StructField("last_at", T.TimestampNTZType()),
    ]
)


def append(df: DataFrame, path: str, name: str | None = None) -> None:
    """Append the rows of ``df`` (columns of LOG) to the log at ``path``.

    Rows are dealt out by ranges of (topic, partition, position), so a hot partition becomes several
    segments, each a range of positions. An append with the ``name`` of an earlier one replaces it:
    give a micro-batch its number, and a replay leaves no copies. The index of an append is written
    after its segments; what is not in the index is not read.
    """
    name = name or uuid.uuid4().hex
    spark = df.sparkSession
    data = f"{path}/data/append={name}"
    order = ["topic", "part", "pos"]
    columns = [F.col(f.name).cast(f.dataType) for f in LOG]
    rows = df.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.mode("overwrite").partitionBy("topic", "part").parquet(data)
    segments = spark.read.schema(LOG).parquet(data)
    index = segments.groupBy("topic", "part", F.col("_metadata.file_path").alias("file")).agg(
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
        F.count("*").alias("rows"),
        F.min("arrived_at").alias("first_at"),
        F.max("arrived_at").alias("last_at"),
    )
    index.select(*INDEX.fieldNames()).coalesce(1).write.mode("overwrite").parquet(f"{path}/index/append={name}")


def close_parts(shards: DataFrame, path: str) -> None:
    """Say which partitions are closed (``topic, part, closed_at``; null: open); replaces what was said."""
    typed = shards.select("topic", "part", F.col("closed_at").cast("timestamp_ntz"))
    typed.coalesce(1).write.mode("overwrite").parquet(f"{path}/closed")


def index(spark: SparkSession, path: str) -> DataFrame:
    """One row for each segment."""
    # A segment is listed twice while its rows are being gathered.
    return spark.read.schema(INDEX).parquet(f"{path}/index").drop("append").dropDuplicates(["file"])


def gather_index(spark: SparkSession, path: str, leave: int = 2) -> int:
    """Put the index rows of older appends into one table; how many appends that were.

    A stream that appends per micro-batch adds an index folder each time. The ``leave`` newest stay as
    they are, since a replay may make them again. Readers take a segment once, however often it is
    listed, so they may read meanwhile, and a gathering that is cut short does no harm.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/index")
    files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    listed = [(s.getModificationTime(), s.getPath()) for s in files.listStatus(place)]
    appends = sorted((t, p.getName()) for t, p in listed if p.getName().startswith("append="))
    old = [name for _, name in appends[: max(len(appends) - leave, 0)]]
    if len(old) < 2:
        return 0
    paths = [f"{path}/index/{name}" for name in old]
    target = f"{path}/index/append=gathered-{uuid.uuid4().hex}"
    rows = spark.read.schema(INDEX).parquet(*paths).dropDuplicates(["file"])
    rows.coalesce(1).write.parquet(target)
    for name in old:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(place, name), True)
    return len(old)
