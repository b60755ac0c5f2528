"""The end offsets of running queries as a table, and new queries that start from it.

A checkpoint folder belongs to one query for its life. To move a query (another checkpoint, another
cluster, a changed plan) its offsets are exported while it runs and given to the new one as start
options. An export lags behind the query by at most the micro-batch that is running, so what is
restored may come twice and is never lost.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from wharf.sources import positions

#: One row for each source of a query: where its last finished micro-batch ended.
EXPORTED = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("source_no", T.IntegerType()),
        T.StructField("source", T.StringType()),
        T.StructField("end_offset", T.StringType()),
    ]
)


def _files(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def _rows(progress) -> list[dict]:
    """The rows of a progress; only its JSON text has the offsets as they are."""
    told = json.loads(progress.json)
    return [
        {
            "query": told["name"] or told["id"],
            "run": told["runId"],
            "batch_id": told["batchId"],
            "source_no": n,
            "source": source["description"],
            "end_offset": json.dumps(source["endOffset"]),
        }
        for n, source in enumerate(told["sources"])
        if source.get("endOffset") is not None
    ]


def _write(folder: str, rows: list[dict]) -> None:
    """Replace what the table says of this query; the new file appears by a rename."""
    if not rows:
        return
    files, root = _files(folder)
    files.create_dir(root, recursive=True)
    staged = f"{root}/_{uuid.uuid4().hex}"
    with files.open_output_stream(staged) as out:
        out.write("".join(json.dumps(row) + "\n" for row in rows).encode())
    name = uuid.uuid5(uuid.NAMESPACE_URL, rows[0]["query"]).hex
    files.move(staged, f"{root}/{name}.json")


class OffsetExport(StreamingQueryListener):
    """Keeps the table at ``folder`` up to date: register with ``spark.streams.addListener``.

    Every finished micro-batch of a query replaces its rows, so the table stays as small as the
    number of queries. Queries without a name go by their id. ``only`` leaves other names out.
    """

    def __init__(self, folder: str, only: set[str] | None = None) -> None:
        self.folder, self.only = folder, only

    def onQueryStarted(self, event) -> None:
        """Nothing is finished yet."""

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self.only is None or progress.name in self.only:
            _write(self.folder, _rows(progress))

    def onQueryIdle(self, event) -> None:
        """The offsets stay as they are."""

    def onQueryTerminated(self, event) -> None:
        """The offsets stay as they are."""


def export(query: StreamingQuery, folder: str) -> None:
    """The same for one query at this moment, from the last micro-batch it told of."""
    for progress in reversed(query.recentProgress):
        rows = _rows(progress)
        if rows:
            _write(folder, rows)
            return


def exported(spark: SparkSession, folder: str) -> DataFrame:
    """The table of end offsets; empty before the first micro-batch."""
    files, root = _files(folder)
    files.create_dir(root, recursive=True)
    return spark.read.schema(EXPORTED).json(folder)


def kafka_checkpoints(offsets: DataFrame) -> DataFrame:
    """``query, topic, part, checkpoint`` (the last offset that was read) of Kafka sources.

    A partition of which nothing was read (its end is offset 0) has no checkpoint.
    """
    ends = F.from_json("end_offset", "map<string,map<string,bigint>>")
    topics = offsets.where(F.col("source").startswith("Kafka")).select("query", F.explode(ends).alias("topic", "parts"))
    parts = topics.select("query", "topic", F.explode("parts").alias("part", "end"))
    return parts.where(F.col("end") > 0).select("query", "topic", "part", (F.col("end") - 1).cast("string").alias("checkpoint"))


def kafka_options(offsets: DataFrame, query: str) -> dict[str, str]:
    """Start options for a Kafka scan that goes on where the query ended."""
    own = kafka_checkpoints(offsets).where(F.col("query") == query)
    return positions.kafka_start_options(positions.kafka_restored(own))


def log_options(offsets: DataFrame, query: str) -> dict[str, str]:
    """Start options for a stream of the segment log: its places, and the turn of its pulls."""
    found = offsets.where((F.col("query") == query) & F.col("end_offset").contains('"pull"')).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{query} has {len(found)} exported segment logs, not one")
    return {"resume": found[0].end_offset}
