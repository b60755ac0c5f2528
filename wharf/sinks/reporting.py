"""A stream writer that sends requests of a bounded size and lands the outcome of every entry.

Spark's own writers say only whether a task failed. A broker's batch call says it for each entry, and
a failed entry fails neither its siblings nor the query: what becomes of it is for the breaker, the
batch results and a retry to decide, all of which read a table of outcomes. This writer makes it.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

from wharf.sinks.batches import ENTRY_FAILED, MAX_RECORDS_PER_PUT

# Writers run in Python workers, which need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Columns of a row to publish: the registration, the place in its batch, the message id, the
#: stream it goes to, its partition key and its bytes.
ENTRY = T.StructType(
    [
        T.StructField("reg", T.StringType()),
        T.StructField("idx", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("data", T.BinaryType()),
    ]
)

#: Columns of the landed outcomes; ``batch_no`` is the micro-batch.
OUTCOME = T.StructType(
    [
        T.StructField("reg", T.StringType()),
        T.StructField("idx", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("error", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("sequence_number", T.StringType()),
        T.StructField("batch_no", T.LongType()),
    ]
)

#: Outcomes that a task holds before it writes them out.
HELD = 16_384


@dataclass(frozen=True)
class Sent:
    """What a broker says about one entry: its place, or an error code and text."""

    shard_id: str | None = None
    sequence_number: str | None = None
    error_code: str | None = None
    error_message: str | None = None


#: One request: the stream and its entries (key, data), in order; one answer for each. A call that
#: raises fails all its entries.
Send = Callable[[str, Sequence[tuple[str, bytes]]], Sequence[Sent]]


@dataclass
class Landed(WriterCommitMessage):
    """What a task has written: a file of outcomes, and how many there are of either kind."""

    file: str
    ok: int
    failed: int


def _files(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def outcomes_of(send: Send, stream: str, entries: Sequence[tuple]) -> list[tuple]:
    """Send one request of ``(reg, idx, id, key, data)`` and say what became of each entry."""
    try:
        answers = list(send(stream, [(key, data) for *_, key, data in entries]))
        if len(answers) != len(entries):
            raise ValueError(f"{len(answers)} answers to {len(entries)} entries")
    except Exception as error:  # noqa: BLE001 - the whole call failed, and so did each of its entries
        return [(reg, idx, id_, stream, False, str(error), None, None) for reg, idx, id_, *_ in entries]
    out = []
    for (reg, idx, id_, *_), said in zip(entries, answers):
        if said.error_code is None:
            out.append((reg, idx, id_, stream, True, None, said.shard_id, said.sequence_number))
        else:
            text = "null" if said.error_message is None else said.error_message
            out.append((reg, idx, id_, stream, False, f"{ENTRY_FAILED}{said.error_code}: {text}", None, None))
    return out


class ReportingWriter(DataSourceStreamArrowWriter):
    """Requests per stream in the order of the rows; outcomes land when the micro-batch is committed.

    Tasks write their outcomes to files of their own, and the driver learns the names. At the
    commit all files of a micro-batch become visible together, by the renaming of one folder. A
    replay sends its entries again (delivery is at least once), but what a micro-batch has reported
    stands: the outcomes of a second commit of the same number are dropped.
    """

    def __init__(self, send: Send, folder: str, size: int):
        if not 0 < size <= MAX_RECORDS_PER_PUT:
            raise ValueError(f"a request takes 1 to {MAX_RECORDS_PER_PUT} records, got {size}")
        self.send, self.folder, self.size = send, folder, size

    def write(self, iterator: Iterator) -> Landed:
        import pyarrow as pa
        import pyarrow.parquet as pq

        shape = pa.schema(
            [
                ("reg", pa.string()),
                ("idx", pa.int64()),
                ("id", pa.string()),
                ("stream", pa.string()),
                ("ok", pa.bool_()),
                ("error", pa.string()),
                ("shard_id", pa.string()),
                ("sequence_number", pa.string()),
            ]
        )
        files, root = _files(self.folder)
        name = f"{root}/pending/{uuid.uuid4().hex}.parquet"
        files.create_dir(f"{root}/pending", recursive=True)
        open_requests: dict[str, list[tuple]] = {}
        held: list[tuple] = []
        counts = [0, 0]

        with pq.ParquetWriter(name, shape, filesystem=files) as writer:

            def land(least: int) -> None:
                if len(held) > least:
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*held), shape)]
                    writer.write_table(pa.Table.from_arrays(columns, schema=shape))
                    held.clear()

            def request(stream: str) -> None:
                made = outcomes_of(self.send, stream, open_requests.pop(stream))
                good = sum(row[4] for row in made)
                counts[0] += good
                counts[1] += len(made) - good
                held.extend(made)
                land(HELD)

            for batch in iterator:
                values = batch.to_pydict()
                rows = zip(*(values[c] for c in ("reg", "idx", "id", "stream", "key", "data")))
                for reg, idx, id_, stream, key, data in rows:
                    entries = open_requests.setdefault(stream, [])
                    entries.append((reg, idx, id_, key, data))
                    if len(entries) == self.size:
                        request(stream)
            for stream in list(open_requests):
                request(stream)
            land(0)
        return Landed(name, *counts)

    def commit(self, messages: list, batchId: int) -> None:
        from pyarrow import fs

        files, root = _files(self.folder)
        target = f"{root}/outcomes/batch_no={batchId}"
        if files.get_file_info(target).type != fs.FileType.NotFound:
            return self.abort(messages, batchId)
        staged = f"{root}/staged/{uuid.uuid4().hex}"
        files.create_dir(staged, recursive=True)
        files.create_dir(f"{root}/outcomes", recursive=True)
        for n, message in enumerate(m for m in messages if m is not None):
            if message.ok + message.failed:
                files.move(message.file, f"{staged}/part-{n:05d}.parquet")
            else:
                files.delete_file(message.file)
        files.move(staged, target)

    def abort(self, messages: list, batchId: int) -> None:
        from pyarrow import fs

        files, _ = _files(self.folder)
        for message in messages:
            if message is not None and files.get_file_info(message.file).type == fs.FileType.File:
                files.delete_file(message.file)


def reporting_sink(name: str, send: Send) -> type[DataSource]:
    """A format to register with ``spark.dataSource``: rows of ENTRY go out through ``send``.

    Options: ``outcomes``, the folder where they land, and ``size``, the entries of a request.
    """

    class ReportingSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def streamWriter(self, schema: T.StructType, overwrite: bool) -> ReportingWriter:
            missing = {"reg", "idx", "id", "stream", "key", "data"} - set(schema.names)
            if missing:
                raise ValueError(f"the stream needs the columns {sorted(missing)}")
            size = int(self.options.get("size", MAX_RECORDS_PER_PUT))
            return ReportingWriter(send, self.options["outcomes"], size)

    return ReportingSink


def reported(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """The landed outcomes, as a table or as a stream of what is committed from now on."""
    reader = spark.readStream if stream else spark.read
    _files_ready(folder)
    return reader.schema(OUTCOME).parquet(f"{folder}/outcomes")


def _files_ready(folder: str) -> None:
    """The folder of the outcomes exists before the first commit."""
    files, root = _files(folder)
    files.create_dir(f"{root}/outcomes", recursive=True)
