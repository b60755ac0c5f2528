"""Reading a segment log: batch scans with pushed filters, and streams with fair admission.

``spark.dataSource.register(MessageLog)`` makes the format ``message_log`` known; ``path`` is a
folder that :mod:`wharf.sinks.log` writes. Plans are made from the index, one small row for each
segment; tasks open the segments they were given, each for a range of positions.

*Batch.* Filters on topic, partition, position and arrival are pushed into the plan. Start positions
(a default and overrides for partitions, as :mod:`wharf.sources.positions` has them) are options.
Segments that neither can reach are never opened; so are those of closed partitions whose end lies
before a start by time, and all that is there for a start at the end.

*Stream.* A micro-batch is one pull: each of n topics yields at most max(1, budget / n) rows and all
together at most ``budget``; topics are visited in turn from number ``pull mod n``, and an unused
share stays unused. The offset holds the place reached in each topic and the number of the pull, so
the rotation goes on where it was after a restart. Spark hands its last offset to no reader: name
the query's checkpoint folder in the option ``checkpoint``, and the reader finds it there.
Positions must be unique within a topic, and grow as the log does. A pull that finds nothing is not
counted, and makes no micro-batch. With ``availableNow`` a run is one pull.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark import cloudpickle
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

from wharf.sources.positions import (
    AFTER_SEQUENCE_NUMBER,
    AT_SEQUENCE_NUMBER,
    AT_TIMESTAMP,
    LATEST,
    TRIM_HORIZON,
    Start,
)

# Readers run in Python workers, which need no copy of the library.
for _module in (__name__, Start.__module__):
    cloudpickle.register_pickle_by_value(sys.modules[_module])

LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
DDL = (
    "topic string, part string, pos bigint, id string, payload binary, "
    "attributes map<string,string>, arrived_at timestamp_ntz"
)


@dataclass(frozen=True)
class Segment:
    """One row of the index."""

    topic: str | None
    part: str | None
    file: str
    first: int
    last: int
    rows: int
    first_at: datetime | None
    last_at: datetime | None


@dataclass(frozen=True)
class Slice(InputPartition):
    """The rows of a segment with ``low <= pos <= high`` that arrived at ``since`` or later."""

    topic: str | None
    part: str | None
    file: str
    low: int
    high: int
    since: datetime | None = None


def options_of(default: Start, overrides: Mapping[tuple[str, str], Start] | None = None) -> dict[str, str]:
    """Start positions as options; overrides are by (topic, part)."""
    own = [[topic, part, asdict(start)] for (topic, part), start in (overrides or {}).items()]
    return {"start": json.dumps(asdict(default)), "overrides": json.dumps(own)}


def _files(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def _table(path: str, columns: Sequence[str]) -> list[dict]:
    """The rows of a small folder of Parquet files; nothing if it is not there."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    files, root = _files(path)
    rows: list[dict] = []
    for info in files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        if info.type == fs.FileType.File and info.base_name.endswith(".parquet"):
            rows += pq.read_table(info.path, filesystem=files, columns=list(columns), partitioning=None).to_pylist()
    return rows


def segments(path: str) -> list[Segment]:
    """The rows of the index, each segment once."""
    names = list(Segment.__dataclass_fields__)
    return list({row["file"]: Segment(**row) for row in _table(f"{path}/index", names)}.values())


def closed_parts(path: str) -> dict[tuple, datetime]:
    rows = _table(f"{path}/closed", ["topic", "part", "closed_at"])
    return {(r["topic"], r["part"]): r["closed_at"] for r in rows if r["closed_at"] is not None}


def first_slices(
    known: Sequence[Segment],
    default: Start,
    overrides: Mapping[tuple[str, str], Start],
    closed: Mapping[tuple, datetime],
) -> list[Slice]:
    """What is to be read from the start positions on, one slice for each segment they reach."""
    out = []
    for s in known:
        start = overrides.get((s.topic, s.part), default)
        low, since = LOWEST, None
        if start.kind == LATEST:
            continue
        if start.kind == AT_TIMESTAMP:
            since = datetime.fromisoformat(start.timestamp)
            ended = closed.get((s.topic, s.part))
            # As with shards: overrides keep every partition readable.
            if not overrides and ended is not None and ended <= since:
                continue
            if s.last_at is None or s.last_at < since:
                continue
            if s.first_at >= since:
                since = None
        elif start.kind == AT_SEQUENCE_NUMBER:
            low = int(start.sequence)
        elif start.kind == AFTER_SEQUENCE_NUMBER:
            low = int(start.sequence) + 1
        if s.last >= low:
            out.append(Slice(s.topic, s.part, s.file, max(low, s.first), s.last, since))
    return out


def read_slice(part: Slice) -> Iterator:
    """Record batches of one slice, the columns of the log in order."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.dataset as ds

    files, path = _files(part.file)
    wanted = (pc.field("pos") >= part.low) & (pc.field("pos") <= part.high)
    if part.since is not None:
        wanted &= pc.field("arrived_at") >= pa.scalar(part.since, pa.timestamp("us"))
    columns = ["pos", "id", "payload", "attributes", "arrived_at"]
    for batch in ds.dataset(path, filesystem=files, format="parquet", partitioning=None).to_batches(
        columns=columns, filter=wanted
    ):
        if batch.num_rows:
            place = [pa.array([value] * batch.num_rows, pa.string()) for value in (part.topic, part.part)]
            names = ["topic", "part", *columns]
            yield pa.RecordBatch.from_arrays([*place, *(batch.column(c) for c in columns)], names)


class LogReader(DataSourceReader):
    """A batch scan from the start positions, narrowed by what filters say."""

    def __init__(self, path: str, default: Start, overrides: Mapping[tuple[str, str], Start]):
        self.path, self.default, self.overrides = path, default, overrides
        #: Allowed values by column, and the range of positions and of arrival times.
        self.among: dict[str, set] = {}
        self.low, self.high = LOWEST, HIGHEST
        self.after: datetime | None = None
        self.before: datetime | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name in ("topic", "part") and isinstance(f, (EqualTo, EqualNullSafe, In)):
                self._keep(name, set(f.value) if isinstance(f, In) else {f.value})
            elif name == "pos" and self._bound(f):
                pass
            else:
                if name == "arrived_at":
                    self._arrival(f)
                yield f  # Spark evaluates it as well

    def _keep(self, name: str, values: set) -> None:
        self.among[name] = self.among.get(name, values) & values

    def _bound(self, f: Filter) -> bool:
        if isinstance(f, EqualTo):
            self.low, self.high = max(self.low, f.value), min(self.high, f.value)
        elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            self.low = max(self.low, f.value + isinstance(f, GreaterThan))
        elif isinstance(f, (LessThan, LessThanOrEqual)):
            self.high = min(self.high, f.value - isinstance(f, LessThan))
        else:
            return False
        return True

    def _arrival(self, f: Filter) -> None:
        """Narrow the segments only: rows at the edge are left to Spark."""
        value = getattr(f, "value", None)
        if not isinstance(value, datetime):
            return
        value = value.replace(tzinfo=None)
        if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
            self.after = value if self.after is None else max(self.after, value)
        if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
            self.before = value if self.before is None else min(self.before, value)

    def partitions(self) -> list[Slice]:
        known = [
            s
            for s in segments(self.path)
            if all(getattr(s, name) in values for name, values in self.among.items())
            and s.first <= self.high
            and s.last >= self.low
            and not (self.after and (s.last_at is None or s.last_at < self.after))
            and not (self.before and (s.first_at is None or s.first_at > self.before))
        ]
        out = []
        for part in first_slices(known, self.default, self.overrides, closed_parts(self.path)):
            low, high = max(part.low, self.low), min(part.high, self.high)
            if low <= high:
                out.append(Slice(part.topic, part.part, part.file, low, high, part.since))
        # Spark asks for a partition at least; this one has no segment.
        return out or [Slice(None, None, "", 1, 0)]

    def read(self, partition: Slice) -> Iterator:
        return read_slice(partition) if partition.file else iter(())


def taken(order: Sequence[str], waiting: Mapping[str, int], budget: int) -> dict[str, int]:
    """Rows that each topic yields in one pull, in visiting order; ``waiting`` is what it has."""
    share, left, out = max(1, budget // len(order)), budget, {}
    for topic in order:
        out[topic] = min(share, left, waiting.get(topic, 0))
        left -= out[topic]
    return out


class LogStreamReader(DataSourceStreamReader):
    """Pulls with a fair budget; the offset is ``{"log", "pull", "at": {topic: last position}}``."""

    def __init__(
        self,
        path: str,
        topics: Sequence[str],
        budget: int,
        checkpoint: str,
        default: Start,
        overrides: Mapping[tuple[str, str], Start],
        resume: dict | None = None,
    ):
        if budget <= 0 or not topics:
            raise ValueError(f"a pull needs topics and a budget over 0, got {list(topics)} and {budget}")
        if not checkpoint:
            raise ValueError("name the checkpoint folder of the query in the option checkpoint")
        self.path, self.topics, self.budget, self.checkpoint = path, list(dict.fromkeys(topics)), budget, checkpoint
        self.default, self.overrides, self.resume = default, overrides, resume
        self.places: dict[str, list[int]] = {}

    def initialOffset(self) -> dict:
        """Before the first row that the start positions reach, in each topic; ``resume`` goes before them."""
        known = [s for s in segments(self.path) if s.topic in self.topics]
        at = {}
        for topic in self.topics:
            own = [s for s in known if s.topic == topic]
            slices = first_slices(own, self.default, self.overrides, closed_parts(self.path))
            firsts = [self._first(part) for part in sorted(slices, key=lambda p: p.low)]
            firsts = [f for f in firsts if f is not None]
            at[topic] = min(firsts) - 1 if firsts else max((s.last for s in own), default=LOWEST)
        if self.resume is None:
            return {"log": self.path, "pull": 0, "at": at}
        reached = {t: p for t, p in self.resume["at"].items() if t in at}
        return {"log": self.path, "pull": self.resume["pull"], "at": {**at, **reached}}

    @staticmethod
    def _first(part: Slice) -> int | None:
        if part.since is None:
            return part.low
        return min((min(b.column("pos").to_pylist()) for b in read_slice(part)), default=None)

    def last_planned(self) -> dict | None:
        """The offset of the newest micro-batch in the query's own log."""
        from pyarrow import fs

        files, root = _files(f"{self.checkpoint}/offsets")
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        numbers = [int(i.base_name) for i in found if i.base_name.isdigit()]
        if not numbers:
            return None
        with files.open_input_stream(f"{root}/{max(numbers)}") as file:
            lines = file.read().decode().splitlines()
        for line in lines[2:]:
            offset = json.loads(line) if line.startswith("{") else {}
            if offset.get("log") == self.path:
                return offset
        return None

    def latestOffset(self) -> dict:
        start = self.last_planned() or self.initialOffset()
        known = [s for s in segments(self.path) if s.topic in self.topics]
        waiting = {t: [s for s in known if s.topic == t and s.last > start["at"].get(t, LOWEST)] for t in self.topics}
        share = max(1, self.budget // len(self.topics))
        ahead = {t: self._ahead(own, start["at"].get(t, LOWEST), share) for t, own in waiting.items()}
        first = start["pull"] % len(self.topics)
        order = self.topics[first:] + self.topics[:first]
        counts = taken(order, {t: len(p) for t, p in ahead.items()}, self.budget)
        if not any(counts.values()):
            return start
        at = {**start["at"], **{t: ahead[t][n - 1] for t, n in counts.items() if n}}
        return {"log": self.path, "pull": start["pull"] + 1, "at": at}

    def _ahead(self, own: Sequence[Segment], at: int, share: int) -> list[int]:
        """The next ``share`` positions after ``at``, from the positions of as few segments as it takes."""
        found: list[int] = []
        for s in sorted(own, key=lambda s: s.first):
            if len(found) >= share and s.first > found[share - 1]:
                break
            found = sorted([*found, *(p for p in self._positions(s) if p > at)])
        for file in [f for f in self.places if all(s.file != f for s in own)][: len(self.places) // 2]:
            del self.places[file]
        return found[:share]

    def _positions(self, s: Segment) -> list[int]:
        if s.file not in self.places:
            import pyarrow.parquet as pq

            files, path = _files(s.file)
            self.places[s.file] = sorted(
                pq.read_table(path, filesystem=files, columns=["pos"], partitioning=None)["pos"].to_pylist()
            )
        return self.places[s.file]

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        out = []
        for s in segments(self.path):
            if s.topic not in end["at"]:
                continue
            low, high = start["at"].get(s.topic, LOWEST) + 1, end["at"][s.topic]
            if s.first <= high and s.last >= low:
                out.append(Slice(s.topic, s.part, s.file, max(low, s.first), min(high, s.last)))
        return out

    def read(self, partition: Slice) -> Iterator:
        return read_slice(partition)

    def commit(self, end: dict) -> None:
        """Nothing to do: segments stay, and the checkpoint knows the offset."""


class MessageLog(DataSource):
    """Format ``message_log``.

    Options: ``path``; ``start`` and ``overrides`` (see :func:`options_of`; default: all); for
    streams ``topics`` (a JSON list), ``budget``, ``checkpoint`` and, for a new checkpoint that goes on
    where another query ended, ``resume``, its end offset.
    """

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return DDL

    def _starts(self) -> tuple[Start, dict[tuple[str, str], Start]]:
        default = Start(**json.loads(self.options["start"])) if "start" in self.options else Start(TRIM_HORIZON)
        own = json.loads(self.options.get("overrides", "[]"))
        return default, {(topic, part): Start(**start) for topic, part, start in own}

    def reader(self, schema: StructType) -> DataSourceReader:
        return LogReader(self.options["path"], *self._starts())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return LogStreamReader(
            self.options["path"],
            json.loads(self.options["topics"]),
            int(self.options["budget"]),
            self.options.get("checkpoint", ""),
            *self._starts(),
            json.loads(self.options["resume"]) if "resume" in self.options else None,
        )
