"""A live ack ledger whose work depends on what arrives, not on what is in flight.

:class:`wharf.streaming.ledgers.AckLedger` rewrites all open rows in every micro-batch. Here they lie
in keyed state, cut into blocks of offsets: (topic, partition, offset // span). A micro-batch reads and
writes only the blocks that its rows fall into, and the blocks of a hot partition are dealt to many
tasks. Each touched block sends a summary, how far its rows are acked and by which acks. Summaries of
the blocks that are not committed yet are a small table, one row for up to ``span`` messages; along it
the prefix of every partition is found.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wharf.operators import delivery
from wharf.plans.running import SPAN, Running, block_of, running
from wharf.session import settle
from wharf.streaming import batches
from wharf.streaming.ledgers import _COMMITS, _REFUSED, _Ledger

# The processor runs in Python workers, which need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Offsets of one block of state, the most rows that one key holds.
BLOCK = 4096
UNACKED = -1

_KEY = [T.StructField("topic", T.StringType()), T.StructField("part", T.StringType())]
_STEPS = T.ArrayType(
    T.StructType([T.StructField("ack", T.LongType()), T.StructField("off", T.LongType())])
)

#: A block as it is now, how far its acked prefix has come in this micro-batch, and refused acks.
_TOLD = T.StructType(
    [
        *_KEY,
        T.StructField("block", T.LongType()),
        T.StructField("whole", T.BooleanType()),
        T.StructField("steps", _STEPS),
        T.StructField("in_flight", T.LongType()),
        T.StructField(
            "refused",
            T.ArrayType(
                T.StructType([T.StructField("ack", T.LongType()), T.StructField("id", T.StringType())])
            ),
        ),
    ]
)

_SUMMARY = T.StructType(_TOLD.fields[:6])


@dataclass
class Open:
    """One block: the end of its acked prefix, the latest ack in it, and what lies behind it."""

    low: int = UNACKED
    peak: int = UNACKED
    offs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    acks: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def apply(self, delivered: list[int], acked: list[tuple[int, int, str]]) -> list[tuple[int, str]]:
        """Take deliveries, then acks (seq, offset, id) in their order; returns the refused ones."""
        held = dict(zip(self.offs.tolist(), self.acks.tolist()))
        for off in delivered:
            if off > self.low:
                held.setdefault(off, UNACKED)
        refused = []
        for seq, off, id_ in sorted(acked):
            if held.get(off) == UNACKED:
                held[off] = seq
            else:
                refused.append((seq, id_))
        self.offs = np.array(sorted(held), np.int64)
        self.acks = np.array([held[off] for off in self.offs.tolist()], np.int64)
        return refused

    def advance(self) -> list[tuple[int, int]]:
        """Drop the rows that the prefix has come to; each ack that took it further, and how far."""
        stop = np.flatnonzero(self.acks == UNACKED)
        n = int(stop[0]) if len(stop) else len(self.acks)
        if not n:
            return []
        latest = np.maximum(np.maximum.accumulate(self.acks[:n]), self.peak)
        last = np.flatnonzero(np.append(latest[1:] != latest[:-1], True))
        steps = [(int(latest[i]), int(self.offs[i])) for i in last]
        self.peak, self.low = steps[-1]
        self.offs, self.acks = self.offs[n:], self.acks[n:]
        return steps


class _Block(StatefulProcessor):
    """One block of one partition."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("open", "low bigint, peak bigint, offs binary, acks binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        block = Open()
        if self.state.exists():
            low, peak, offs, acks = self.state.get()
            block = Open(low, peak, np.frombuffer(offs, np.int64), np.frombuffer(acks, np.int64))
        delivered: set[int] = set()
        acked: list[tuple[int, int, str]] = []
        for frame in rows:
            is_ack = frame["kind"] == "ack"
            delivered.update(frame.loc[~is_ack, "off"].tolist())
            said = frame[is_ack]
            acked += zip(said["ack_seq"].astype("int64").tolist(), said["off"].tolist(), said["id"].tolist())
        refused = block.apply(sorted(delivered), acked)
        steps = block.advance()
        self.state.update((block.low, block.peak, block.offs.tobytes(), block.acks.tobytes()))
        topic, part, number = key
        yield pd.DataFrame(
            {
                "topic": [topic],
                "part": [part],
                "block": [number],
                "whole": [not len(block.offs)],
                "steps": [[{"ack": ack, "off": off} for ack, off in steps]],
                "in_flight": [int((block.acks == UNACKED).sum())],
                "refused": [[{"ack": seq, "id": id_} for seq, id_ in refused]],
            }
        )

    def close(self) -> None:
        """Nothing is held outside the state."""


class BlockLedger(_Ledger):
    """Commits each acked prefix as soon as it is whole, with keyed state for what is in flight.

    The stream has ``kind`` (delivered or ack), ``id`` and ``ack_seq``; ids are those of a Kafka scan
    (topic, partition, offset), so an ack tells its place by itself. Within a partition rows are
    delivered in the order of their offsets, and acks come in the order of ``ack_seq``. A row that
    is committed stays so when it is delivered again, and a second ack of it is refused; so are acks
    of ids that are no place of a record. Needs the RocksDB state store (see :func:`configure`).

    A block that is committed in full keeps two numbers of state.
    """

    def __init__(self, spark: SparkSession, folder: str, span: int = BLOCK, run: int = SPAN) -> None:
        super().__init__(spark, folder)
        self.span, self.run = span, run

    def start(self, stream: DataFrame, trigger: Mapping[str, object]) -> StreamingQuery:
        tail = F.substring_index("id", "-", -2)
        off = F.expr("try_cast(substring_index(id, '-', -1) AS bigint)")
        topic = F.expr("left(id, greatest(length(id) - length(substring_index(id, '-', -2)) - 1, 0))")
        placed = stream.select(
            topic.alias("topic"),
            F.substring_index(tail, "-", 1).alias("part"),
            "kind",
            "id",
            F.coalesce(off, F.lit(UNACKED).cast("bigint")).alias("off"),
            F.coalesce(F.col("ack_seq").cast("bigint"), F.lit(UNACKED).cast("bigint")).alias("ack_seq"),
        ).withColumn("block", block_of(F.col("off"), self.span))
        told = placed.groupBy("topic", "part", "block").transformWithStateInPandas(
            statefulProcessor=_Block(), outputStructType=_TOLD, outputMode="Update", timeMode="None"
        )
        return (
            told.writeStream.foreachBatch(self.process)
            .outputMode("update")
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .trigger(**trigger)
            .start()
        )

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Merge the told blocks into the summaries, and commit what the prefixes have come to."""
        base, place = f"{self.folder}/blocks", ["topic", "part"]
        names = _SUMMARY.fieldNames()
        told = settle(batch)  # read three times; the state is not asked again
        before = batches.get(self.spark, base, batch_id - 1, _SUMMARY)
        both = before.select(F.lit(0).alias("turn"), *names).unionByName(
            told.select(F.lit(1).alias("turn"), *names)
        )
        # At most two rows for a block: as it was, with the steps not committed yet, and as it is.
        summaries = settle(
            both.groupBy(*place, "block").agg(
                F.max_by("whole", "turn").alias("whole"),
                F.flatten(F.sort_array(F.collect_list(F.struct("turn", "steps"))).steps).alias("steps"),
                F.max_by("in_flight", "turn").alias("in_flight"),
            )
        )
        latest = F.array_max("steps.ack")
        along = running(
            summaries,
            place,
            "block",
            {
                "before": Running("min", F.col("whole").cast("int"), exclusive=True),
                "carry": Running("max", latest, exclusive=True),
            },
            self.run,
        )
        along = settle(along.withColumn("reached", F.coalesce(F.col("before") == 1, F.lit(True))))
        step = along.where("reached").select(*place, "carry", F.explode("steps").alias("s"))
        freed = step.groupBy(*place, F.greatest("carry", "s.ack").alias("at_ack")).agg(
            (F.max("s.off") + 1).alias("commit_offset")
        )
        batches.put(freed.select(*_COMMITS.fieldNames()), f"{self.folder}/commits", batch_id)
        # The block that a prefix has come to keeps its last step, as it was committed; what lies
        # behind waits with all of its steps.
        last = F.struct(F.greatest("carry", latest).alias("ack"), F.array_max("steps.off").alias("off"))
        kept = F.when(F.size("steps") > 0, F.array(last)).otherwise(F.array()).cast(_STEPS)
        left = along.where(~(F.col("reached") & F.col("whole"))).withColumn(
            "steps", F.when(F.col("reached"), kept).otherwise(F.col("steps"))
        )
        batches.put(left.select(*names), base, batch_id)
        refused = told.select(F.explode("refused").alias("r")).select(
            F.col("r.id").alias("id"), F.col("r.ack").alias("ack_seq")
        )
        said = refused.withColumn("message", delivery.refusal(F.col("id")))
        batches.put(said.select(*_REFUSED.fieldNames()), f"{self.folder}/refused", batch_id)
        batches.forget(self.spark, base, batch_id - 2)
        self.fold(batch_id, commits=_COMMITS, refused=_REFUSED)

    def commits(self) -> DataFrame:
        rows = batches.everything(self.spark, f"{self.folder}/commits", _COMMITS)
        return rows.groupBy(*delivery.PARTITION, "at_ack").agg(F.max("commit_offset").alias("commit_offset"))

    def refused(self) -> DataFrame:
        return batches.everything(self.spark, f"{self.folder}/refused", _REFUSED).drop("batch_id")

    def in_flight(self) -> DataFrame:
        """``topic, part, in_flight`` of the partitions with blocks that are not committed."""
        base = f"{self.folder}/blocks"
        rows = batches.get(self.spark, base, batches.newest(self.spark, base), _SUMMARY)
        return rows.groupBy("topic", "part").agg(F.sum("in_flight").alias("in_flight"))


def configure(spark: SparkSession) -> SparkSession:
    """The state store that keyed ledgers need."""
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    return spark
