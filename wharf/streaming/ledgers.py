"""Live delivery ledgers: ack watermark, circuit breaker, contract check.

Each works in ``foreachBatch`` with the batch operators. What is still open at the end of a
micro-batch (unacked rows, the running streak) is a table in the shared folder, which the
next micro-batch reads; older ones are removed. So the work of a hot partition or registration spreads over the
cluster, where a keyed state processor would run it in one task, and a replayed micro-batch
starts from the same table and overwrites what it wrote.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from wharf.functions import digits
from wharf.operators import contracts, delivery, outcomes
from wharf.plans.joins import lookup
from wharf.plans.running import SPAN, Running
from wharf.schemas import MESSAGE, MESSAGE_COLUMNS, REQUIRED_FIELDS
from wharf.session import settle
from wharf.sources import positions
from wharf.streaming import batches

_OPEN = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("off", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("ack_seq", T.LongType()),
    ]
)

_COMMITS = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("at_ack", T.LongType()),
        T.StructField("commit_offset", T.LongType()),
    ]
)

_OPEN_SHARDS = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("pos", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("ack_seq", T.LongType()),
    ]
)

_WATERMARKS = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("at_ack", T.LongType()),
        T.StructField("checkpoint", T.StringType()),
    ]
)

_REFUSED = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("ack_seq", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)

_EPOCHS = T.StructType([T.StructField("epoch", T.LongType())])

_STREAKS = T.StructType(
    [
        T.StructField("reg", T.StringType()),
        T.StructField("batch_no", T.LongType()),
        T.StructField("first_ok", T.LongType()),
        T.StructField("first_fail", T.LongType()),
        T.StructField("any_ok", T.IntegerType()),
        T.StructField("fails", T.LongType()),
        T.StructField("carried", T.IntegerType()),
        T.StructField("closed", T.BooleanType()),
        T.StructField("streak", T.LongType()),
    ]
)


_LATE = T.StructType(
    [
        T.StructField("reg", T.StringType()),
        T.StructField("batch_no", T.LongType()),
        T.StructField("idx", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("error", T.StringType()),
    ]
)

_VIOLATION = T.StructType(
    [T.StructField("field_name", T.StringType()), T.StructField("reason", T.StringType())]
)


_CHECKED = T.StructType(
    [
        *MESSAGE.fields,
        T.StructField("violation", _VIOLATION),
        T.StructField("refused", T.IntegerType()),
    ]
)


class _Ledger:
    """Shared start-up of the ledgers: one folder, one checkpoint.

    What a ledger tells is kept per micro-batch; closed ones are folded together, ``every`` at a time.
    """

    every = batches.EVERY

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def fold(self, batch_id: int, **kinds: T.StructType) -> None:
        """Fold the tables of these kinds where enough micro-batches are closed."""
        for kind, schema in kinds.items():
            batches.fold(self.spark, f"{self.folder}/{kind}", batch_id, schema, self.every)

    def _passing(self, df: DataFrame, kind: str, batch_id: int) -> DataFrame:
        """``df``, computed once into a table that lasts as long as its micro-batch does, or its replay."""
        batches.put(df, f"{self.folder}/{kind}", batch_id)
        return batches.get(df.sparkSession, f"{self.folder}/{kind}", batch_id, df.schema)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        raise NotImplementedError

    def start(self, stream: DataFrame, trigger: Mapping[str, object]) -> StreamingQuery:
        return (
            stream.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .trigger(**trigger)
            .start()
        )


class AckLedger(_Ledger):
    """Commits each acked prefix as soon as it is whole.

    The stream has ``kind`` (delivered or ack), ``id, topic, part, off, ack_seq``. A message
    is delivered before it is acked; both may come in the same micro-batch. Acks come in the
    order of ``ack_seq``.

    The state is what is in flight: unacked rows, and one row without id for each run of acked
    rows that an unacked one holds up. A run is released by an ack later than all of its own,
    so its last offset and latest ack are all that counts. What a micro-batch writes thus
    grows with its own rows and the rows in flight, however long a row stays unacked.
    """

    keys = delivery.PARTITION
    position = "off"
    open_rows, released = _OPEN, _COMMITS

    def __init__(self, spark: SparkSession, folder: str, span: int = SPAN) -> None:
        super().__init__(spark, folder)
        self.span = span

    def process(self, batch: DataFrame, batch_id: int) -> None:
        # Read by the partitions, the fold and the refusals, a few columns each.
        self._process(self._passing(batch, "arrived", batch_id), batch_id)
        for kind in ("arrived", "folded", "prefixed"):
            batches.forget(self.spark, f"{self.folder}/{kind}", batch_id)

    def _process(self, batch: DataFrame, batch_id: int, stale: DataFrame | None = None) -> None:
        """Fold one micro-batch; ``stale`` are further acks that are refused."""
        spark, base = batch.sparkSession, f"{self.folder}/open"
        names = self.open_rows.fieldNames()
        before = batches.get(spark, base, batch_id - 1, self.open_rows)
        arrived = batch.where("kind = 'delivered'").select(
            *self.keys, self.position, "id", F.lit(None).cast("bigint").alias("ack_seq")
        )
        acks = batch.where("kind = 'ack'").select("id", "ack_seq")
        known = before.select(*names, F.col("id").isNull().alias("run")).unionByName(
            arrived.withColumn("run", F.lit(False))
        )
        # Partitions go by a number: numeric buffers keep the aggregate by id hash-based.
        seen = known.select(*self.keys).distinct()
        parts = settle(seen.withColumn("number", F.monotonically_increasing_id()))
        placed = lookup(known, parts, self.keys, null_safe=True).drop(*self.keys)
        runs = placed.where("run").drop("run")
        # Per id the open row, repeated deliveries and all acks fold into one row; without a
        # delivery it has no number.
        folded = (
            placed.where("NOT run")
            .drop("run")
            .unionByName(acks, allowMissingColumns=True)
            .groupBy("id")
            .agg(
                *[F.min(c).alias(c) for c in ("number", self.position, "ack_seq")],
                F.max("ack_seq").alias("last_ack"),
            )
        )
        folded = self._passing(folded, "folded", batch_id)
        # An acked row goes on without its id.
        held = folded.where(F.col("number").isNotNull()).drop("last_ack")
        held = held.withColumn("id", F.when(F.col("ack_seq").isNull(), F.col("id")))
        # Rows between the same unacked ones share a gap number.
        gap = Running("sum", F.col("ack_seq").isNull().cast("int"))
        ledger = self.numbered(held.unionByName(runs))
        rows = delivery.with_prefix(ledger, self.span, {"gap": gap}, ["number"])
        rows = self._passing(rows, "prefixed", batch_id)
        freed = lookup(self.commits_of(rows), parts, ["number"])
        batches.put(freed.select(*self.released.fieldNames()), f"{self.folder}/commits", batch_id)
        held_up = rows.where(~F.col("in_prefix"))
        run = (
            held_up.where(F.col("ack_seq").isNotNull())
            .groupBy("number", "gap")
            .agg(
                F.max_by(self.position, "off").alias(self.position),
                F.max("ack_seq").alias("ack_seq"),
            )
            .withColumn("id", F.lit(None).cast("string"))
        )
        own = ["number", self.position, "id", "ack_seq"]
        unacked = held_up.where(F.col("ack_seq").isNull())
        still = lookup(unacked.select(*own).unionByName(run.select(*own)), parts, ["number"])
        batches.put(still.select(*names), base, batch_id)

        strange = F.col("number").isNull()
        faulty = settle(
            folded.where(strange | (F.col("ack_seq") < F.col("last_ack"))).select(
                "id", strange.alias("strange"), F.col("ack_seq").alias("first_ack")
            )
        )
        late = lookup(acks, faulty, ["id"]).where("strange OR ack_seq > first_ack")
        refused = late.select("id", "ack_seq", delivery.refusal(F.col("id")).alias("message"))
        if stale is not None:
            refused = refused.unionByName(stale)
        batches.put(refused, f"{self.folder}/refused", batch_id)
        # A replay of this micro-batch starts from the last state; older ones are done with.
        batches.forget(spark, base, batch_id - 2)
        self.fold(batch_id, commits=self.released, refused=_REFUSED)

    def numbered(self, ledger: DataFrame) -> DataFrame:
        """The ledger with ``off``, a BIGINT in the order of the positions."""
        return ledger

    def commits_of(self, rows: DataFrame) -> DataFrame:
        return delivery.commits_of(rows, ["number"])

    def commits(self) -> DataFrame:
        rows = batches.everything(self.spark, f"{self.folder}/commits", _COMMITS)
        return rows.groupBy(*delivery.PARTITION, "at_ack").agg(
            F.max("commit_offset").alias("commit_offset")
        )

    def refused(self) -> DataFrame:
        """Acks of ids that were not in flight, acked before or never delivered."""
        return batches.everything(self.spark, f"{self.folder}/refused", _REFUSED).drop("batch_id")


class ShardLedger(AckLedger):
    """The same for Kinesis: moves a shard's checkpoint as soon as an acked prefix is whole.

    The stream has ``kind, id, part, pos, ack_seq``; ``pos`` is a digit string of any width. Open
    rows are dealt out by ranges of (shard, position) and numbered in that order, so a hot shard
    is sorted by many tasks.
    """

    keys = ["part"]
    position = "pos"
    open_rows, released = _OPEN_SHARDS, _WATERMARKS

    def numbered(self, ledger: DataFrame) -> DataFrame:
        order = ["number", "__pos"]
        ranged = ledger.withColumn("__pos", digits.order(F.col("pos"))).repartitionByRange(*order)
        placed = ranged.sortWithinPartitions(*order).drop("__pos")
        return settle(placed.withColumn("off", F.monotonically_increasing_id()))

    def commits_of(self, rows: DataFrame) -> DataFrame:
        return (
            rows.where("in_prefix")
            .groupBy("number", "at_ack")
            .agg(F.max_by("pos", "off").alias("checkpoint"))
        )

    def commits(self) -> DataFrame:
        """Every move of a checkpoint: ``part, at_ack, checkpoint``.

        An ack moves its shard once per micro-batch that it is read in; the furthest one counts.
        """
        rows = batches.everything(self.spark, f"{self.folder}/commits", _WATERMARKS)
        return rows.groupBy(*self.keys, "at_ack").agg(
            F.max(digits.order(F.col("checkpoint")))["digits"].alias("checkpoint")
        )

    def checkpoints(self) -> DataFrame:
        """The checkpoint of every shard that has one; rows delivered again never move it back."""
        return delivery.merge_checkpoints(self.commits().select("part", "checkpoint"))


class _Capped:
    """Adds sessions to an ack ledger: a cap on what is in flight, and a reset when it is reached.

    Rows of the stream have ``epoch``, the session they belong to: a delivery the one its consumer
    was in, an ack that of the delivery it answers. Sessions are numbered from 0.

    After each micro-batch the unacked rows are counted. If they reach ``cap`` (0: no cap), the
    session ends: every partition with something open is to be read again from its first open row
    (``seeks``), all that is open is forgotten, acks beyond the prefix included, and a new session
    begins. Rows of an older session count for nothing from then on: its deliveries come again, its
    acks are refused. Before it reads on, a consumer asks for the session and where to start:
    ``epoch()`` and ``starts()``.

    The session of a micro-batch is written last, so a replay finds the state it began with.
    """

    def __init__(self, spark: SparkSession, folder: str, cap: int = 0, span: int = SPAN) -> None:
        super().__init__(spark, folder, span)
        self.cap = cap

    def _epochs(self) -> DataFrame:
        return batches.everything(self.spark, f"{self.folder}/epochs", _EPOCHS)

    def epoch(self) -> int:
        """The session that deliveries belong to now."""
        return self._epochs().agg(F.max("epoch")).first()[0] or 0

    def _epoch_before(self, batch_id: int) -> int:
        row = batches.get(self.spark, f"{self.folder}/epochs", batch_id - 1, _EPOCHS).first()
        return row.epoch if row else 0

    def _process(self, batch: DataFrame, batch_id: int, stale: DataFrame | None = None) -> None:
        epoch = self._epoch_before(batch_id)
        own = F.col("epoch").eqNullSafe(F.lit(epoch))
        old = batch.where(~own & (F.col("kind") == "ack"))
        refused = old.select("id", "ack_seq", delivery.refusal(F.col("id")).alias("message"))
        super()._process(batch.where(own).drop("epoch"), batch_id, refused)
        base = f"{self.folder}/open"
        waiting = batches.get(self.spark, base, batch_id, self.open_rows)
        if 0 < self.cap <= waiting.where(F.col("id").isNotNull()).count():
            epoch += 1
            seeks = settle(self.first_open(waiting).withColumn("epoch", F.lit(epoch).cast("bigint")))
            batches.put(seeks, f"{self.folder}/seeks", batch_id)
            batches.put(self.spark.createDataFrame([], self.open_rows), base, batch_id)
        batches.put(
            self.spark.createDataFrame([(epoch,)], _EPOCHS), f"{self.folder}/epochs", batch_id
        )
        batches.forget(self.spark, f"{self.folder}/epochs", batch_id - 2)
        self.fold(batch_id, seeks=self._seek_shape())

    def _seek_shape(self) -> T.StructType:
        place = self.open_rows[self.position].dataType
        fields = [self.open_rows[k] for k in self.keys]
        return T.StructType(
            [*fields, T.StructField("seek_to", place), T.StructField("epoch", T.LongType())]
        )

    def first_open(self, waiting: DataFrame) -> DataFrame:
        """``keys, seek_to``: the first row of each partition that is not in its acked prefix."""
        return waiting.groupBy(*self.keys).agg(F.min(self.position).alias("seek_to"))

    def seeks(self) -> DataFrame:
        """``keys, seek_to, epoch``: where each partition was sent back to as a session began."""
        return batches.everything(self.spark, f"{self.folder}/seeks", self._seek_shape()).drop("batch_id")


class CappedAckLedger(_Capped, AckLedger):
    """An :class:`AckLedger` of one consumer with a cap on its unacked rows."""

    def starts(self) -> DataFrame:
        """Where the consumer reads on: ``topic, part, start_kind, start_ts, start_seq``.

        A partition that was sent back starts there, unless it has committed more since; others
        start after their last commit. Partitions without either are not moved.
        """
        reached = self.commits().select(*self.keys, F.col("commit_offset").alias("at"))
        sent = self.seeks().select(*self.keys, F.col("seek_to").alias("at"))
        ahead = reached.unionByName(sent).groupBy(*self.keys).agg(F.max("at").alias("at"))
        return ahead.select(
            *self.keys,
            F.lit(positions.AT_SEQUENCE_NUMBER).alias("start_kind"),
            F.lit(None).cast("timestamp_ntz").alias("start_ts"),
            F.col("at").cast("string").alias("start_seq"),
        )


class CappedShardLedger(_Capped, ShardLedger):
    """A :class:`ShardLedger` of one consumer with a cap on its unacked rows."""

    def first_open(self, waiting: DataFrame) -> DataFrame:
        first = F.min(digits.order(F.col("pos")))["digits"]
        return waiting.groupBy(*self.keys).agg(first.alias("seek_to"))

    def starts(self) -> DataFrame:
        """Where the consumer reads on: ``part, start_kind, start_ts, start_seq``.

        After the checkpoint, where a shard has one: what is delivered and not committed lies
        behind it. Else where the shard was sent back to, its lowest delivered record.
        """
        lowest = self.seeks().groupBy("part").agg(
            F.min(digits.order(F.col("seek_to")))["digits"].alias("__lowest")
        )
        both = self.checkpoints().join(lowest, "part", "full")
        after = F.col("checkpoint").isNotNull()
        return both.select(
            "part",
            F.when(after, positions.AFTER_SEQUENCE_NUMBER)
            .otherwise(positions.AT_SEQUENCE_NUMBER)
            .alias("start_kind"),
            F.lit(None).cast("timestamp_ntz").alias("start_ts"),
            F.coalesce("checkpoint", "__lowest").alias("start_seq"),
        )


class BreakerLedger(_Ledger):
    """Breaker trips per registration from a stream of publish outcomes.

    The newest batch of a registration stays open until a later one is seen, because more of
    its rows may follow. ``trips(final=True)`` closes those too. Rows of a batch that is closed
    come too late to count and are kept apart, in ``late()``.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        threshold: int = outcomes.FAILURE_THRESHOLD,
        span: int = SPAN,
    ) -> None:
        super().__init__(spark, folder)
        self.threshold = threshold
        self.span = span

    def process(self, batch: DataFrame, batch_id: int) -> None:
        base = f"{self.folder}/streaks"
        state = batches.get(batch.sparkSession, base, batch_id - 1, _STREAKS)
        # The streak of each registration, at the last batch that is closed.
        reached = settle(
            state.where("closed")
            .groupBy("reg")
            .agg(F.max("batch_no").alias("batch_no"), F.max_by("streak", "batch_no").alias("fails"))
        )
        known = reached.select("reg", F.col("batch_no").alias("__closed"))
        seen = lookup(batch, known, ["reg"], "left", null_safe=True)
        is_late = F.coalesce(F.col("batch_no") <= F.col("__closed"), F.lit(False))
        late = seen.where(is_late).select(*[F.col(f.name).cast(f.dataType) for f in _LATE])
        batches.put(late, f"{self.folder}/late", batch_id)

        still_open = state.where(~F.col("closed")).select(*outcomes.BATCH, "first_ok", "first_fail")
        fresh = outcomes.batch_minima(seen.where(~is_late)).unionByName(still_open)
        minima = fresh.groupBy(*outcomes.BATCH).agg(
            F.min("first_ok").alias("first_ok"), F.min("first_fail").alias("first_fail")
        )
        flags = outcomes.batch_flags(minima).withColumn("carried", F.lit(0))
        carried = reached.withColumns({"any_ok": F.lit(0), "carried": F.lit(1)})
        flags = settle(flags.unionByName(carried, allowMissingColumns=True))
        newest = settle(flags.groupBy("reg").agg(F.max("batch_no").alias("newest")))
        rows = outcomes.failure_streaks(flags, self.span)
        closed = (F.col("batch_no") < F.col("newest")) | (F.col("carried") == 1)
        marked = lookup(rows, newest, ["reg"], null_safe=True).withColumn("closed", closed)
        batches.put(marked.select(*_STREAKS.fieldNames()), base, batch_id)
        self.fold(batch_id, streaks=_STREAKS, late=_LATE)

    def late(self) -> DataFrame:
        """Outcomes of batches that were closed already; they count for nothing."""
        return batches.everything(self.spark, f"{self.folder}/late", _LATE).drop("batch_id")

    def trips(self, final: bool = False) -> DataFrame:
        rows = batches.everything(self.spark, f"{self.folder}/streaks", _STREAKS)
        if "batch_id" not in rows.columns:  # nothing was processed yet
            return rows.select(*outcomes.BATCH, "streak")
        tripped = (F.col("carried") == 0) & (F.col("fails") == 1)
        hits = rows.where(tripped & (F.col("streak") >= self.threshold))
        if not final:
            hits = hits.where("closed")
        # A batch that was open in several micro-batches counts as its last state.
        last = rows.where("carried = 0").groupBy(*outcomes.BATCH).agg(
            F.max("batch_id").alias("batch_id")
        )
        found = hits.withColumn("__b", F.struct(*outcomes.BATCH, "batch_id"))
        ends = last.select(F.struct(*outcomes.BATCH, "batch_id").alias("__b"))
        return found.join(ends, "__b", "left_semi").select(*outcomes.BATCH, "streak")


class ContractLedger(_Ledger):
    """Checks messages against their contracts; refused rows go to quarantine.

    With ``fail=True`` a refused row stops the query instead, before anything is written.
    """

    def __init__(
        self, spark: SparkSession, folder: str, schemas: DataFrame, fail: bool = False
    ) -> None:
        super().__init__(spark, folder)
        self.schemas = schemas
        self.fail = fail

    def process(self, batch: DataFrame, batch_id: int) -> None:
        self.split(contracts.check(self.spread(batch), self.schemas), batch_id)

    def spread(self, rows: DataFrame) -> DataFrame:
        """``rows`` dealt out evenly: a check costs far more than its bytes, and few files make few tasks."""
        return rows.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def split(self, checked: DataFrame, batch_id: int) -> None:
        if self.fail:
            checked = contracts.fail_on_invalid(checked).withColumn(
                "violation", F.lit(None).cast(_VIOLATION)
            )
        # One pass writes both sides; readers pick theirs by folder.
        flagged = checked.withColumn("refused", F.col("violation").isNotNull().cast("int"))
        batches.put(flagged, f"{self.folder}/checked", batch_id, ["refused"])
        self.fold(batch_id, checked=_CHECKED)

    def _checked(self, refused: int) -> DataFrame:
        rows = batches.everything(self.spark, f"{self.folder}/checked", _CHECKED)
        return rows.where(F.col("refused") == refused)

    def valid(self) -> DataFrame:
        return self._checked(0).select(*MESSAGE_COLUMNS)

    def quarantine(self) -> DataFrame:
        return contracts.violations(self._checked(1))


_CHANGE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("required_fields", REQUIRED_FIELDS),
        T.StructField("seq", T.LongType()),
    ]
)


class VersionedContractLedger(ContractLedger):
    """Checks messages against the contract that was valid at each of them.

    The stream has ``kind`` (message or change) and ``seq``, the common order of both; a message
    has ``id, topic, payload, attributes``, a change ``topic, op, required_fields``. The state is the
    versions so far, so a message that comes late is checked by the version of its place. A change
    that comes late counts from its micro-batch on: what was checked before stays as it is.

    With ``horizon``, versions that had ended that far before the newest change are forgotten, and
    messages from before them are checked by the oldest one left of their topic, if it is not later
    than they are (else they pass).
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        horizon: int | None = None,
        fail: bool = False,
        span: int = SPAN,
        few: int = contracts.FEW_VERSIONS,
    ) -> None:
        super().__init__(spark, folder, spark.createDataFrame([], _CHANGE), fail)
        self.horizon, self.span, self.few = horizon, span, few

    def process(self, batch: DataFrame, batch_id: int) -> None:
        base = f"{self.folder}/versions"
        names = _CHANGE.fieldNames()
        before = batches.get(self.spark, base, batch_id - 1, _CHANGE)
        fresh = batch.where("kind = 'change'").select(*names)
        known = self._passing(contracts.versions(before.unionByName(fresh)), "known", batch_id)
        # A late message of this micro-batch still finds what is forgotten after it.
        messages = batch.where("kind = 'message'").select(*MESSAGE_COLUMNS, "seq")
        checked = contracts.check_as_of(
            messages, known, "seq", span=self.span, few=self.few, versioned=True
        )
        self.split(checked.drop("seq"), batch_id)
        batches.put(self.lasting(known).select(*names), base, batch_id)
        batches.forget(self.spark, f"{self.folder}/known", batch_id)
        batches.forget(self.spark, base, batch_id - 2)

    def lasting(self, known: DataFrame) -> DataFrame:
        """The versions that are later than the horizon, and the last one before it of each topic."""
        newest = known.agg(F.max("seq")).first()[0]
        if self.horizon is None or newest is None:
            return known
        cut = newest - self.horizon
        ended = settle(
            known.where(F.col("seq") <= cut).groupBy("topic").agg(F.max("seq").alias("__last"))
        )
        kept = lookup(known, ended, ["topic"], "left", null_safe=True)
        return kept.where(F.coalesce(F.col("seq") >= F.col("__last"), F.lit(True))).drop("__last")

    def versions(self) -> DataFrame:
        """The change log that is still known: ``topic, op, required_fields, seq``."""
        base = f"{self.folder}/versions"
        return batches.get(self.spark, base, batches.newest(self.spark, base), _CHANGE)
