"""A circuit breaker that holds the rows of failing registrations back, without sleeping."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wharf.operators.outcomes import FAILURE_THRESHOLD
from wharf.plans.joins import lookup
from wharf.session import settle
from wharf.sources.intake import DEFAULT_MESSAGES_PER_PULL, capped
from wharf.streaming import batches
from wharf.streaming.ledgers import _Ledger

#: Publishes rows (with ``reg, seq``), each registration in the order of ``seq`` up to its first
#: failure, and returns ``reg, seq, ok, error`` for every row it tried. The text names the attempt;
#: a replayed micro-batch repeats the names.
Publish = Callable[[DataFrame, str], DataFrame]

# Fixed value: how long a registration pauses by default.
COOLDOWN = timedelta(seconds=30)

_FOREVER = (1 << 63) - 1

_STATE = T.StructType(
    [
        T.StructField("reg", T.StringType()),
        T.StructField("streak", T.LongType()),
        T.StructField("open_until", T.TimestampNTZType()),
    ]
)

_CLOCK = T.StructType([T.StructField("at", T.TimestampNTZType())])

_DELIVERED = T.StructType([T.StructField("reg", T.StringType()), T.StructField("seq", T.LongType())])

_TRIPS = T.StructType(
    [
        T.StructField("reg", T.StringType()),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField("streak", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


class Gate(_Ledger):
    """Routes micro-batches to a sink and lets outcomes decide what the next one may send.

    The stream has ``reg`` (the registration), ``seq`` (a BIGINT, its order there) and ``at`` (event
    time), beside whatever the sink needs. What a registration has to send in a micro-batch is what
    is held for it and what has come, in the order of ``seq``. It is sent up to the first failure;
    that row and all after it are held and sent again, first, the next time. So nothing is lost, and
    within a registration nothing overtakes.

    Failed micro-batches in a row are counted, a success counting first. At ``threshold`` the
    registration opens: until the event time (of all registrations together) has moved on by
    ``cooldown``, its rows are only held. Then a probe of ``probe_rows`` rows is sent. If it fails,
    the registration opens again at once; if it gets through, the rest follows in the same
    micro-batch. Other registrations are not affected.

    Delivery is at least once: a micro-batch that is replayed sends its rows again. A registration
    that is held still waits for some row to move the time; ``held()`` shows what it has.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        shape: T.StructType,
        publish: Publish,
        threshold: int = FAILURE_THRESHOLD,
        cooldown: timedelta = COOLDOWN,
        probe_rows: int = DEFAULT_MESSAGES_PER_PULL,
    ) -> None:
        super().__init__(spark, folder)
        if threshold <= 0:
            raise ValueError(f"publishFailureThreshold must be > 0, got {threshold}")
        missing = {"reg", "seq", "at"} - set(shape.names)
        if missing:
            raise ValueError(f"the stream needs the columns {sorted(missing)}")
        self.shape, self.publish = shape, publish
        self.threshold, self.cooldown, self.probe_rows = threshold, cooldown, probe_rows

    def process(self, batch: DataFrame, batch_id: int) -> None:
        names = self.shape.names
        before = batches.get(self.spark, f"{self.folder}/held", batch_id - 1, self.shape)
        state = batches.get(self.spark, f"{self.folder}/state", batch_id - 1, _STATE)
        last = batches.get(self.spark, f"{self.folder}/clock", batch_id - 1, _CLOCK)
        pending = before.unionByName(batch.select(*names)).persist()  # sent, then split
        try:
            times = pending.select("at").unionByName(last).agg(F.max("at")).first()[0]
            clock = F.lit(times).cast("timestamp_ntz")
            mode = (
                F.when(F.col("open_until").isNull(), "all")
                .when(F.col("open_until") <= clock, "probe")
                .otherwise("hold")
            )
            known = settle(state.withColumn("__mode", mode))
            cuts = self._send(pending, known.select("reg", "__mode"), f"{batch_id}")
            self._store(pending, known, cuts, clock, batch_id)
            batches.put(self.spark.createDataFrame([(times,)], _CLOCK), f"{self.folder}/clock", batch_id)
        finally:
            pending.unpersist()
        for kind in ("held", "state", "clock"):
            batches.forget(self.spark, f"{self.folder}/{kind}", batch_id - 2)
        self.fold(batch_id, delivered=_DELIVERED, trips=_TRIPS)

    def _send(self, pending: DataFrame, modes: DataFrame, name: str) -> DataFrame:
        """Per registration that sent something: ``reg, bound, any_ok, fails, error``.

        What lies before ``bound`` is delivered.
        """
        placed = lookup(pending, modes, ["reg"], "left", null_safe=True)
        free = placed.where(F.coalesce("__mode", F.lit("all")) == "all").drop("__mode")
        probing = placed.where("__mode = 'probe'").drop("__mode")
        probe = capped(probing, ["reg"], "seq", self.probe_rows)
        first = self._outcome(free.unionByName(probe), f"{name}-first")
        # Probes that got through are followed by the rest.
        through = modes.where("__mode = 'probe'").join(first.where("fails = 0"), "reg").select(
            "reg", F.col("upto").alias("__upto")
        )
        through = settle(through)
        if through.isEmpty():
            return first
        behind = lookup(probing, through, ["reg"]).where(F.col("seq") > F.col("__upto")).drop("__upto")
        rest = self._outcome(behind, f"{name}-rest")
        both = first.unionByName(rest).groupBy("reg").agg(
            F.min("bound").alias("bound"),
            F.max("any_ok").alias("any_ok"),
            F.max("fails").alias("fails"),
            F.max("error").alias("error"),
            F.max("upto").alias("upto"),
        )
        return settle(both)

    def _outcome(self, rows: DataFrame, name: str) -> DataFrame:
        told = settle(self.publish(rows, name).select("reg", "seq", "ok", "error"))
        failed = F.when(~F.col("ok"), F.col("seq"))
        cut = told.groupBy("reg").agg(
            F.min(failed).alias("stop"),
            F.min(F.when(F.col("ok"), F.col("seq"))).alias("start"),
            F.min_by("error", failed).alias("error"),
            F.max("seq").alias("upto"),
        )
        fails = F.col("stop").isNotNull()
        some = F.col("start").isNotNull() & (~fails | (F.col("start") < F.col("stop")))
        return settle(
            cut.select(
                "reg",
                F.coalesce("stop", F.lit(_FOREVER)).alias("bound"),
                some.cast("int").alias("any_ok"),
                fails.cast("int").alias("fails"),
                F.when(fails, F.col("error")).alias("error"),
                "upto",
            )
        )

    def _store(self, pending: DataFrame, known: DataFrame, cuts: DataFrame, clock, batch_id: int) -> None:
        both = known.join(cuts.withColumnRenamed("reg", "__reg"), F.col("reg").eqNullSafe(F.col("__reg")), "full")
        sent = F.col("fails").isNotNull()
        count = F.when(F.col("any_ok") == 1, F.lit(0)).otherwise(F.coalesce("streak", F.lit(0))) + F.col("fails")
        trips = (F.col("fails") == 1) & (count >= self.threshold)
        pause = F.make_dt_interval(secs=F.lit(self.cooldown.total_seconds()))
        judged = settle(
            both.select(
                F.coalesce("reg", "__reg").alias("reg"),
                F.when(~sent, F.col("streak"))
                .when(trips, F.lit(self.threshold - 1))
                .otherwise(count)
                .cast("bigint")
                .alias("streak"),
                F.when(~sent, F.col("open_until")).when(trips, clock + pause).alias("open_until"),
                F.when(trips, count).cast("bigint").alias("tripped"),
                "error",
            )
        )
        bounds = cuts.select("reg", F.col("bound").alias("__bound"))
        split = lookup(pending, bounds, ["reg"], "left", null_safe=True)
        done = F.coalesce(F.col("seq") < F.col("__bound"), F.lit(False))
        batches.put(split.where(done).select("reg", "seq"), f"{self.folder}/delivered", batch_id)
        batches.put(split.where(~done).select(*self.shape.names), f"{self.folder}/held", batch_id)
        tripped = judged.where("tripped IS NOT NULL").select(
            "reg", clock.alias("at"), F.col("tripped").alias("streak"), "error"
        )
        batches.put(tripped, f"{self.folder}/trips", batch_id)
        batches.put(judged.select(*_STATE.fieldNames()), f"{self.folder}/state", batch_id)

    def delivered(self) -> DataFrame:
        """What got through: ``reg, seq`` and the micro-batch."""
        return batches.everything(self.spark, f"{self.folder}/delivered", _DELIVERED)

    def trips(self) -> DataFrame:
        """Each time a registration opened: ``reg, at, streak, error`` and the micro-batch."""
        return batches.everything(self.spark, f"{self.folder}/trips", _TRIPS)

    def held(self) -> DataFrame:
        """What is waiting now."""
        return self._latest("held", self.shape)

    def open_registrations(self) -> DataFrame:
        """``reg, streak, open_until`` of the registrations that are held now."""
        return self._latest("state", _STATE).where(F.col("open_until").isNotNull())

    def _latest(self, kind: str, shape: T.StructType) -> DataFrame:
        base = f"{self.folder}/{kind}"
        return batches.get(self.spark, base, batches.newest(self.spark, base), shape)
