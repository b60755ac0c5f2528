"""Live caps: sessions, seeks and refused acks against a poll-by-poll fold."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from wharf.operators import delivery
from wharf.sources import positions
from wharf.streaming import ledgers, routes
from test_streaming import landing

LOG = "kind string, id string, topic string, part string, off bigint, ack_seq bigint, epoch bigint"


class Consumer:
    """The rule itself: what is delivered, acked and committed, one call at a time."""

    def __init__(self, logs: dict[str, list[int]], cap: int):
        self.logs, self.cap, self.epoch = logs, cap, 0
        self.at = {p: 0 for p in logs}
        self.delivered: dict[str, list[int]] = {p: [] for p in logs}
        self.acked: set[tuple[str, int]] = set()
        self.commits: set[tuple] = set()
        self.refused: list[tuple[str, int]] = []
        self.seeks: list[tuple[str, int, int]] = []

    def poll(self, p: str, n: int) -> list[int]:
        taken = [o for o in self.logs[p] if o >= self.at[p]][:n]
        if taken:
            self.at[p] = taken[-1] + 1
            self.delivered[p] += taken
        return taken

    def ack(self, p: str, off: int, seq: int, epoch: int) -> None:
        if epoch != self.epoch or off not in self.delivered[p] or (p, off) in self.acked:
            self.refused.append((f"t-{p}-{off}", seq))
            return
        self.acked.add((p, off))
        done = 0
        while done < len(self.delivered[p]) and (p, self.delivered[p][done]) in self.acked:
            done += 1
        if done:
            self.commits.add((p, seq, self.delivered[p][done - 1] + 1))
            del self.delivered[p][:done]

    def check_cap(self) -> None:
        open_rows = [(p, o) for p, offs in self.delivered.items() for o in offs]
        if self.cap and sum(row not in self.acked for row in open_rows) >= self.cap:
            self.epoch += 1
            for p, offs in self.delivered.items():
                if offs:
                    self.at[p] = offs[0]
                    self.seeks.append((p, offs[0], self.epoch))
                    offs.clear()
            self.acked.clear()


@pytest.mark.parametrize("cap, seed", [(6, 1), (9, 2), (0, 3)])
def test_capped_ledger_equals_poll_by_poll(spark, tmp_path, cap, seed):
    rng = random.Random(seed)
    logs = {str(p): sorted(rng.sample(range(200), 25)) for p in range(3)}
    logs["idle"] = []
    consumer = Consumer(logs, cap)
    land, stream, trigger = landing(spark, tmp_path / "in", LOG)
    ledger = ledgers.CappedAckLedger(spark, str(tmp_path / "ledger"), cap, span=16)
    seq, log, waiting = 0, [], []
    for _ in range(6):
        # The consumer asks for its session and its places before it polls.
        assert ledger.epoch() == consumer.epoch
        starts = {r.part: int(r.start_seq) for r in ledger.starts().collect()}
        for p, off in starts.items():
            if not consumer.delivered[p]:
                left = [o for o in logs[p] if o >= consumer.at[p]]
                assert [o for o in logs[p] if o >= off] == left
        step = []
        for p in logs:
            for off in consumer.poll(p, rng.randrange(2, 6)):
                row = ("delivered", f"t-{p}-{off}", "t", p, off, None, consumer.epoch)
                step.append(row)
                waiting.append((p, off, consumer.epoch))
        rng.shuffle(waiting)
        # Acks of this session and of older ones, some of them twice.
        for p, off, epoch in waiting[: rng.randrange(4, 14)]:
            for _ in range(1 + (rng.random() < 0.1)):
                seq += 1
                consumer.ack(p, off, seq, epoch)
                step.append(("ack", f"t-{p}-{off}", None, None, None, seq, epoch))
                log += step[-1:] if epoch == consumer.epoch else []
        del waiting[: rng.randrange(3, 9)]
        consumer.check_cap()
        land(step)
        log += [row for row in step if row[0] == "delivered"]
        routes.finish([ledger.start(stream(), trigger)])
    assert cap == 0 or consumer.epoch >= 2
    got = ledger.commits().select("part", "at_ack", "commit_offset").collect()
    assert {tuple(r) for r in got} == consumer.commits
    refused = ledger.refused().select("id", "ack_seq").collect()
    assert sorted(map(tuple, refused)) == sorted(consumer.refused)
    assert rows(ledger.seeks().select("part", "seek_to", "epoch")) == sorted(consumer.seeks, key=repr)

    # The batch operator over the log, without acks that came after their session, gives the same checkpoints.
    table = spark.createDataFrame(log, LOG).withColumnRenamed("epoch", "session")
    delivered = table.where("kind = 'delivered'")
    acks = table.where("kind = 'ack'").select("id", "ack_seq", "session")
    batch = delivery.session_checkpoints(delivered, acks, F.col("off"))
    live = ledger.commits().groupBy("part").agg((F.max("commit_offset") - 1).alias("checkpoint"))
    assert rows(batch.select("part", "checkpoint")) == rows(live.select("part", "checkpoint"))


def test_a_replayed_reset_is_the_same_reset(spark, tmp_path):
    """The micro-batch that reached the cap runs again after a failure."""
    ledger = ledgers.CappedAckLedger(spark, str(tmp_path / "ledger"), cap=2)
    given = [("delivered", f"t-0-{o}", "t", "0", o, None, 0) for o in (5, 6, 9)]
    batch = spark.createDataFrame([*given, ("ack", "t-0-6", None, None, None, 1, 0)], LOG)
    for _ in range(2):
        ledger.process(batch, 0)
        assert ledger.epoch() == 1
        assert rows(ledger.seeks().select("part", "seek_to", "epoch")) == [("0", 5, 1)]
    # Acks of the forgotten rows are refused, deliveries of the old session do not count.
    late = [("ack", "t-0-5", None, None, None, 2, 0), ("delivered", "t-0-11", "t", "0", 11, None, 0)]
    again = [("delivered", "t-0-5", "t", "0", 5, None, 1), ("ack", "t-0-5", None, None, None, 3, 1)]
    ledger.process(spark.createDataFrame(late + again, LOG), 1)
    assert rows(ledger.refused().select("id", "ack_seq")) == [("t-0-5", 2)]
    assert rows(ledger.commits().select("part", "at_ack", "commit_offset")) == [("0", 3, 6)]
    assert ledger.epoch() == 1
    assert rows(ledger.starts().select("part", "start_kind", "start_seq")) == [
        ("0", positions.AT_SEQUENCE_NUMBER, "6")
    ]


def test_capped_shards_resume_after_their_checkpoint(spark, tmp_path):
    shape = "kind string, id string, part string, pos string, ack_seq bigint, epoch bigint"
    ledger = ledgers.CappedShardLedger(spark, str(tmp_path / "ledger"), cap=3)
    big = "49590338271" + "0" * 44
    given = [("a", "9"), ("a", "10"), ("a", big + "7"), ("b", "100"), ("c", "3")]
    batch = [("delivered", f"{s}:{p}", s, p, None, 0) for s, p in given]
    batch += [("ack", "a:9", None, None, 1, 0), ("ack", f"a:{big}7", None, None, 2, 0), ("ack", "c:3", None, None, 3, 0)]
    ledger.process(spark.createDataFrame(batch, shape), 0)
    assert ledger.epoch() == 0  # two rows are unacked
    ledger.process(spark.createDataFrame([("delivered", "b:101", "b", "101", None, 0)], shape), 1)
    assert ledger.epoch() == 1
    assert rows(ledger.seeks().select("part", "seek_to")) == [("a", "10"), ("b", "100")]
    assert rows(ledger.starts().select("part", "start_kind", "start_seq")) == [
        ("a", positions.AFTER_SEQUENCE_NUMBER, "9"),
        ("b", positions.AT_SEQUENCE_NUMBER, "100"),
        ("c", positions.AFTER_SEQUENCE_NUMBER, "3"),
    ]
