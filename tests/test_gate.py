"""The breaker gate against a plain fold; failing sinks, probes, replays."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import rows
from test_streaming import landing
from wharf.streaming import routes
from wharf.streaming.gate import Gate

SHAPE = "reg string, seq bigint, at timestamp_ntz, id string"
START = datetime(2024, 1, 1)


def shape(spark) -> StructType:
    return spark.createDataFrame([], SHAPE).schema


class Sink:
    """Refuses the rows in ``bad``; stops each registration at its first failure and logs what it took."""

    def __init__(self, spark):
        self.spark, self.bad, self.log, self.tried = spark, set(), [], []

    def __call__(self, df, name):
        told, stopped = [], set()
        for r in sorted(df.collect(), key=lambda r: (r.reg or "", r.seq)):
            if r.reg in stopped:
                continue
            ok = (r.reg, r.seq) not in self.bad and (r.reg, None) not in self.bad
            told.append((r.reg, r.seq, ok, None if ok else "down"))
            self.tried.append((name, r.reg, r.seq))
            if ok:
                self.log.append((r.reg, r.seq))
            else:
                stopped.add(r.reg)
        return self.spark.createDataFrame(told, "reg string, seq bigint, ok boolean, error string")


def row(reg, seq, minutes):
    return (reg, seq, START + timedelta(minutes=minutes), f"{reg}-{seq}")


def test_gate_equals_fold(spark, tmp_path):
    rng = random.Random(5)
    land, stream, trigger = landing(spark, tmp_path / "in", SHAPE)
    sink = Sink(spark)
    gate = Gate(spark, str(tmp_path / "gate"), shape(spark), sink, 2, timedelta(minutes=10), probe_rows=2)
    held: dict = {}
    state = {reg: [0, None] for reg in "abc"}
    sent, trips, clock, number = [], [], START, 0
    for step in range(9):
        new = []
        for reg in "abc":
            for _ in range(rng.randrange(0, 4)):
                number += 1
                new.append(row(reg, number, step * 4 + rng.randrange(3)))
        if not new:
            continue
        # Registration a is down for a while, b refuses single rows for a step, c is always up.
        sink.bad = {("a", None)} if step in (1, 2, 3, 4) else set()
        sink.bad |= {("b", r[1]) for r in new if r[0] == "b" and rng.random() < 0.3}
        land(new)
        routes.finish([gate.start(stream(), trigger)])

        clock = max([clock, *(r[2] for r in new)])
        for reg in "abc":
            todo = sorted(held.get(reg, []) + [r[1] for r in new if r[0] == reg])
            streak, until = state[reg]
            if until is not None and until > clock:
                held[reg] = todo
                continue
            refuses = lambda n: (reg, n) in sink.bad or (reg, None) in sink.bad
            parts = [todo] if until is None else [todo[:2], todo[2:]]
            some, failed, done = False, False, []
            for part in parts:
                for n in part:
                    if refuses(n):
                        failed = True
                        break
                    some = True
                    done.append(n)
                if failed:
                    break
            held[reg] = todo[len(done) :]
            sent += [(reg, n) for n in done]
            if not todo:
                continue
            streak = (0 if some else streak) + failed
            until = None
            if failed and streak >= 2:
                trips.append((reg, clock, streak))
                streak, until = 1, clock + timedelta(minutes=10)
            state[reg] = [streak, until]
    assert trips and sink.log.count(("c", max(n for r, n in sink.log if r == "c"))) == 1
    assert sorted(map(tuple, gate.delivered().select("reg", "seq").collect())) == sorted(sent)
    assert sorted(sink.log) == sorted(sent)  # nothing was sent twice
    for reg in "abc":
        order = [n for r, n in sink.log if r == reg]
        assert order == sorted(order)  # nothing was overtaken
    assert rows(gate.held().select("reg", "seq")) == sorted([(r, n) for r, ns in held.items() for n in ns], key=repr)
    assert rows(gate.trips().select("reg", "at", "streak")) == sorted(trips, key=repr)
    now_open = {r.reg for r in gate.open_registrations().collect()}
    assert now_open == {reg for reg, (_, until) in state.items() if until is not None}


def test_open_registration_waits_for_the_event_time(spark, tmp_path):
    sink = Sink(spark)
    gate = Gate(spark, str(tmp_path / "gate"), shape(spark), sink, 1, timedelta(minutes=10), probe_rows=1)

    def step(n, *given):
        gate.process(spark.createDataFrame(list(given), SHAPE), n)

    sink.bad = {("a", None)}
    step(0, row("a", 1, 0), row("a", 2, 0), row("b", 1, 0))
    assert sink.tried == [("0-first", "a", 1), ("0-first", "b", 1)]
    step(1, row("a", 3, 5), row("b", 2, 9))
    assert [t for t in sink.tried if t[0].startswith("1-")] == [("1-first", "b", 2)]
    # Time moves on with another registration; the probe is one row, and fails.
    step(2, row("b", 3, 10))
    assert ("2-first", "a", 1) in sink.tried and not any(t[0] == "2-rest" for t in sink.tried)
    sink.bad = set()
    step(3, row("b", 4, 19))
    assert not any(t[:2] == ("3-first", "a") for t in sink.tried)
    step(4, row("b", 5, 20))
    assert [t for t in sink.tried if t[0].startswith("4-") and t[1] == "a"] == [
        ("4-first", "a", 1),
        ("4-rest", "a", 2),
        ("4-rest", "a", 3),
    ]
    assert gate.held().count() == 0 and gate.open_registrations().count() == 0
    assert [(r.reg, r.streak) for r in gate.trips().orderBy("batch_id").collect()] == [("a", 1), ("a", 1)]


def test_replayed_micro_batch_sends_again_and_keeps_its_state(spark, tmp_path):
    sink = Sink(spark)
    gate = Gate(spark, str(tmp_path / "gate"), shape(spark), sink, 3)
    sink.bad = {("a", 2)}
    batch = spark.createDataFrame([row("a", 1, 0), row("a", 2, 0), row(None, 7, 0)], SHAPE)
    for _ in range(2):
        gate.process(batch, 0)
        assert rows(gate.delivered().select("reg", "seq")) == [("a", 1), (None, 7)]
        assert rows(gate.held().select("reg", "seq")) == [("a", 2)]
    sink.bad = set()
    gate.process(batch.limit(0), 1)
    assert gate.held().count() == 0
    assert [n for r, n in sink.log if r == "a"] == [1, 1, 2]


def test_wrong_settings(spark, tmp_path):
    with pytest.raises(ValueError):
        Gate(spark, str(tmp_path), shape(spark), Sink(spark), threshold=0)
    with pytest.raises(ValueError):
        Gate(spark, str(tmp_path), shape(spark).add("x", "int")[["reg", "x"]], Sink(spark))
    assert Gate(spark, str(tmp_path / "new"), shape(spark), Sink(spark)).held().select(F.count("*")).first()[0] == 0
