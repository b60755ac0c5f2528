from __future__ import annotations

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from wharf.functions import digits
from wharf.operators import delivery
from wharf.sources import positions

DELIVERED = "id string, topic string, part string, off bigint"
ACKS = "id string, ack_seq bigint"


def tables(spark, offsets: list[int], acked: list[int]):
    delivered = spark.createDataFrame([(f"m{o}", "t", "0", o) for o in offsets], DELIVERED)
    acks = spark.createDataFrame([(f"m{o}", n) for n, o in enumerate(acked)], ACKS)
    return delivered, acks


def commits_fold(offsets: list[int], acked: list[int]) -> list[tuple[int, int]]:
    """(ack number, committed offset) as acks come in one by one."""
    open_, got, out = sorted(offsets), set(), []
    for n, offset in enumerate(acked):
        got.add(offset)
        last = None
        while open_ and open_[0] in got:
            last = open_.pop(0)
        if last is not None:
            out.append((n, last + 1))
    return out


@pytest.mark.parametrize(
    ("offsets", "acked", "commits"),
    [
        ([43, 44, 45], [43, 45], [(0, 44)]),
        ([43, 44, 45], [44, 45], []),
        ([43, 44, 45], [45, 44, 43], [(2, 46)]),
        ([100, 102, 105], [102, 105, 100], [(2, 106)]),
        ([100, 102, 105], [100, 102, 105], [(0, 101), (1, 103), (2, 106)]),
    ],
)
def test_literal_commits(spark, offsets, acked, commits):
    delivered, acks = tables(spark, offsets, acked)
    got = delivery.commits(delivery.acked(delivered, acks)).select("at_ack", "commit_offset")
    assert rows(got) == commits == commits_fold(offsets, acked)
    point = delivery.checkpoints(delivered, acks, F.col("off")).collect()
    assert [r.checkpoint + 1 for r in point] == [commits[-1][1] for _ in commits[-1:]]


def random_partitions(seed: int):
    """Many partitions, one of them with a third of all rows; some rows delivered twice."""
    rng = random.Random(seed)
    delivered, acks, folds = [], [], {}
    for part in range(30):
        size = 150 if part == 0 else rng.randint(1, 12)
        offsets = sorted(rng.sample(range(1000), size))
        acked = [o for o in offsets if rng.random() < (0.97 if part == 0 else 0.8)]
        rng.shuffle(acked)
        ids = {o: f"t-{part}-{o}" for o in offsets}
        delivered += [(ids[o], "t", str(part), o) for o in offsets]
        delivered += [(ids[o], "t", str(part), o) for o in offsets if rng.random() < 0.1]
        acks += [(ids[o], n) for n, o in enumerate(acked)]
        # Repeated acks change nothing.
        acks += [(ids[o], 5000 + n) for n, o in enumerate(acked) if rng.random() < 0.1]
        folds[str(part)] = (offsets, acked)
    return delivered, acks, folds


@pytest.mark.parametrize("seed", range(4))
def test_ledger_equals_ack_by_ack_fold(spark, seed):
    delivered_rows, ack_rows, folds = random_partitions(seed)
    delivered = spark.createDataFrame(delivered_rows, DELIVERED).repartition(7)
    acks = spark.createDataFrame(ack_rows, ACKS).repartition(5)
    want = {p: commits_fold(*fold) for p, fold in folds.items()}

    ledger = delivery.acked(delivered, acks)
    history = delivery.commits(ledger, span=16).select("part", "at_ack", "commit_offset")
    assert rows(history) == sorted(
        [(p, *c) for p, commits in want.items() for c in commits], key=repr
    )
    points = delivery.checkpoints(delivered, acks, F.col("off")).select("part", "checkpoint")
    ends = {p: c[-1][1] - 1 for p, c in want.items() if c}
    assert dict(tuple(r) for r in points.collect()) == ends

    left = {p: [o for o in offs if o > ends.get(p, -1)] for p, (offs, _) in folds.items()}
    seeks = delivery.seek_positions(delivered, acks).select("part", "seek_to")
    assert dict(tuple(r) for r in seeks.collect()) == {p: o[0] for p, o in left.items() if o}
    again = delivery.redelivered(delivered, acks).select("part", "off").distinct()
    assert rows(again) == sorted([(p, o) for p, offs in left.items() for o in offs], key=repr)

    held = sum(len(offs) - len(set(acked)) for offs, acked in folds.values())
    flight = delivery.in_flight(delivered, acks, held, ["topic"]).first()
    assert (flight.in_flight, flight.cap_reached) == (held, True)
    assert not delivery.in_flight(delivered, acks, held + 1, ["topic"]).first().cap_reached
    assert not delivery.in_flight(delivered, acks, 0, ["topic"]).first().cap_reached


def test_nothing_in_flight_is_reported_as_zero(spark):
    got = delivery.in_flight(*tables(spark, [1, 2], [2, 1]), cap=1, keys=["topic"]).first()
    assert (got.in_flight, got.cap_reached) == (0, False)


def test_refused_acks(spark):
    delivered, _ = tables(spark, [1, 2], [])
    acks = spark.createDataFrame(
        [("m1", 5), ("m1", 9), ("m1", 7), ("m2", 1), ("zz", 3), ("zz", 4)], ACKS
    )
    got = delivery.refused_acks(delivered, acks)
    assert rows(got.select("id", "ack_seq", "cause")) == [
        ("m1", 7, "already acknowledged"),
        ("m1", 9, "already acknowledged"),
        ("zz", 3, "never delivered"),
        ("zz", 4, "never delivered"),
    ]
    assert got.where("id = 'zz'").first().message == (
        "Unknown message: zz. Only messages returned by poll() can be acknowledged."
    )


def test_redelivery_replaces_the_ack_handle(spark):
    df = spark.createDataFrame(
        [("m", "old", 1), ("m", "new", 2), ("n", "only", 1)], "id string, ack_id string, delivered_at int"
    )
    assert rows(delivery.latest_handles(df)) == [("m", "new", 2), ("n", "only", 1)]


# --- sequence numbers -------------------------------------------------------

BIG = "4959033827" + "0" * 45


def shards(spark, data):
    rows_ = [(f"{s}:{n}", s, n) for s, n, _ in data]
    delivered = spark.createDataFrame(rows_, "id string, part string, pos string")
    acks = spark.createDataFrame(
        [(f"{s}:{n}", i) for i, (s, n, ok) in enumerate(data) if ok], ACKS
    )
    return delivered, acks


def test_sequence_checkpoints_compare_as_numbers(spark):
    data = [("s0", "2", True), ("s0", "10", True), ("s0", "11", False), ("s0", "12", True)]
    data += [("s1", "9", False), ("s1", "10", True)]
    data += [("s2", BIG + "9", True), ("s2", BIG + "8", True)]
    got = delivery.checkpoints(*shards(spark, data), digits.order(F.col("pos")), ["part"])
    assert rows(got.select("part", "checkpoint.digits")) == [("s0", "10"), ("s2", BIG + "9")]


def test_checkpoints_never_move_back(spark):
    schema = "part string, checkpoint string"
    old = spark.createDataFrame([("s0", "300"), ("s1", "7"), ("s9", "1")], schema)
    new = spark.createDataFrame([("s0", "99"), ("s1", "0010")], schema)
    assert rows(delivery.merge_checkpoints(old, new)) == [("s0", "300"), ("s1", "10"), ("s9", "1")]


def test_resume_positions(spark):
    data = [("acked", "5", True), ("acked", "6", False), ("open", "8", False), ("open", "9", True)]
    delivered, acks = shards(spark, data)
    every = spark.createDataFrame([("acked",), ("open",), ("idle",), ("own",)], "part string")
    own = spark.createDataFrame(
        [("own", "AT_SEQUENCE_NUMBER", None, "77"), ("open", "LATEST", None, None)],
        "part string, start_kind string, start_ts timestamp_ntz, start_seq string",
    )
    default = positions.Start(positions.AT_TIMESTAMP, timestamp="2024-01-01 00:00:00")
    got = delivery.resume_positions(every, delivered, acks, default, own)
    assert rows(got) == [
        ("acked", "AFTER_SEQUENCE_NUMBER", None, "5"),
        ("idle", "AT_TIMESTAMP", datetime.datetime(2024, 1, 1), None),
        ("open", "AT_SEQUENCE_NUMBER", None, "8"),
        ("own", "AT_SEQUENCE_NUMBER", None, "77"),
    ]
    # A saved checkpoint counts as well, and only shards with open rows are touched at the cap.
    saved = spark.createDataFrame([("open", "3"), ("idle", "4")], "part string, checkpoint string")
    resumed = delivery.resume_positions(every, delivered, acks, default, saved=saved)
    assert {r.part: r.start_seq for r in resumed.collect()} == {
        "acked": "5",
        "idle": "4",
        "open": "3",
        "own": None,
    }
    capped = delivery.touched_at_cap(delivered, acks, default)
    assert {r.part for r in capped.collect()} == {"acked", "open"}


def test_exported_checkpoints_restore_the_rest(spark):
    data = [("s0", str(n), n != 7) for n in range(1, 11)]
    delivered, acks = shards(spark, data)
    point = delivery.checkpoints(delivered, acks, digits.order(F.col("pos")), ["part"])
    restored = positions.restored(
        point.select("part", F.col("checkpoint.digits").alias("checkpoint"))
    )
    placed = delivered.withColumn("arrived_at", F.lit(None).cast("timestamp_ntz"))
    left = positions.start_at(placed, positions.Start(positions.LATEST), restored)
    assert sorted(int(r.pos) for r in left.collect()) == [7, 8, 9, 10]


def test_checkpoint_plan_has_no_window_and_no_python(spark):
    delivered, acks = tables(spark, [1, 2, 3], [1, 3])
    plan = delivery.checkpoints(delivered, acks, F.col("off"))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "Window" not in text and "Python" not in text and "CartesianProduct" not in text


def test_rows_without_a_partition_stay(spark):
    delivered = spark.createDataFrame([(f"m{o}", "t", None, o) for o in range(3)], DELIVERED)
    acks = spark.createDataFrame([("m0", 0), ("m1", 1)], ACKS)
    assert delivery.acked(delivered, acks).where("ack_seq IS NOT NULL").count() == 2
    point = delivery.checkpoints(delivered, acks, F.col("off"))
    assert rows(point) == [("t", None, 1)]
    assert rows(delivery.redelivered(delivered, acks).select("id")) == [("m2",)]
    assert rows(delivery.commits(delivery.acked(delivered, acks)).select("at_ack", "commit_offset")) == [(0, 1), (1, 2)]


def sessions_fold(log: list[tuple[str, int]]) -> int | None:
    """Last committed offset as deliveries, acks and resets come in one by one."""
    open_, got, last = [], set(), None
    for kind, offset in log:
        if kind == "reset":
            open_, got = [], set()
        elif kind == "deliver":
            open_.append(offset)
        elif offset in open_:
            got.add(offset)
            while open_ and min(open_) in got:
                last = min(open_)
                open_.remove(last)
    return last


def session_tables(spark, log: list[tuple[str, int]]):
    session, delivered, acks = 0, [], []
    for n, (kind, offset) in enumerate(log):
        session += kind == "reset"
        if kind == "deliver":
            delivered.append((f"m{offset}", "t", "0", offset, session))
        elif kind == "ack":
            acks.append((f"m{offset}", n, session))
    return (
        spark.createDataFrame(delivered, f"{DELIVERED}, session int"),
        spark.createDataFrame(acks, f"{ACKS}, session int"),
    )


def test_acks_beyond_the_prefix_are_forgotten_at_a_reset(spark):
    log = [("deliver", i) for i in range(3)] + [("ack", 1), ("ack", 2), ("reset", 0)]
    log += [("deliver", i) for i in range(3)] + [("ack", 0)]
    delivered, acks = session_tables(spark, log)
    assert rows(delivery.session_checkpoints(delivered, acks, F.col("off"))) == [("t", "0", 0)]
    assert delivery.refused_acks(delivered, acks, "session").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_sessions_equal_an_ack_by_ack_fold(spark, seed):
    rng = random.Random(seed)
    log, begin = [], 0
    for _ in range(4):
        end = begin + rng.randint(3, 12)
        part = [("deliver", i) for i in range(begin, end)]
        acks = [("ack", i) for i in range(begin, end) if rng.random() < 0.8]
        rng.shuffle(acks)
        log += [*part, *acks, ("reset", 0)]
        done = sessions_fold(log[:-1])
        begin = 0 if done is None else done + 1
    delivered, acks = session_tables(spark, log)
    want = sessions_fold(log)
    got = delivery.session_checkpoints(delivered, acks, F.col("off")).collect()
    assert [r.checkpoint for r in got] == ([] if want is None else [want])


def attempts_fold(offsets, order, fails):
    """Ack by ack: a commit is tried while the acked prefix of what is left is not empty."""
    left, acked, out = sorted(offsets), set(), []
    for n, off in enumerate(order):
        acked.add(off)
        prefix = list(itertools.takewhile(lambda o: o in acked, left))
        if prefix:
            out.append((n, prefix[-1] + 1, n not in fails))
            if n not in fails:
                left = left[len(prefix) :]
    return out


@pytest.mark.parametrize("span", [3, 1 << 20])
def test_failed_commits_equal_the_fold(spark, span):
    rng = random.Random(span)
    data, want = [], []
    for part in ("0", "1", None):
        offsets = sorted(rng.sample(range(80), 25))
        order = rng.sample(offsets, 22)
        fails = set(rng.sample(range(22), 9))
        seq = {o: n for n, o in enumerate(order)}
        data += [("t", part, o, seq.get(o), seq[o] not in fails if o in seq else None) for o in offsets]
        want += [("t", part, *a) for a in attempts_fold(offsets, order, fails)]
    log = spark.createDataFrame(
        data, "topic string, part string, off bigint, ack_seq bigint, commit_ok boolean"
    )
    assert rows(delivery.commit_attempts(log, span)) == sorted(want, key=repr)
    literal = [("t", "0", 100, 0, False), ("t", "0", 101, 1, True)]
    log = spark.createDataFrame(literal, log.schema)
    assert rows(delivery.commit_attempts(log)) == [("t", "0", 0, 101, False), ("t", "0", 1, 102, True)]


def test_acks_of_one_number_are_tried_each(spark):
    """Acks 1 fail twice, acks 2 fail once and succeed twice, acks 3 have nothing left to commit."""
    data = [
        ("t", "0", 100, 1, False),
        ("t", "0", 101, 1, False),
        ("t", "0", 102, 2, True),
        ("t", "0", 103, 2, False),
        ("t", "0", 104, 2, True),
        ("t", "0", 105, None, None),
        ("t", "0", 106, 3, False),
        ("t", "0", 107, 3, False),
    ]
    log = spark.createDataFrame(
        data, "topic string, part string, off bigint, ack_seq bigint, commit_ok boolean"
    )
    assert rows(delivery.commit_attempts(log)) == [
        ("t", "0", 1, 102, False),
        ("t", "0", 1, 102, False),
        ("t", "0", 2, 105, False),
        ("t", "0", 2, 105, True),
    ]
