from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_delivery import commits_fold
from test_outcomes import OUTCOMES, trips_fold
from wharf import schemas
from wharf.operators import contracts, routing
from wharf.sinks import writers
from wharf.streaming import ledgers, routes
from wharf.streaming.routes import intake

LOG = "kind string, id string, topic string, part string, off bigint, ack_seq bigint"


def landing(spark, folder, schema):
    """A folder that receives one file at a time, and its stream (one file per micro-batch)."""

    def land(data) -> None:
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(folder))

    options, trigger = intake(max_files=1)

    def stream():
        typed = spark.createDataFrame([], schema).schema
        return spark.readStream.schema(typed).options(**options).parquet(str(folder))

    return land, stream, trigger


def test_intake_options():
    assert intake() == ({}, {"availableNow": True})
    assert intake(5, max_offsets=10_000, max_files=2) == (
        {"maxOffsetsPerTrigger": "10000", "maxFilesPerTrigger": "2"},
        {"processingTime": "5 seconds"},
    )


MESSAGES = [(f"m{n}", "raw-a" if n % 2 else "raw-b", b"p", {"n": str(n)}) for n in range(20)]
BRIDGE = "source_id string, channel string, source_topic string, target_topic string"
RELAY = "destination_id string, source_topic string, downstream_topic string"


def parquet_sink(folder):
    return lambda df, checkpoint: writers.land_stream(df, str(folder), checkpoint)


def test_one_query_bridge_equals_batch(spark, tmp_path):
    land, stream, trigger = landing(spark, tmp_path / "in", schemas.MESSAGE)
    land(MESSAGES[:7])
    land(MESSAGES[7:])
    table = spark.createDataFrame(
        [("s", "a", "raw-a", "s.a"), ("s", "b", "raw-b", "s.b")], BRIDGE
    )
    sink = parquet_sink(tmp_path / "out")
    query = routes.bridge_together(stream(), table, sink, str(tmp_path / "cp"), trigger)
    routes.finish([query])
    got = spark.read.parquet(str(tmp_path / "out"))
    want = routing.fan_in(spark.createDataFrame(MESSAGES, schemas.MESSAGE), table)
    columns = ["id", "topic", F.to_json("attributes")]
    assert rows(got.select(*columns)) == rows(want.select(*columns))


def test_restart_reads_only_what_is_new(spark, tmp_path):
    land, stream, trigger = landing(spark, tmp_path / "in", schemas.MESSAGE)
    route = spark.createDataFrame([("s", "a", "raw-a", "s.a")], BRIDGE).collect()
    sink = parquet_sink(tmp_path / "out")

    def run():
        source = lambda topic: stream().where(F.col("topic") == topic)
        routes.finish(routes.bridge_each(source, route, sink, str(tmp_path / "cp"), trigger))

    land(MESSAGES[:10])
    run()
    land(MESSAGES[10:])
    run()
    run()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got.select("id")) == sorted((m[0],) for m in MESSAGES if m[1] == "raw-a")


def test_failed_publish_is_repeated_after_restart(spark, tmp_path):
    """A sink that fails leaves its micro-batch uncommitted: rows come again, none is lost."""
    land, stream, trigger = landing(spark, tmp_path / "in", schemas.MESSAGE)
    land(MESSAGES[:5])
    land(MESSAGES[5:])
    route = spark.createDataFrame([("d", "raw-a", "q")], RELAY).collect()
    seen, fail = [], {"left": 1}

    def publish(df, batch_id):
        seen.append((batch_id, sorted(r.id for r in df.collect())))
        if batch_id == 1 and fail["left"]:
            fail["left"] -= 1
            raise RuntimeError("broker down")

    def sink(_route):
        return lambda df, checkpoint: df.writeStream.foreachBatch(publish).option(
            "checkpointLocation", checkpoint
        )

    def run():
        source = lambda topic: stream().where(F.col("topic") == topic)
        routes.finish(routes.relay_each(source, route, sink, str(tmp_path / "cp"), trigger))

    with pytest.raises(Exception, match="broker down"):
        run()
    run()
    assert [b for b, _ in seen] == [0, 1, 1]
    assert seen[1][1] == seen[2][1]
    assert sorted(set(seen[0][1] + seen[2][1])) == sorted(m[0] for m in MESSAGES if m[1] == "raw-a")


def test_slow_or_broken_destination_does_not_stop_the_others(spark, tmp_path):
    land, stream, trigger = landing(spark, tmp_path / "in", schemas.MESSAGE)
    land(MESSAGES)
    table = spark.createDataFrame([("bad", "raw-a", "q1"), ("good", "raw-a", "q2")], RELAY)

    def broken(df, batch_id):
        raise RuntimeError("always down")

    def sink(route):
        if route.destination_id == "bad":
            return lambda df, cp: df.writeStream.foreachBatch(broken).option("checkpointLocation", cp)
        return parquet_sink(tmp_path / "out")

    queries = routes.relay_each(
        lambda topic: stream().where(F.col("topic") == topic),
        table.collect(),
        sink,
        str(tmp_path / "cp"),
        trigger,
    )
    good = next(q for q in queries if q.name.startswith("relay good"))
    good.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 10
    assert got.select(F.element_at("attributes", "relay.destinationId")).first()[0] == "good"
    with pytest.raises(Exception, match="always down"):
        routes.finish(queries)


@pytest.mark.parametrize("span", [4, 1 << 20])
def test_live_watermark_equals_ack_by_ack_fold(spark, tmp_path, span):
    rng = random.Random(span)
    land, stream, trigger = landing(spark, tmp_path / "in", LOG)
    ledger = ledgers.AckLedger(spark, str(tmp_path / "ledger"), span)
    parts = {str(p): sorted(rng.sample(range(60), 14)) for p in range(3)}
    acked = {p: [o for o in offs if rng.random() < 0.9] for p, offs in parts.items()}
    for order in acked.values():
        rng.shuffle(order)

    def event(kind, p, o, n=None):
        return (kind, f"t-{p}-{o}", "t", p, o, n)

    # Deliver in two steps, ack what was delivered in three; restart in between.
    first = {p: offs[:8] for p, offs in parts.items()}
    early = {p: [o for o in order if o in first[p]] for p, order in acked.items()}
    late = {p: [o for o in order if o not in first[p]] for p, order in acked.items()}
    sequence = {p: early[p][:3] + early[p][3:] + late[p] for p in parts}
    number = {(p, o): n for p, order in sequence.items() for n, o in enumerate(order)}

    land([event("delivered", p, o) for p in parts for o in first[p]])
    land([event("ack", p, o, number[p, o]) for p in parts for o in early[p][:3]])
    routes.finish([ledger.start(stream(), trigger)])
    rest = [event("delivered", p, o) for p in parts for o in parts[p][8:]]
    land(rest + [event("ack", p, o, number[p, o]) for p in parts for o in early[p][3:]])
    land([event("ack", p, o, number[p, o]) for p in parts for o in late[p]])
    again = sequence["0"][0]
    land([event("ack", "0", again, 900), ("ack", "zz", None, None, None, 901)])
    routes.finish([ledger.start(stream(), trigger)])

    want = {
        (p, *commit) for p in parts for commit in ack_steps(parts[p], sequence[p], first[p], early[p])
    }
    got = ledger.commits().select("part", "at_ack", "commit_offset")
    assert {tuple(r) for r in got.collect()} == want
    refused = {(r.id, r.ack_seq) for r in ledger.refused().collect()}
    assert refused == {("zz", 901), (f"t-0-{again}", 900)}


def ack_steps(offsets, sequence, first, early):
    """The fold, with the second delivery arriving before the later early acks."""
    cut = 3
    before = commits_fold(first, sequence[:cut])
    done = before[-1][1] - 1 if before else -1
    left = [o for o in offsets if o > done]
    # Acks so far that are beyond the prefix still count.
    replay = [o for o in sequence if o in left]
    numbers = [n for n, o in enumerate(sequence) if o in left]
    after = [(numbers[n], c) for n, c in commits_fold(left, replay)]
    assert set(sequence[:cut]) <= set(first) and set(early) <= set(first)
    return before + [a for a in after if a not in before]


def test_replayed_micro_batch_replaces_its_output(spark, tmp_path):
    ledger = ledgers.AckLedger(spark, str(tmp_path / "ledger"))
    batch = spark.createDataFrame(
        [("delivered", "a", "t", "0", 1, None), ("ack", "a", "t", "0", 1, 7)], LOG
    )
    ledger.process(batch, 0)
    ledger.process(batch, 0)
    assert rows(ledger.commits()) == [("t", "0", 7, 2)]


def test_a_stuck_row_does_not_grow_the_ack_state(spark, tmp_path):
    """Row 0 stays unacked over several micro-batches: two state rows, whatever else is acked."""
    base = str(tmp_path / "ledger")
    ledger = ledgers.AckLedger(spark, base)
    sizes = []
    for n in range(4):
        offs = range(n * 50, n * 50 + 50)
        data = [("delivered", f"m{o}", "t", "0", o, None) for o in offs]
        data += [("ack", f"m{o}", None, None, None, o) for o in offs if o]
        ledger.process(spark.createDataFrame(data, LOG), n)
        sizes.append(spark.read.parquet(f"{base}/open/batch_id={n}").count())
    assert sizes == [2, 2, 2, 2]
    assert sorted(p.name for p in (tmp_path / "ledger" / "open").iterdir()) == [
        "batch_id=2",
        "batch_id=3",
    ]
    assert ledger.commits().count() == 0
    late = [("ack", "m0", None, None, None, 999), ("ack", "m7", None, None, None, 1000)]
    ledger.process(spark.createDataFrame(late, LOG), 4)
    assert rows(ledger.commits()) == [("t", "0", 999, 200)]
    assert rows(ledger.refused().select("id", "ack_seq")) == [("m7", 1000)]
    assert spark.read.parquet(f"{base}/open/batch_id=4").count() == 0


SHARD_LOG = "kind string, id string, part string, pos string, ack_seq bigint"


def test_live_shard_checkpoints_equal_ack_by_ack_fold(spark, tmp_path):
    """Digit strings of several widths, acks in three micro-batches, one row stuck for two."""
    rng = random.Random(5)
    numbers = sorted([*range(7, 12), *range(98, 103), 10**25, 10**25 + 3])
    ledger = ledgers.ShardLedger(spark, str(tmp_path / "ledger"), span=3)
    acked = {p: rng.sample(numbers, len(numbers)) for p in ("a", "b")}
    acked["a"].remove(98)
    acked["a"].append(98)

    def entry(kind, p, n, at=None):
        return (kind, f"{p}:{n}", p, str(n), at)

    data = [[entry("delivered", p, n) for p in acked for n in numbers], [], []]
    for p, order in acked.items():
        for at, n in enumerate(order):
            data[at // 4].append(entry("ack", p, n, at))
    for n, batch in enumerate(data):
        ledger.process(spark.createDataFrame(batch, SHARD_LOG), n)
    want = {(p, at, str(c - 1)) for p, order in acked.items() for at, c in commits_fold(numbers, order)}
    assert {tuple(r) for r in ledger.commits().collect()} == want
    assert rows(ledger.checkpoints()) == [("a", str(10**25 + 3)), ("b", str(10**25 + 3))]
    # The rows come again, as after a seek: the checkpoint stays.
    again = [entry("delivered", "a", 7), entry("ack", "a", 7, 90), ("ack", "a:8", None, None, 91)]
    ledger.process(spark.createDataFrame(again, SHARD_LOG), 3)
    assert ("a", str(10**25 + 3)) in rows(ledger.checkpoints())
    assert rows(ledger.refused().select("id")) == [("a:8",)]


@pytest.mark.parametrize("seed", range(2))
def test_live_breaker_equals_batch_by_batch_fold(spark, tmp_path, seed):
    rng = random.Random(seed)
    land, stream, trigger = landing(spark, tmp_path / "in", OUTCOMES)
    batches = [
        (reg, n, [rng.random() < 0.3 for _ in range(rng.randint(1, 3))])
        for reg in ("a", "b")
        for n in range(24)
    ]
    data = [
        (reg, n, i, f"{reg}{n}-{i}", ok, None if ok else "e")
        for reg, n, oks in batches
        for i, ok in enumerate(oks)
    ]
    data.sort(key=lambda r: (r[1], r[0], r[2]))
    ledger = ledgers.BreakerLedger(spark, str(tmp_path / "ledger"), 2, span=rng.choice([3, 1 << 20]))
    # Cut the log anywhere, also inside a batch, and restart in the middle.
    cuts = [0, *sorted(rng.sample(range(1, len(data)), 3)), len(data)]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        land(data[a:b])
        if n == 1:
            routes.finish([ledger.start(stream(), trigger)])
    routes.finish([ledger.start(stream(), trigger)])
    want = sorted(trips_fold(batches, 2))
    final = ledger.trips(final=True).select("reg", "batch_no")
    assert sorted(tuple(r) for r in final.collect()) == want
    # The newest batch of each registration is still open.
    live = ledger.trips().select("reg", "batch_no")
    assert sorted(tuple(r) for r in live.collect()) == [t for t in want if t[1] < 23]


def test_rows_of_a_closed_batch_come_too_late(spark, tmp_path):
    ledger = ledgers.BreakerLedger(spark, str(tmp_path / "ledger"), 2)
    part = [("a", 1, 1, "a1-1", False, "e"), ("a", 2, 0, "a2-0", False, "e"), (None, 1, 0, "n", False, "e")]
    ledger.process(spark.createDataFrame(part, OUTCOMES), 0)
    rest = [("a", 1, 0, "a1-0", True, None), ("a", 3, 0, "a3-0", False, "e"), (None, 2, 0, "n2", False, "e")]
    ledger.process(spark.createDataFrame(rest, OUTCOMES), 1)
    assert rows(ledger.late().select("reg", "batch_no", "idx")) == [("a", 1, 0)]
    assert rows(ledger.trips(final=True)) == [("a", 2, 2), ("a", 3, 3), (None, 2, 2)]


def test_quarantine(spark, tmp_path):
    land, stream, trigger = landing(spark, tmp_path / "in", schemas.MESSAGE)
    land([("m0", "t", b'{"id":"x"}', {"k": "v"}), ("m1", "t", b"nope", {})])
    land([("m2", "t", b"{}", {}), ("m3", "free", b"nope", {})])
    fields = contracts.declare(("id", "STRING"))
    table = spark.createDataFrame([("t",)], "topic string").withColumn("required_fields", fields)
    ledger = ledgers.ContractLedger(spark, str(tmp_path / "ledger"), table)
    routes.finish([ledger.start(stream(), trigger)])
    assert rows(ledger.valid().select("id", F.to_json("attributes"))) == [
        ("m0", '{"k":"v"}'),
        ("m3", "{}"),
    ]
    assert rows(ledger.quarantine().select("id", "field_name", "reason")) == [
        ("m1", None, contracts.MALFORMED),
        ("m2", "id", contracts.MISSING_FIELD),
    ]
    strict = ledgers.ContractLedger(spark, str(tmp_path / "strict"), table, fail=True)
    with pytest.raises(Exception, match="non-JSON payload"):
        routes.finish([strict.start(stream(), trigger)])


def test_ledgers_are_empty_before_the_first_micro_batch(spark, tmp_path):
    table = spark.createDataFrame([], "topic string, required_fields array<struct<name:string,type:string>>")
    contract = ledgers.ContractLedger(spark, str(tmp_path / "c"), table)
    acks = ledgers.AckLedger(spark, str(tmp_path / "a"))
    breaker = ledgers.BreakerLedger(spark, str(tmp_path / "b"))
    empty = [contract.valid(), contract.quarantine(), acks.commits(), acks.refused(), breaker.trips()]
    assert [df.count() for df in empty] == [0] * 5
    # A micro-batch without rows leaves the tables readable and empty.
    contract.process(spark.createDataFrame([], schemas.MESSAGE), 0)
    acks.process(spark.createDataFrame([], LOG), 0)
    breaker.process(spark.createDataFrame([], OUTCOMES), 0)
    empty = [contract.valid(), contract.quarantine(), acks.commits(), acks.refused(), breaker.trips()]
    assert [df.count() for df in empty] == [0] * 5


@pytest.mark.parametrize("versioned", [False])
def test_contract_checks_of_one_file_are_dealt_out(spark, tmp_path, versioned):
    """The messages of a micro-batch that come as one partition are checked by many tasks."""
    rows_ = [("message", n, f"m{n}", "t", b"{}" if n % 2 else b"[1]", {"a": "b"}) for n in range(400)]
    batch = spark.createDataFrame(
        rows_,
        "kind string, seq bigint, id string, topic string, payload binary, attributes map<string, string>",
    )
    fields = "CAST(array() AS array<struct<name:string,type:string>>) AS required_fields"
    change = ["'t' AS topic", "'register' AS op", fields]
    if versioned:
        changes = spark.range(1).selectExpr("'change' AS kind", "-1L AS seq", *change)
        batch = batch.unionByName(changes, allowMissingColumns=True).coalesce(1)
        ledger = ledgers.VersionedContractLedger(spark, str(tmp_path), few=0)
    else:
        batch = batch.select("id", "topic", "payload", "attributes").coalesce(1)
        ledger = ledgers.ContractLedger(spark, str(tmp_path), spark.range(1).selectExpr(*change))
    ledger.process(batch, 0)
    files = [path.name.split("-")[1] for path in (tmp_path / "checked").rglob("part-*.parquet")]
    assert len(set(files)) == 4  # the session's shuffle partitions
    assert (ledger.valid().count(), ledger.quarantine().count()) == (200, 200)


def test_rows_of_a_message_fold_once_and_without_sorting(spark, tmp_path, monkeypatch):
    """One aggregate by id serves commits and refusals; what passes through is removed."""
    plans, put = {}, ledgers.batches.put

    def told(df, base, *more):
        plans[os.path.basename(base)] = df._jdf.queryExecution().executedPlan().toString()
        put(df, base, *more)

    monkeypatch.setattr(ledgers.batches, "put", told)
    log = [("delivered", "m1", "t", "0", 1, None), ("delivered", "m2", None, "0", 2, None)]
    log += [("ack", "m1", "t", "0", 1, 1), ("ack", "m1", "t", "0", 1, 2), ("ack", "m9", "t", "0", 9, 3)]
    batch = spark.createDataFrame(log, "kind string, id string, topic string, part string, off bigint, ack_seq bigint")
    ledger = ledgers.AckLedger(spark, str(tmp_path))
    ledger.process(batch, 0)
    assert "HashAggregate" in plans["folded"] and "SortAggregate" not in plans["folded"]
    assert "Aggregate" not in plans["refused"]
    assert {(r.topic, r.commit_offset) for r in ledger.commits().collect()} == {("t", 2)}
    assert {(r.id, r.ack_seq) for r in ledger.refused().collect()} == {("m1", 2), ("m9", 3)}
    open_rows = spark.read.parquet(f"{tmp_path}/open/batch_id=0").collect()
    assert [(r.topic, r.off, r.id) for r in open_rows] == [(None, 2, "m2")]
    for kind in ("arrived", "folded", "prefixed"):
        assert not os.path.exists(f"{tmp_path}/{kind}/batch_id=0")
