"""The keyed ack ledger against an ack-by-ack fold and the ledger that rewrites its open rows."""

from __future__ import annotations

import random

import pytest

from conftest import rows
from test_sessions import Consumer
from test_streaming import landing
from wharf.streaming import batches, blocks, ledgers, routes
from wharf.streaming.blocks import Open

LOG = "kind string, id string, topic string, part string, off bigint, ack_seq bigint"


@pytest.fixture(scope="module", autouse=True)
def store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    yield blocks.configure(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def told(kind, p, off, seq=None):
    return (kind, f"my-topic-{p}-{off}", "my-topic", str(p), off, seq)


@pytest.mark.parametrize("span, seed", [(4, 1), (32, 2), (4096, 3)])
def test_blocks_equal_the_fold(spark, tmp_path, span, seed):
    rng = random.Random(seed)
    logs = {str(p): sorted(rng.sample(range(90), 24)) for p in range(2)}
    consumer = Consumer(logs, 0)
    land, stream, trigger = landing(spark, tmp_path / "in", LOG)
    ledger = blocks.BlockLedger(spark, str(tmp_path / "blocks"), span=span, run=8)
    plain = ledgers.AckLedger(spark, str(tmp_path / "plain"))
    seq, waiting = 0, []
    for step in range(5):
        given = []
        for p in logs:
            for off in consumer.poll(p, rng.randrange(3, 8)):
                given.append(told("delivered", p, off))
                waiting.append((p, off))
        rng.shuffle(waiting)
        n = len(waiting) if step == 4 else rng.randrange(2, 10)
        for p, off in waiting[:n]:
            for _ in range(1 + (rng.random() < 0.15)):
                seq += 1
                consumer.ack(p, off, seq, 0)
                given.append(told("ack", p, off, seq))
        del waiting[:n]
        rng.shuffle(given)  # deliveries count first, whatever the order of the rows
        land(given)
        routes.finish([ledger.start(stream().select("kind", "id", "ack_seq"), trigger)])
    routes.finish([plain.start(stream(), trigger)])
    got = {(r.part, r.at_ack, r.commit_offset) for r in ledger.commits().collect()}
    assert got == consumer.commits
    assert rows(ledger.commits()) == rows(plain.commits())
    want = sorted((f"my-topic-{i[2:]}", s) for i, s in consumer.refused)
    assert sorted(map(tuple, ledger.refused().select("id", "ack_seq").collect())) == want
    open_rows = {p: sum((p, o) not in consumer.acked for o in offs) for p, offs in consumer.delivered.items()}
    flight = {r.part: r.in_flight for r in ledger.in_flight().collect()}
    assert {p: n for p, n in flight.items() if n} == {p: n for p, n in open_rows.items() if n}


def test_strange_ids_and_rows_that_come_again(spark, tmp_path):
    land, stream, trigger = landing(spark, tmp_path / "in", "kind string, id string, ack_seq bigint")
    ledger = blocks.BlockLedger(spark, str(tmp_path / "blocks"), span=2)

    def step(*given):
        land([(kind, id_, seq) for kind, id_, seq in given])
        routes.finish([ledger.start(stream(), trigger)])

    step(("delivered", "t-0-5", None), ("ack", "t-0-5", 1), ("ack", "zz", 2), ("ack", "t-0-x", 3), ("ack", "", 4))
    step(("delivered", "t-0-5", None), ("ack", "t-0-5", 5), ("delivered", "t-0-6", None))
    step(("ack", "t-0-6", 6))
    assert rows(ledger.commits().select("at_ack", "commit_offset")) == [(1, 6), (6, 7)]
    assert rows(ledger.refused().select("id", "ack_seq")) == [("", 4), ("t-0-5", 5), ("t-0-x", 3), ("zz", 2)]
    assert rows(ledger.in_flight()) == []


def test_a_replayed_micro_batch_merges_the_same_blocks(spark, tmp_path):
    ledger = blocks.BlockLedger(spark, str(tmp_path / "blocks"))
    first = [("t", "0", 0, False, [(3, 1)], 2, []), ("t", "0", 1, True, [(5, 12)], 0, [(7, "t-0-9")])]
    for _ in range(2):
        ledger.process(spark.createDataFrame(first, blocks._TOLD), 0)
        assert rows(ledger.commits().select("at_ack", "commit_offset")) == [(3, 2)]
        assert ledger.refused().count() == 1
    # The gap of the first block is filled: what waited behind it comes with that ack.
    second = [("t", "0", 0, True, [(8, 9)], 0, [])]
    for _ in range(2):
        ledger.process(spark.createDataFrame(second, blocks._TOLD), 1)
        assert rows(ledger.commits().select("at_ack", "commit_offset")) == [(3, 2), (8, 13)]
    ledger.process(spark.createDataFrame([("t", "0", 1, False, [], 1, [])], blocks._TOLD), 2)
    ledger.process(spark.createDataFrame([("t", "0", 1, True, [(9, 13)], 0, [])], blocks._TOLD), 3)
    assert rows(ledger.commits().select("at_ack", "commit_offset")) == [(3, 2), (8, 13), (9, 14)]


def test_only_touched_blocks_are_read_and_little_is_kept(spark, tmp_path):
    """State rows that a micro-batch updates: its own blocks, however many rows are in flight."""
    land, stream, trigger = landing(spark, tmp_path / "in", "kind string, id string, ack_seq bigint")
    ledger = blocks.BlockLedger(spark, str(tmp_path / "blocks"), span=16)
    land([("delivered", f"t-0-{o}", None) for o in range(800)])
    routes.finish([ledger.start(stream(), trigger)])
    land([("ack", f"t-0-{o}", o) for o in range(100, 103)])
    query = ledger.start(stream(), trigger)
    routes.finish([query])
    told_rows = [p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.numInputRows]
    assert told_rows and max(told_rows) <= 2
    base = f"{ledger.folder}/blocks"
    summaries = batches.get(spark, base, batches.newest(spark, base), blocks._SUMMARY)
    assert summaries.count() == 50 and ledger.in_flight().first().in_flight == 797


def test_prefix_of_a_block():
    block = Open()
    assert block.apply([3, 5, 9], [(7, 5, "b"), (4, 3, "a"), (8, 4, "x"), (9, 5, "b")]) == [(8, "x"), (9, "b")]
    assert block.advance() == [(4, 3), (7, 5)] and (block.low, block.peak) == (5, 7)
    assert block.apply([5, 12], [(6, 9, "c"), (10, 12, "d"), (11, 3, "a")]) == [(11, "a")]
    # An ack that is older than the prefix takes it on under the latest one.
    assert block.advance() == [(7, 9), (10, 12)] and not len(block.offs)
    assert block.advance() == []
