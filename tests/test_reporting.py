"""A writer that reports entry outcomes: partial failures, whole calls, replays, the live breaker."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_streaming import landing
from wharf.operators import outcomes
from wharf.sinks import reporting, results
from wharf.sinks.reporting import Sent
from wharf.streaming import ledgers, routes


def client(folder, down=()):
    """Refuses data that starts with ``!``, loses whole calls to the streams in ``down``, logs calls."""

    def send(stream, entries):
        number = len(os.listdir(folder))
        with open(f"{folder}/{number}-{os.getpid()}-{stream}", "w") as file:
            file.write(" ".join(data.decode() for _, data in entries))
        if stream in down:
            raise ConnectionError("reset by peer")
        return [
            Sent(error_code="Throttled", error_message=None if data == b"!" else "rate limited")
            if data.startswith(b"!")
            else Sent(f"shard-{len(key)}", data.decode())
            for key, data in entries
        ]

    return send


@pytest.fixture
def calls(tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    return folder


def entries(reg, *data, first=0, stream="s"):
    return [(reg, first + n, f"{reg}-{first + n}", stream, "k", d) for n, d in enumerate(data)]


def start(spark, stream, tmp_path, send, trigger, name, **options):
    spark.dataSource.register(reporting.reporting_sink(name, send))
    return (
        stream.writeStream.format(name)
        .options(outcomes=str(tmp_path / "report"), **options)
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(**trigger)
        .start()
    )


def test_partial_failures_reach_the_breaker_in_one_run(spark, tmp_path, calls):
    land, stream, trigger = landing(spark, tmp_path / "in", reporting.ENTRY)
    land(entries("a", b"1", b"!x", b"3") + entries("b", b"4") + entries("c", b"9", stream="lost"))
    land(entries("a", b"!", b"5", first=3) + entries("b", b"6", first=1))
    land(entries("a", b"!y", first=5))
    send = client(calls, {"lost"})
    routes.finish([start(spark, stream(), tmp_path, send, trigger, "partly")])
    folder = str(tmp_path / "report")

    got = reporting.reported(spark, folder)
    failed = got.where("NOT ok").select("reg", "batch_no", "idx", "error")
    assert rows(failed) == [
        ("a", 0, 1, "Kinesis PutRecords entry failed: Throttled: rate limited"),
        ("a", 1, 3, "Kinesis PutRecords entry failed: Throttled: null"),
        ("a", 2, 5, "Kinesis PutRecords entry failed: Throttled: rate limited"),
        ("c", 0, 0, "reset by peer"),
    ]
    sent = results.kinesis(got.where("ok").withColumn("topic", F.col("stream")))
    assert rows(sent.select("message_id")) == [(f"shard-1:{n}",) for n in "13456"]
    told = outcomes.batch_results(got.where("batch_no = 0"))
    assert rows(told.select("reg", "succeeded", "failed", "first_failed_idx")) == [
        ("a", 2, 1, 1),
        ("b", 1, 0, None),
        ("c", 0, 1, 0),
    ]

    # The breaker reads the outcomes as a stream: a success counts only before the first failure.
    live = ledgers.BreakerLedger(spark, str(tmp_path / "breaker"), threshold=2)
    wanted = ["reg", "batch_no", "idx", "id", "ok", "error"]
    routes.finish([live.start(reporting.reported(spark, folder, stream=True).select(*wanted), trigger)])
    want = outcomes.breaker_trips(got.select(*wanted), 2)
    assert rows(live.trips(final=True)) == rows(want) == [("a", 1, 2), ("a", 2, 3)]
    # What is committed later is read by the next run.
    land(entries("b", b"!z", first=2))
    routes.finish([start(spark, stream(), tmp_path, send, trigger, "partly")])
    routes.finish([live.start(reporting.reported(spark, folder, stream=True).select(*wanted), trigger)])
    assert reporting.reported(spark, folder).where("batch_no = 3").count() == 1


def test_requests_are_cut_by_stream_in_order(spark, tmp_path, calls):
    land, stream, trigger = landing(spark, tmp_path / "in", reporting.ENTRY)
    mixed = [e for n in range(7) for e in entries("a", b"%d" % n, first=n, stream=f"s{n % 2}")]
    land(mixed)
    query = start(spark, stream().coalesce(1), tmp_path, client(calls), trigger, "cut", size="3")
    routes.finish([query])
    told = sorted((p.name.split("-")[-1], p.read_text()) for p in calls.iterdir())
    assert told == [("s0", "0 2 4"), ("s0", "6"), ("s1", "1 3 5")]
    assert reporting.reported(spark, str(tmp_path / "report")).count() == 7


def test_what_a_micro_batch_has_reported_stands(tmp_path, calls):
    """The same micro-batch is written and committed again: sent twice, reported once."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = str(tmp_path / "report")
    writer = reporting.ReportingWriter(client(calls), folder, 2)
    table = {c: [] for c in ("reg", "idx", "id", "stream", "key", "data")}
    for row in entries("a", b"1", b"!2", b"3"):
        for c, v in zip(table, row):
            table[c].append(v)
    batch = pa.RecordBatch.from_pydict(table)
    for _ in range(2):
        message = writer.write(iter([batch]))
        assert (message.ok, message.failed) == (2, 1)
        writer.commit([message, None], 4)
        landed = pq.read_table(f"{folder}/outcomes/batch_no=4", partitioning=None)
        assert landed["idx"].to_pylist() == [0, 1, 2]
        assert os.listdir(f"{folder}/pending") == []
    assert len(list(calls.iterdir())) == 4
    writer.abort([writer.write(iter([batch]))], 5)
    assert os.listdir(f"{folder}/pending") == [] and not os.path.exists(f"{folder}/outcomes/batch_no=5")
    # A micro-batch without rows reports nothing, but is known to be done.
    writer.commit([writer.write(iter([]))], 6)
    assert os.listdir(f"{folder}/outcomes/batch_no=6") == []


def test_answers_must_match_the_entries():
    made = reporting.outcomes_of(lambda stream, given: [], "s", [("a", 0, "a-0", "k", b"1")])
    assert made == [("a", 0, "a-0", "s", False, "0 answers to 1 entries", None, None)]
    for size in (0, 501):
        with pytest.raises(ValueError, match="1 to 500"):
            reporting.ReportingWriter(lambda stream, given: [], "/nowhere", size)


def test_the_stream_must_have_the_columns(spark, tmp_path, calls):
    land, stream, trigger = landing(spark, tmp_path / "in", reporting.ENTRY)
    land(entries("a", b"1"))
    with pytest.raises(Exception, match="needs the columns"):
        routes.finish([start(spark, stream().drop("key"), tmp_path, client(calls), trigger, "short")])
