"""The segment log: which segments are opened, start positions, and fair pulls."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual

from conftest import rows
from wharf.sinks import log as sink
from wharf.sources import intake
from wharf.sources import log as source
from wharf.sources.positions import (
    AFTER_SEQUENCE_NUMBER,
    AT_SEQUENCE_NUMBER,
    AT_TIMESTAMP,
    LATEST,
    TRIM_HORIZON,
    Start,
)

DAY = datetime(2024, 1, 1)
WHOLE = Start(TRIM_HORIZON)


def at(pos: int) -> datetime:
    return DAY + timedelta(minutes=pos)


def table(spark, places):
    made = [(t, p, n, f"{t}-{p}-{n}", b"x%d" % n, {"n": str(n)}, at(n)) for t, p, n in places]
    return spark.createDataFrame(made, sink.LOG)


@pytest.fixture
def log(spark, tmp_path):
    """Three appends: topic a has two partitions, b one; positions grow from append to append."""
    spark.dataSource.register(source.MessageLog)
    path = str(tmp_path / "log")
    for n in range(3):
        first = n * 100
        places = [("a", "0", first + i) for i in range(20)] + [("a", "1", first + 30 + i) for i in range(20)]
        sink.append(table(spark, places + [("b", "0", first + i) for i in range(10)]).repartition(2), path, f"{n}")
    return path


def load(spark, path, default=WHOLE, overrides=None):
    return spark.read.format("message_log").options(path=path, **source.options_of(default, overrides)).load()


def spoil(spark, path, keep) -> int:
    """Make every segment unreadable but those that ``keep`` takes; how many are left."""
    left = 0
    for s in source.segments(path):
        if keep(s):
            left += 1
        else:
            with open(s.file.removeprefix("file:"), "wb") as file:
                file.write(b"not a segment")
    return left


def test_rows_come_back_as_they_were(spark, log):
    got = load(spark, log)
    assert got.schema == sink.LOG and got.count() == 150
    assert got.where("topic = 'a' AND pos = 131").first().attributes == {"n": "131"}
    # An append that is made again replaces itself.
    sink.append(table(spark, [("b", "0", 200)]), log, "2")
    assert load(spark, log).count() == 101


def test_index_rows_of_older_appends_are_gathered(spark, log):
    before = sorted(s.file for s in source.segments(log))
    for n in range(3, 9):
        sink.append(table(spark, [("b", "0", 1000 + n)]), log, f"{n}")
    assert sink.gather_index(spark, log, leave=2) == 7
    assert sink.gather_index(spark, log, leave=2) == 0  # what was gathered and two more
    names = [s.file for s in source.segments(log)]
    assert len(names) == len(set(names)) == len(before) + 6 and set(before) < set(names)
    assert load(spark, log).count() == 156 and sink.index(spark, log).count() == len(names)
    # The newest append may still be made again, and more are gathered later.
    sink.append(table(spark, [("b", "0", 1008), ("b", "0", 1009)]), log, "8")
    for n in (9, 10):
        sink.append(table(spark, [("b", "0", 1000 + 10 * n)]), log, f"{n}")
    assert sink.gather_index(spark, log) == 3
    assert load(spark, log).count() == 159


def test_filters_open_only_the_segments_they_need(spark, log):
    kept = lambda s: s.topic == "a" and s.part == "1" and s.first >= 100
    assert spoil(spark, log, kept) >= 2
    got = load(spark, log).where("topic = 'a' AND part IN ('1') AND pos > 135 AND pos <= 240")
    assert rows(got.select("pos")) == sorted([(p,) for p in [*range(136, 150), *range(230, 241)]], key=repr)
    late = load(spark, log).where(F.col("part") == "1").where(F.col("arrived_at") >= F.lit(at(235)))
    assert late.where("topic = 'a'").count() == 15
    with pytest.raises(Exception):
        load(spark, log).count()


def test_planned_slices(log):
    reader = source.LogReader(log, WHOLE, {})
    assert len(reader.partitions()) == len(source.segments(log))
    unhandled = list(reader.pushFilters([EqualTo(("topic",), "a"), GreaterThan(("pos",), 219), EqualTo(("id",), "x")]))
    assert [f.attribute for f in unhandled] == [("id",)]
    assert {(s.topic, s.part, s.low) for s in reader.partitions()} == {("a", "1", 230)}
    list(reader.pushFilters([In(("part",), ("0",)), LessThanOrEqual(("pos",), 500)]))
    assert [s.file for s in reader.partitions()] == [""]  # no segment is left


@pytest.mark.parametrize(
    "default, overrides, want",
    [
        (Start(LATEST), {}, lambda t, p, n: False),
        (Start(AT_TIMESTAMP, timestamp=at(205).isoformat()), {}, lambda t, p, n: n >= 205),
        (Start(AT_SEQUENCE_NUMBER, sequence="210"), {}, lambda t, p, n: n >= 210),
        (Start(LATEST), {("a", "1"): Start(AFTER_SEQUENCE_NUMBER, sequence="145")}, lambda t, p, n: (t, p) == ("a", "1") and n > 145),
        (WHOLE, {("b", "0"): Start(LATEST)}, lambda t, p, n: t != "b"),
    ],
)
def test_start_positions_open_only_what_they_reach(spark, log, default, overrides, want):
    every = {(r.topic, r.part, r.pos) for r in load(spark, log).collect()}
    wanted = {place for place in every if want(*place)}
    ends = {(s.topic, s.part, s.file): (s.first, s.last) for s in source.segments(log)}
    reached = {
        file for (t, p, file), (first, last) in ends.items() if any((t, p) == w[:2] and first <= w[2] <= last for w in wanted)
    }
    left = spoil(spark, log, lambda s: s.file in reached)
    assert left == len(reached) < len(ends)
    got = load(spark, log, default, overrides)
    assert {(r.topic, r.part, r.pos) for r in got.collect()} == wanted


def test_closed_partitions_are_not_opened(spark, log):
    """A partition that was closed before the start by time, though its rows say otherwise."""
    shards = [("a", "0", at(150)), ("a", "1", None), ("b", "0", at(500))]
    sink.close_parts(spark.createDataFrame(shards, "topic string, part string, closed_at timestamp_ntz"), log)
    spoil(spark, log, lambda s: (s.topic, s.part) != ("a", "0"))
    start = Start(AT_TIMESTAMP, timestamp=at(200).isoformat())
    got = load(spark, log, start)
    assert {r.topic + r.part for r in got.select("topic", "part").distinct().collect()} == {"a1", "b0"}
    with pytest.raises(Exception):  # overrides keep all partitions readable
        load(spark, log, start, {("b", "0"): Start(LATEST)}).count()


def pulls(spark, log, folder, topics, budget, **trigger):
    """Run the stream; (micro-batch, sorted places) are put in ``folder``."""
    stream = (
        spark.readStream.format("message_log")
        .options(path=log, topics=json.dumps(topics), budget=budget, checkpoint=f"{folder}/offsets")
        .load()
    )

    def put(batch, batch_id):
        batch.select("topic", "pos").write.mode("overwrite").parquet(f"{folder}/out/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", f"{folder}/offsets").trigger(**trigger).start()


@pytest.mark.parametrize("budget", [2, 7, 40])
def test_every_pull_equals_the_batch_operator(spark, tmp_path, budget):
    spark.dataSource.register(source.MessageLog)
    rng = random.Random(budget)
    path, folder = str(tmp_path / "log"), str(tmp_path)
    topics = ["t0", "t1", "t2", "t3"]
    places = []
    for t, size in zip(topics, (9, 3, 17, 0)):
        places += [(t, str(rng.randrange(2)), n) for n in rng.sample(range(200), size)]
    sink.append(table(spark, places).repartition(3), path, "first")
    # One pull a run, then several in one run, then rows that come late.
    for _ in range(2):
        pulls(spark, path, folder, topics, budget, availableNow=True).awaitTermination()
    query = pulls(spark, path, folder, topics, budget, processingTime="0 seconds")
    query.processAllAvailable()
    query.stop()
    more = [("t3", "0", 300 + n) for n in range(5)] + [("t1", "1", 300)]
    sink.append(table(spark, more), path, "second")
    query = pulls(spark, path, folder, topics, budget, processingTime="0 seconds")
    query.processAllAvailable()
    query.stop()

    out = spark.read.parquet(f"{folder}/out")
    got = {}
    for r in out.collect():
        got.setdefault(r.batch_id, set()).add((r.topic, r.pos))
    left = {(t, n) for t, _, n in places}
    late = {(t, n) for t, _, n in more}
    shape = "topic string, pos_num bigint"
    for pull in sorted(got):
        if not left:
            left, late = late, set()
        want = intake.fair_share(spark.createDataFrame(sorted(left), shape), topics, budget, pull)
        assert got[pull] == {(r.topic, r.pos_num) for r in want.collect()}
        left -= got[pull]
    assert sorted(got) == list(range(len(got))) and not left and not late


def test_a_failed_pull_is_read_again(spark, log, tmp_path):
    folder, seen = str(tmp_path), []

    def run(fail):
        stream = (
            spark.readStream.format("message_log")
            .options(path=log, topics='["a", "b"]', budget=20, checkpoint=f"{folder}/offsets")
            .load()
        )

        def put(batch, batch_id):
            seen.append((batch_id, sorted((r.topic, r.pos) for r in batch.collect())))
            if fail:
                raise RuntimeError("sink down")

        writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", f"{folder}/offsets")
        writer.trigger(availableNow=True).start().awaitTermination()

    run(False)
    with pytest.raises(Exception, match="sink down"):
        run(True)
    run(False)
    run(False)
    assert seen[1] == seen[2] and [n for n, _ in seen][:3] == [0, 1, 1]
    told = [row for n, batch in {n: b for n, b in seen}.items() for row in batch]
    assert len(told) == len(set(told))


def test_stream_starts_where_it_is_told(log):
    default = Start(AT_TIMESTAMP, timestamp=at(205).isoformat())
    reader = source.LogStreamReader(log, ["a", "b"], 6, "/nowhere/offsets", default, {("b", "0"): Start(LATEST)})
    first = reader.initialOffset()
    assert first["at"] == {"a": 204, "b": 209} and first["pull"] == 0
    assert reader.latestOffset()["at"] == {"a": 207, "b": 209}
    for wrong in ({"topics": []}, {"budget": 0}, {"checkpoint": ""}):
        given = {"path": log, "topics": ["a"], "budget": 1, "checkpoint": "c", "default": WHOLE, "overrides": {}, **wrong}
        with pytest.raises(ValueError):
            source.LogStreamReader(**given)


def test_visiting_order_when_the_budget_is_short():
    assert source.taken(["c", "a", "b"], {"a": 5, "b": 5, "c": 0}, 2) == {"c": 0, "a": 1, "b": 1}
    assert source.taken(["a", "b", "c"], {"a": 5, "b": 5, "c": 5}, 2) == {"a": 1, "b": 1, "c": 0}
    assert source.taken(["a", "b"], {"a": 1, "b": 9}, 8) == {"a": 1, "b": 4}
