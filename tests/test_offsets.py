"""Exported offsets: a query is stopped, and a new checkpoint goes on without loss."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_log import table
from wharf.sinks import log as sink
from wharf.sources import log as source
from wharf.streaming import offsets

TOPICS = ["a", "b", "c"]


def start(spark, path, folder, name, seen, **options):
    stream = (
        spark.readStream.format("message_log")
        .options(path=path, topics=json.dumps(TOPICS), budget=4, checkpoint=f"{folder}/{name}", **options)
        .load()
    )

    def put(batch, batch_id):
        seen.append((batch_id, sorted((r.topic, r.pos) for r in batch.collect())))

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", f"{folder}/{name}")
    return writer.queryName(name).trigger(processingTime="0 seconds").start()


def test_stop_export_restore_into_a_new_checkpoint(spark, tmp_path):
    spark.dataSource.register(source.MessageLog)
    path, folder, told = str(tmp_path / "log"), str(tmp_path), str(tmp_path / "exported")
    places = [(t, "0", n) for t in TOPICS for n in range(11)]
    sink.append(table(spark, places), path, "1")
    listener = offsets.OffsetExport(told, {"old", "new"})
    spark.streams.addListener(listener)
    try:
        first: list = []
        query = start(spark, path, folder, "old", first)
        while len(first) < 3:
            time.sleep(0.1)
        query.stop()
        table_ = offsets.exported(spark, told)
        for _ in range(100):  # progress is told a moment later
            known = [r.batch_id for r in table_.where("query = 'old'").collect()]
            if known:
                break
            time.sleep(0.1)
        options = offsets.log_options(table_, "old")
        end = json.loads(options["resume"])
        finished = [places for n, places in first if n <= known[0]]
        assert end["pull"] == len(finished)
        sink.append(table(spark, [("c", "0", 50)]), path, "2")
        second: list = []
        query = start(spark, path, folder, "new", second, **options)
        query.processAllAvailable()
        query.stop()
    finally:
        spark.streams.removeListener(listener)
    # Nothing is lost, and only what the old query had not told is read again.
    before = [row for pull in finished for row in pull]
    after = [row for _, pull in second for row in pull]
    assert sorted(before + after) == sorted([(t, n) for t, _, n in places] + [("c", 50)])
    # The rotation goes on where it was.
    order = {n: pull for n, pull in enumerate(finished + [p for _, p in second])}
    for n in range(3):
        turn = TOPICS[n % 3 :] + TOPICS[: n % 3]
        assert {t for t, _ in order[n]} == set(turn[: min(3, 4)])
    assert rows(offsets.exported(spark, told).select("query")) == [("new",), ("old",)]


def test_one_query_is_exported_at_a_moment(spark, tmp_path):
    spark.dataSource.register(source.MessageLog)
    path, told = str(tmp_path / "log"), str(tmp_path / "exported")
    sink.append(table(spark, [("a", "0", 1)]), path, "1")
    assert offsets.exported(spark, told).count() == 0
    with pytest.raises(ValueError, match="0 exported"):
        offsets.log_options(offsets.exported(spark, told), "now")
    query = start(spark, path, str(tmp_path), "now", [])
    query.processAllAvailable()
    offsets.export(query, told)
    query.stop()
    resume = json.loads(offsets.log_options(offsets.exported(spark, told), "now")["resume"])
    assert resume["at"]["a"] == 1
    reader = source.LogStreamReader(path, ["a", "z"], 4, "/nowhere", source.Start(source.LATEST), {}, resume)
    assert reader.initialOffset()["at"] == {"a": 1, "z": source.LOWEST} and reader.initialOffset()["pull"] == 1


def test_kafka_offsets_become_start_options(spark):
    """The shape that a Kafka source reports: the next offset of every partition."""
    ends = {"raw-a": {"0": 12, "1": 0}, "raw-b": {"0": 7}}
    told = [
        ("bridge", "r1", 4, 0, "KafkaV2[Subscribe[raw-a, raw-b]]", json.dumps(ends)),
        ("bridge", "r1", 4, 1, "message_log", json.dumps({"log": "/x", "pull": 2, "at": {"a": 1}})),
        ("other", "r2", 9, 0, "KafkaV2[Subscribe[raw-c]]", json.dumps({"raw-c": {"0": 3}})),
    ]
    table_ = spark.createDataFrame(told, offsets.EXPORTED)
    points = offsets.kafka_checkpoints(table_).where(F.col("query") == "bridge")
    assert rows(points.drop("query")) == [("raw-a", "0", "11"), ("raw-b", "0", "6")]
    options = offsets.kafka_options(table_, "bridge")
    assert {k: json.loads(v) for k, v in options.items()} == {
        "startingOffsets": {"raw-a": {"0": 12}, "raw-b": {"0": 7}}
    }
    assert json.loads(offsets.log_options(table_, "bridge")["resume"])["pull"] == 2
