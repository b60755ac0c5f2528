from __future__ import annotations

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from conftest import rows
from wharf import schemas
from wharf.functions import attributes as A
from wharf.sinks import writers
from wharf.sources import client_options, intake, positions, records, scans

NOON = datetime.datetime(2024, 1, 1, 12)


def test_kafka_record_to_envelope(spark):
    raw = spark.createDataFrame(
        [
            ("topic-a", 3, 42, b"k", b"payload", [("h", b"v"), ("n", None)]),
            ("topic-a", 0, 0, None, None, None),
        ],
        schemas.KAFKA_RECORD,
    )
    got = records.kafka(raw).collect()
    assert (got[0].id, bytes(got[0].payload), got[0].attributes) == (
        "topic-a-3-42",
        b"payload",
        {"h": "v", "n": ""},
    )
    assert (bytes(got[1].payload), got[1].attributes) == (b"", {})
    keyed = records.kafka(raw, keep_key=True).collect()
    assert keyed[0].attributes["kafkaKey"] == "k" and keyed[1].attributes == {}
    assert records.envelope(records.kafka(raw)).columns == schemas.MESSAGE_COLUMNS


def test_kinesis_record_to_envelope(spark):
    raw = spark.createDataFrame(
        [("shard-0", "100", "pk", b"x", NOON), ("shard-0", "105", "pk", None, None)],
        schemas.KINESIS_RECORD,
    )
    first, second = records.kinesis(raw, "stream-1").collect()
    assert (first.id, first.topic) == ("shard-0:100", "stream-1")
    assert first.attributes == {
        "partitionKey": "pk",
        "approximateArrivalTimestamp": "2024-01-01T12:00:00Z",
    }
    assert second.attributes == {"partitionKey": "pk"} and bytes(second.payload) == b""


def test_pulsar_ids_carry_the_topic(spark):
    raw = spark.createDataFrame(
        [("topic-a", "1:1:-1", b"a", {"k": "v"}), ("topic-b", "1:1:-1", None, None)],
        schemas.PULSAR_RECORD,
    )
    got = {r.id: (bytes(r.payload), r.attributes) for r in records.pulsar(raw).collect()}
    assert got == {"topic-a-1:1:-1": (b"a", {"k": "v"}), "topic-b-1:1:-1": (b"", {})}


def test_gcp_message_to_envelope(spark):
    raw = spark.createDataFrame([("m1", "a1", b"x", {"k": "v"})], schemas.GCP_RECORD)
    got = records.gcp(raw, "sub-1").first()
    assert (got.id, got.topic, got.pos, got.attributes) == ("m1", "sub-1", "a1", {"k": "v"})


def test_subscription_is_idempotent(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "topic string")
    assert rows(records.subscribed(df, ["a", "b", "a", "zzz"])) == [("a",), ("b",)]


def test_landed_log_as_table_and_stream(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([("t", "m", b"v", None)], schemas.PULSAR_RECORD).write.parquet(path)
    assert scans.landed(spark, path, schemas.PULSAR_RECORD).count() == 1
    stream = scans.landed(spark, path, schemas.PULSAR_RECORD, stream=True)
    assert stream.isStreaming and records.pulsar(stream).isStreaming


def counting_source():
    """Local classes travel to the workers by value."""

    class CountingQueue(SimpleDataSourceStreamReader):
        """A custom source: five raw records per pull, three pulls."""

        def initialOffset(self):
            return {"n": 0}

        def read(self, start):
            first = start["n"]
            last = min(first + 5, 15)
            rows_ = [("queue", f"{n}:0:-1", b"v", None) for n in range(first, last)]
            return iter(rows_), {"n": last}

        def readBetweenOffsets(self, start, end):
            return iter([("queue", f"{n}:0:-1", b"v", None) for n in range(start["n"], end["n"])])

        def commit(self, end):
            pass

    class CountingSource(DataSource):
        @classmethod
        def name(cls):
            return "counting_queue"

        def schema(self):
            return "topic string, message_id string, value binary, properties map<string,string>"

        def simpleStreamReader(self, schema):
            return CountingQueue()

    return CountingSource


def test_custom_source_by_format_name(spark, tmp_path):
    spark.dataSource.register(counting_source())
    stream = records.pulsar(scans.deployed(spark, "counting_queue", {}))
    path = str(tmp_path / "out")
    writer = writers.deployed_stream(
        records.envelope(stream), "parquet", {"path": path}, str(tmp_path / "cp")
    )
    query = writer.trigger(processingTime="0 seconds").start()
    query.processAllAvailable()
    query.stop()
    got = spark.read.parquet(path)
    assert rows(got.select("id")) == sorted((f"queue-{n}:0:-1",) for n in range(15))


# --- client options ---------------------------------------------------------


def test_plain_options_win_over_extras():
    got = client_options.kafka("b:9092", "g", {"bootstrap.servers": "evil", "x": "1"})
    assert got == {"kafka.bootstrap.servers": "b:9092", "kafka.group.id": "g", "kafka.x": "1"}


def test_other_connectors_merge_the_same_way():
    assert client_options.merged({"topics": "a"}, {"topics": "evil", "x": "1"}) == {
        "topics": "a",
        "x": "1",
    }


def test_iam_extras_win_over_security_but_not_over_servers():
    got = client_options.iam_login(
        "b:9098", "eu-west-1", extras={"sasl.mechanism": "OTHER", "bootstrap.servers": "evil"}
    )
    assert got["kafka.sasl.mechanism"] == "OTHER"
    assert got["kafka.bootstrap.servers"] == "b:9098"
    assert got["kafka.security.protocol"] == "SASL_SSL"
    assert got["kafka.sasl.jaas.config"] == (
        'software.amazon.msk.auth.iam.IAMLoginModule required awsRegion="eu-west-1";'
    )


def test_scram_login_and_quotes():
    got = client_options.scram_login("b", "u", "p")
    assert got["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert got["kafka.sasl.jaas.config"].endswith('required username="u" password="p";')
    assert "kafka.sasl.client.callback.handler.class" not in got
    for bad in ({"user": 'u"', "password": "p"}, {"user": "u", "password": 'p"'}):
        with pytest.raises(ValueError, match="double-quote"):
            client_options.scram_login("b", **bad)
    with pytest.raises(ValueError, match="region must not contain"):
        client_options.iam_login("b", 'eu"')


# --- start positions --------------------------------------------------------


def shard_rows(spark):
    data = [
        (s, str(n), NOON + datetime.timedelta(hours=n)) for s in ("s0", "s1", "s2") for n in (2, 9, 10)
    ]
    return spark.createDataFrame(data, "part string, pos string, arrived_at timestamp_ntz")


@pytest.mark.parametrize(
    ("start", "kept"),
    [
        (positions.Start(positions.LATEST), []),
        (positions.Start(positions.TRIM_HORIZON), ["10", "2", "9"]),
        (positions.Start(positions.AT_SEQUENCE_NUMBER, sequence="9"), ["10", "9"]),
        (positions.Start(positions.AFTER_SEQUENCE_NUMBER, sequence="09"), ["10"]),
        (positions.Start(positions.AT_TIMESTAMP, timestamp="2024-01-01 21:00:00"), ["10", "9"]),
    ],
)
def test_start_kinds(spark, start, kept):
    got = positions.start_at(shard_rows(spark).where("part = 's0'"), start)
    assert sorted(r.pos for r in got.collect()) == kept


def test_per_shard_start_wins(spark):
    own = positions.restored(spark.createDataFrame([("s1", "9")], "part string, checkpoint string"))
    got = positions.start_at(shard_rows(spark), positions.Start(positions.LATEST), own)
    assert [(r.part, r.pos) for r in got.collect()] == [("s1", "10")]


def test_positions_are_checked():
    with pytest.raises(ValueError):
        positions.Start(positions.AT_TIMESTAMP)
    with pytest.raises(ValueError):
        positions.Start(positions.AT_SEQUENCE_NUMBER)


STARTS = "topic string, part string, start_kind string, start_ts timestamp_ntz, start_seq string"


def test_kafka_start_options_from_a_table(spark):
    data = [
        ("t", "0", positions.AT_SEQUENCE_NUMBER, None, "5"),
        ("t", "1", positions.AFTER_SEQUENCE_NUMBER, None, "6"),
        ("u", "0", positions.LATEST, None, None),
        ("u", "1", positions.TRIM_HORIZON, None, None),
    ]
    got = positions.kafka_start_options(spark.createDataFrame(data, STARTS))
    assert {k: json.loads(v) for k, v in got.items()} == {
        "startingOffsets": {"t": {"0": 5, "1": 7}, "u": {"0": -1, "1": -2}}
    }
    timed = [("t", "0", positions.AT_TIMESTAMP, datetime.datetime(2024, 1, 15, 12, 0, 1, 250999), None)]
    got = positions.kafka_start_options(spark.createDataFrame(timed, STARTS))
    assert got == {"startingOffsetsByTimestamp": '{"t": {"0": 1705320001250}}'}
    with pytest.raises(ValueError):
        positions.kafka_start_options(spark.createDataFrame(data + timed, STARTS))
    assert positions.kafka_start_options(spark.createDataFrame([], STARTS)) == {}


def test_shards_that_cannot_hold_anything_are_dropped(spark):
    data = [("open", None), ("old", NOON), ("late", NOON + datetime.timedelta(days=2))]
    shards = spark.createDataFrame(data, "part string, closed_at timestamp_ntz")

    def kept(start, **kw):
        return sorted(r.part for r in positions.readable_shards(shards, start, **kw).collect())

    at = positions.Start(positions.AT_TIMESTAMP, timestamp="2024-01-02 00:00:00")
    assert kept(positions.Start(positions.LATEST)) == ["open"]
    assert kept(at) == ["late", "open"]
    assert kept(at, has_overrides=True) == ["late", "old", "open"]
    assert kept(positions.Start(positions.AFTER_SEQUENCE_NUMBER, sequence="1")) == [
        "late",
        "old",
        "open",
    ]


# --- intake -----------------------------------------------------------------


def fair_fold(queues: dict[str, list], topics: list[str], budget: int, pull: int) -> list[tuple]:
    out, share = [], max(1, budget // len(topics))
    for i in range(len(topics)):
        topic = topics[(pull % len(topics) + i) % len(topics)]
        for pos in queues.get(topic, [])[:share]:
            if len(out) < budget:
                out.append((len(out) + 1, topic, pos))
    return out


@pytest.mark.parametrize("seed", range(12))
def test_fair_share_equals_sequential_pull(spark, seed):
    rng = random.Random(seed)
    topics = [f"t{i}" for i in range(rng.randint(1, 6))]
    queues = {
        t: sorted(rng.sample(range(100), rng.choice([0, 1, 3, 20]))) for t in topics + ["other"]
    }
    budget, pull = rng.choice([1, 2, 5, 10, 40]), rng.randint(0, 9)
    data = [(t, p) for t, ps in queues.items() for p in ps]
    df = spark.createDataFrame(data, "topic string, pos_num bigint").repartition(3)
    got = intake.fair_share(df, topics, budget, pull).select("visit_no", "topic", "pos_num")
    assert sorted(tuple(r) for r in got.collect()) == fair_fold(queues, topics, budget, pull)


def test_pull_caps_are_applied_before_the_shuffle(spark):
    df = spark.range(0, 100, 1, 4).select((F.col("id") % 2).alias("k"), "id")
    got = intake.capped(df, ["k"], "id", 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(got) == [(0, 0), (0, 2), (0, 4), (1, 1), (1, 3), (1, 5)]


@pytest.mark.parametrize("span", [7, 1 << 20])
def test_caps_of_a_hot_key_are_cut_by_blocks(spark, span):
    """Nearly all rows in one key; the blocks beyond the cut are never ranked."""
    data = [("hot", n * 3) for n in range(400)] + [(None, 5), (None, -9), ("cold", 0)]
    df = spark.createDataFrame(data, "k string, n bigint").repartition(5)
    got = intake.capped(df, ["k"], "n", 50, span)
    want = [("hot", n * 3) for n in range(50)] + data[400:]
    assert rows(got) == sorted(want, key=repr)
    turns = intake.fair_share(df.withColumnRenamed("k", "topic"), ["cold", "hot"], 60, 0, "n", span)
    assert sorted(r.visit_no for r in turns.collect()) == list(range(1, 32))


def test_read_nanos_rounds_up(spark):
    df = spark.createDataFrame([(0,), (1,), (2 * 1024 * 1024,), (3_000_000,)], "b bigint")
    got = [r[0] for r in df.select(intake.read_nanos(F.col("b"))).collect()]
    assert got == [0, 477, 1_000_000_000, -(-3_000_000 * 10**9 // 2097152)]


@pytest.mark.parametrize("span", [10, 10**9])
def test_read_budget_audit(spark, span):
    rng = random.Random(span)
    data, want = [], []
    for shard in ("a", "b"):
        ready = None
        for at in sorted(rng.sample(range(0, 5_000), 60)):
            size = rng.choice([0, 1, 5])
            allowed = at + max(40, -(-size * 10**9 // 2097152) if size else 0)
            data.append((shard, at, size))
            want.append((shard, at, allowed, ready, ready is not None and at < ready))
            ready = allowed
    df = spark.createDataFrame(data, "shard string, at_nanos bigint, bytes bigint")
    got = intake.read_budget(df, 40, span)
    assert rows(got.select("shard", "at_nanos", "allowed_at", "ready_at", "is_early")) == sorted(
        want, key=repr
    )
    off = intake.read_budget(df, 0)
    assert off.where("is_early or allowed_at is not null").count() == 0


def test_attributes_as_text(spark):
    df = spark.createDataFrame([({"b": "2", "a": "1"},)], "m map<string,string>")
    assert df.select(A.as_text(F.col("m"))).first()[0] == "a=1;b=2"
