from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from wharf import schemas
from wharf.sinks import batches, results, rows as broker_rows, writers
from wharf.sources import records


def message(spark, attributes, payload=b"p"):
    return spark.createDataFrame([("m-1", "topic-a", payload, attributes)], schemas.MESSAGE)


def test_kafka_row_key_and_headers(spark):
    got = broker_rows.kafka(message(spark, {"kafkaKey": "k-1", "h": "v"})).first()
    assert bytes(got.key) == b"k-1" and bytes(got.value) == b"p"
    assert [(h.key, bytes(h.value)) for h in got.headers] == [("h", b"v")]
    bare = broker_rows.kafka(message(spark, {})).first()
    assert bare.key is None and bare.headers == []


def test_kafka_hop_drops_the_key_unless_kept(spark):
    sent = broker_rows.kafka(message(spark, {"kafkaKey": "k", "h": "v"}))
    landed = sent.withColumns({"partition": F.lit(0), "offset": F.lit(7).cast("bigint")})
    assert records.kafka(landed).first().attributes == {"h": "v"}
    assert records.kafka(landed).first().id == "topic-a-0-7"
    assert records.kafka(landed, keep_key=True).first().attributes == {"h": "v", "kafkaKey": "k"}


@pytest.mark.parametrize(
    ("attributes", "key"), [({"partitionKey": "pk"}, "pk"), ({"partitionKey": ""}, "m-1"), ({}, "m-1")]
)
def test_kinesis_partition_key(spark, attributes, key):
    got = broker_rows.kinesis(message(spark, attributes))
    assert got.columns == ["stream", "partition_key", "data"]
    assert got.first().partition_key == key
    carried = broker_rows.kinesis(message(spark, attributes), carry_attributes=True)
    assert carried.first().attributes == attributes


def test_pulsar_and_gcp_rows(spark):
    assert broker_rows.pulsar(message(spark, {})).first().properties is None
    assert broker_rows.pulsar(message(spark, {"a": "1"})).first().properties == {"a": "1"}
    got = broker_rows.gcp(message(spark, {"a": "1"}), "proj").first()
    assert got.topic == "projects/proj/topics/topic-a" and got.attributes == {"a": "1"}


@pytest.mark.parametrize("span", [100, 1 << 20])
def test_chunks_of_two_streams(spark, span):
    data = [("stream-a" if i % 12 < 7 else "stream-b", i) for i in range(1200)]
    df = spark.createDataFrame(data, "topic string, idx bigint").repartition(6)
    got = batches.chunks(df, ["topic"], "idx", 500, span)
    sizes = got.groupBy("topic", "chunk_no").agg(F.count("*"), F.max("entry_no"))
    assert rows(sizes) == [
        ("stream-a", 0, 500, 499),
        ("stream-a", 1, 200, 199),
        ("stream-b", 0, 500, 499),
    ]
    order = got.where("topic = 'stream-b'").orderBy("chunk_no", "entry_no").collect()
    assert [r.idx for r in order] == sorted(r.idx for r in order)


def test_one_null_entry_refuses_its_batch(spark):
    data = [(1, 0, "a"), (1, 1, None), (1, 2, "c"), (2, 0, "d")]
    df = spark.createDataFrame(data, "batch int, idx int, entry string")
    got = batches.precheck(df, ["batch"], "entry").select("batch", "idx", "refusal")
    assert rows(got) == [
        (1, 0, batches.NULL_ENTRY),
        (1, 1, batches.NULL_ENTRY),
        (1, 2, batches.NULL_ENTRY),
        (2, 0, None),
    ]


def test_entry_outcomes(spark):
    entries = spark.createDataFrame(
        [
            ("s", 0, 0, None, None, "shard-0", "1"),
            ("s", 0, 1, "ProvisionedThroughputExceededException", "rate limited", None, None),
            ("s", 1, 2, None, None, "shard-0", "3"),
        ],
        "stream string, chunk_no bigint, idx int, error_code string, error_message string, "
        "shard_id string, sequence_number string",
    )
    calls = spark.createDataFrame(
        [("s", 0, None), ("s", 1, "reset")], "stream string, chunk_no bigint, call_error string"
    )
    got = batches.entry_outcomes(entries, calls).orderBy("idx")
    assert [(r.ok, r.error, r.message_id) for r in got.collect()] == [
        (True, None, "shard-0:1"),
        (
            False,
            "Kinesis PutRecords entry failed: ProvisionedThroughputExceededException: rate limited",
            None,
        ),
        (False, "reset", None),
    ]


def test_results_share_one_shape(spark):
    kafka = spark.createDataFrame(
        [("m", "t", 1, 2, 3)], "id string, topic string, partition int, offset bigint, timestamp bigint"
    )
    kinesis = spark.createDataFrame(
        [("t", "shard-0", "9")], "topic string, shard_id string, sequence_number string"
    )
    plain = spark.createDataFrame([("t", "b1")], "topic string, broker_id string")
    got = results.combined(
        results.kafka(kafka), results.kinesis(kinesis), results.pulsar(plain), results.gcp(plain)
    )
    assert got.schema.fieldNames() == schemas.RESULT.fieldNames()
    assert [(r.backend, r.message_id) for r in got.collect()] == [
        ("kafka", "m"),
        ("kinesis", "shard-0:9"),
        ("pulsar", "t-b1"),
        ("gcp", "b1"),
    ]


def test_backbone_has_a_folder_per_topic(spark, tmp_path):
    df = spark.range(100).select(
        F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("topic"), "id"
    )
    path = tmp_path / "out"
    writers.land(df, str(path))
    assert sorted(p.name for p in path.glob("topic=*")) == ["topic=t0", "topic=t1", "topic=t2"]
    # Each topic was gathered before writing, not scattered over every task.
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in path.glob("topic=*"))
    assert spark.read.parquet(str(path)).where("topic = 't1'").count() == 33


@pytest.mark.parametrize("size", [0, 501])
def test_requests_beyond_the_limits_are_refused(spark, size):
    with pytest.raises(ValueError, match="1 to 500"):
        batches.chunks(spark.range(1), ["id"], "id", size)
