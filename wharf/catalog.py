"""The registered queries: every operator over the whole of its tables.

Each takes (spark, sf_dir) and returns a DataFrame of integer and text columns.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wharf import fixtures as X
from wharf.functions import attributes as A
from wharf.operators import contracts, delivery, outcomes, routing
from wharf.schemas import MESSAGE, MESSAGE_COLUMNS
from wharf.session import configure, settle, work_folder
from wharf.sinks import batches, log as segment_log, reporting, results, rows, writers
from wharf.sources import intake, log as log_source, positions, records
from wharf.streaming import blocks as keyed_blocks, ledgers, offsets, routes as route_streams
from wharf.streaming.gate import Gate

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    _QUERIES[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _flag(c: Column, name: str) -> Column:
    return c.cast("int").alias(name)


def _bytes(name: str, alias: str = "payload_hex") -> Column:
    return F.hex(name).alias(alias)


def _attributes() -> Column:
    return A.as_text(F.col("attributes")).alias("attributes")


# --- scans ------------------------------------------------------------------


def kafka_records(events: DataFrame) -> DataFrame:
    """Raw Kafka records: tombstones, missing, repeated, null and non-text headers."""
    n = F.col("event_id")

    def header(key: str, value: Column, when: Column) -> Column:
        entry = F.struct(F.lit(key).alias("key"), value.cast("binary").alias("value"))
        return F.when(when, F.array(entry)).otherwise(F.array().cast(entry_type))

    entry_type = "array<struct<key:string,value:binary>>"
    always = F.lit(True)
    headers = F.concat(
        header("schema", F.lit("v1"), always),
        header("trace", F.when(n % 7 != 0, n.cast("string")), always),
        header("schema", F.lit("v2"), n % 3 == 0),
        header("raw", F.unhex(F.lit("FF41")), n % 5 == 0),
    )
    return events.select(
        F.concat(F.lit("app-"), F.col("event_type")).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        n.alias("offset"),
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.when(n % 10 != 0, F.col("props")).cast("binary").alias("value"),
        F.when(n % 11 != 0, headers).alias("headers"),
    )


def _envelope(df: DataFrame) -> DataFrame:
    return df.select("id", "topic", "part", "pos", _bytes("payload"), _attributes())


@query
def kafka_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return _envelope(records.kafka(kafka_records(X.table(spark, sf, "events"))))


@query
def kafka_envelope_with_key(spark: SparkSession, sf: str) -> DataFrame:
    raw = kafka_records(X.table(spark, sf, "events"))
    return _envelope(records.kafka(raw, keep_key=True))


@query
def kinesis_envelope(spark: SparkSession, sf: str) -> DataFrame:
    n, ts = F.col("event_id"), F.col("ts")
    arrival = (
        F.when(n % 6 == 0, F.lit(None).cast("timestamp_ntz"))
        .when(n % 4 == 1, F.date_trunc("second", ts).cast("timestamp_ntz"))
        .when(n % 4 == 2, F.date_trunc("millisecond", ts).cast("timestamp_ntz"))
        .otherwise(ts)
    )
    raw = X.table(spark, sf, "events").select(
        F.concat(F.lit("shard-"), (F.col("user_id") % 16).cast("string")).alias("shard_id"),
        X.sequence_number(n).alias("sequence_number"),
        F.col("user_id").cast("string").alias("partition_key"),
        F.when(n % 10 != 0, F.col("props")).cast("binary").alias("data"),
        arrival.alias("arrival"),
    )
    return _envelope(records.kinesis(raw, "app-stream"))


@query
def pulsar_envelope(spark: SparkSession, sf: str) -> DataFrame:
    turn = F.col("turn")
    raw = X.table(spark, sf, "conversations").select(
        F.concat(F.lit("chat-"), F.col("role")).alias("topic"),
        F.concat_ws(":", "conv_id", "turn", F.lit("-1")).alias("message_id"),
        F.when(turn % 5 != 4, F.col("text")).cast("binary").alias("value"),
        F.when(
            turn % 2 == 0, F.create_map(F.lit("conv"), F.col("conv_id").cast("string"))
        ).alias("properties"),
    )
    return _envelope(records.pulsar(raw))


@query
def gcp_envelope(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("event_id").cast("string")
    raw = X.table(spark, sf, "events").select(
        F.concat(F.lit("m"), n).alias("message_id"),
        F.concat(F.lit("ack"), n).alias("ack_id"),
        F.col("props").cast("binary").alias("data"),
        F.when(F.col("event_id") % 4 != 0, F.create_map(F.lit("k"), F.col("event_type"))).alias(
            "attributes"
        ),
    )
    out = records.gcp(raw, "events-sub")
    return out.select("id", "topic", "pos", _bytes("payload"), _attributes())


@query
def multi_topic_scan(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ["app-click", "chat-user", "orders-F", "app-click", "app-nothing"]
    return records.subscribed(X.all_messages(spark, sf), wanted).select(
        "id", "topic", "part", "off"
    )


def start_overrides(region: DataFrame) -> DataFrame:
    """One override per region row; shard 3 has none, two shards do not exist."""
    key = F.col("r_regionkey")
    number = F.when(key == 3, F.lit(998)).when(key == 4, F.lit(999)).otherwise(key)
    return region.select(
        F.concat(F.lit("shard-"), number.cast("string")).alias("part"),
        F.when(key == 0, positions.AT_SEQUENCE_NUMBER)
        .when(key == 1, positions.AFTER_SEQUENCE_NUMBER)
        .when(key == 2, positions.AT_TIMESTAMP)
        .otherwise(positions.LATEST)
        .alias("start_kind"),
        F.when(key == 2, F.lit("2024-01-15 00:00:00")).cast("timestamp_ntz").alias("start_ts"),
        F.when(key < 2, X.sequence_number(F.lit(500))).alias("start_seq"),
    )


@query
def start_positions(spark: SparkSession, sf: str) -> DataFrame:
    delivered = X.kinesis_delivered(X.table(spark, sf, "events"))
    kept = positions.start_at(
        delivered,
        positions.Start(positions.AT_TIMESTAMP, timestamp="2024-01-10 12:00:00"),
        start_overrides(X.table(spark, sf, "region")),
    )
    return kept.select("id", "part", "pos")


def shard_lifetimes(events: DataFrame) -> DataFrame:
    shard = F.col("user_id") % 64
    return (
        events.groupBy(shard.alias("number"))
        .agg(F.min("ts").alias("opened_at"), F.max("ts").alias("last_ts"))
        .select(
            F.concat(F.lit("shard-"), F.col("number").cast("string")).alias("part"),
            "opened_at",
            F.when(F.col("number") % 3 == 0, F.col("last_ts"))
            .when(F.col("number") % 3 == 1, F.col("opened_at"))
            .alias("closed_at"),
        )
    )


@query
def shard_pruning(spark: SparkSession, sf: str) -> DataFrame:
    shards = shard_lifetimes(X.table(spark, sf, "events"))
    middle = positions.Start(positions.AT_TIMESTAMP, timestamp="2024-01-15 00:00:00")
    latest = positions.Start(positions.LATEST)
    plans = {
        "latest": positions.readable_shards(shards, latest),
        "timestamp": positions.readable_shards(shards, middle),
        "horizon": positions.readable_shards(shards, positions.Start(positions.TRIM_HORIZON)),
        "overrides": positions.readable_shards(shards, latest, has_overrides=True),
    }
    named = [df.select(F.lit(name).alias("plan"), "part") for name, df in plans.items()]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


@query
def intake_caps(spark: SparkSession, sf: str) -> DataFrame:
    messages = X.event_messages(X.table(spark, sf, "events"))
    return intake.capped(messages, delivery.PARTITION, "off", 40).select(
        "topic", "part", "off", "id"
    )


@query
def fair_share(spark: SparkSession, sf: str) -> DataFrame:
    topics = ["app-click", "app-view", "app-nothing", "chat-system", "chat-user", "orders-P"]
    topics.append("app-error")
    taken = intake.fair_share(X.all_messages(spark, sf), topics, 150, 11, "off")
    return taken.select("visit_no", "topic", "off", "id")


@query
def read_budget_audit(spark: SparkSession, sf: str) -> DataFrame:
    audited = intake.read_budget(X.fetch_log(X.table(spark, sf, "events")))
    return audited.select(
        "shard", "at_nanos", "bytes", "allowed_at", "ready_at", _flag(F.col("is_early"), "is_early")
    )


# --- sinks ------------------------------------------------------------------


def _keyed(events: DataFrame) -> DataFrame:
    """Event messages with a partition key, an empty one, or none; some without attributes."""
    n = F.col("event_id")
    key = F.when(n % 3 == 0, F.col("user_id").cast("string")).when(n % 3 == 1, F.lit(""))
    with_key = A.put(F.col("attributes"), {"partitionKey": key})
    attributes = (
        F.when(n % 5 == 0, A.empty()).when(n % 3 == 2, F.col("attributes")).otherwise(with_key)
    )
    return X.event_messages(events).withColumn("attributes", attributes)


def _segment_log(spark: SparkSession, events: DataFrame, name: str) -> str:
    """The event messages as a segment log, in two appends."""
    folder = work_folder(spark, name)
    messages = X.event_messages(events).select(
        "topic", "part", F.col("off").alias("pos"), "id", "payload", "attributes", F.col("ts").alias("arrived_at")
    )
    half = F.col("pos") % 2
    for n in range(2):
        segment_log.append(messages.where(half == n), folder, f"{n}")
    spark.dataSource.register(log_source.MessageLog)
    return folder


@query
def log_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A scan of the segment log: one partition starts later, filters are pushed into the plan."""
    folder = _segment_log(spark, X.table(spark, sf, "events"), "log-scan")
    later = {("app-click", "0"): positions.Start(positions.AFTER_SEQUENCE_NUMBER, sequence="500")}
    starts = log_source.options_of(positions.Start(positions.TRIM_HORIZON), later)
    log = spark.read.format("message_log").options(path=folder, **starts).load()
    wanted = log.where(F.col("topic").isin("app-click", "app-view") & (F.col("pos") >= 100))
    return wanted.select(
        "topic", "part", "pos", "id", F.md5("payload").alias("payload_md5"), _attributes()
    )


@query
def kafka_rows(spark: SparkSession, sf: str) -> DataFrame:
    sent = rows.kafka(X.event_messages(X.table(spark, sf, "events")))
    headers = F.transform(
        "headers", lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string"))
    )
    return sent.select(
        "topic",
        _bytes("key", "key_hex"),
        _bytes("value", "value_hex"),
        F.array_join(F.sort_array(headers), ";").alias("headers"),
    )


@query
def kinesis_rows(spark: SparkSession, sf: str) -> DataFrame:
    sent = rows.kinesis(_keyed(X.table(spark, sf, "events")))
    return sent.select("stream", "partition_key", _bytes("data", "data_hex"))


@query
def pulsar_rows(spark: SparkSession, sf: str) -> DataFrame:
    sent = rows.pulsar(_keyed(X.table(spark, sf, "events")))
    return sent.select(
        "topic", _bytes("value", "value_hex"), A.as_text(F.col("properties")).alias("properties")
    )


@query
def gcp_rows(spark: SparkSession, sf: str) -> DataFrame:
    sent = rows.gcp(_keyed(X.table(spark, sf, "events")), "demo-project")
    return sent.select("topic", _bytes("data", "data_hex"), _attributes())


@query
def landed_backbone(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "backbone")
    messages = X.all_messages(spark, sf).select("id", "topic", "part", "off", "payload")
    writers.land(messages, folder)
    back = spark.read.schema(messages.schema).parquet(folder)
    return back.select("id", "topic", "part", "off", F.md5("payload").alias("payload_md5"))


@query
def chunk_plan(spark: SparkSession, sf: str) -> DataFrame:
    messages = X.order_messages(X.table(spark, sf, "orders"))
    return batches.chunks(messages, ["topic"], "off").select(
        "topic", "off", "id", "chunk_no", "entry_no"
    )


@query
def batch_precheck(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    batch = X.order_messages(X.table(spark, sf, "orders")).select(
        F.call_function("div", key, F.lit(50)).alias("batch_no"),
        key.alias("idx"),
        F.when(key % 211 != 0, F.col("id")).alias("entry"),
    )
    return batches.precheck(batch, ["batch_no"], "entry").select(
        "batch_no", "idx", "entry", "refusal"
    )


@query
def publish_results(spark: SparkSession, sf: str) -> DataFrame:
    events = X.event_messages(X.table(spark, sf, "events"))
    n, kind = F.col("event_id"), F.col("event_id") % 4
    kafka = events.where(kind == 0).select(
        "id",
        "topic",
        F.col("part").cast("int").alias("partition"),
        F.col("off").alias("offset"),
        (n * 1000).alias("timestamp"),
    )
    kinesis = events.where(kind == 1).select(
        "topic",
        F.concat(F.lit("shard-"), F.col("part")).alias("shard_id"),
        X.sequence_number(n).alias("sequence_number"),
    )
    broker = F.concat(F.lit("b"), n.cast("string")).alias("broker_id")
    return results.combined(
        results.kafka(kafka),
        results.kinesis(kinesis),
        results.pulsar(events.where(kind == 2).select("topic", broker)),
        results.gcp(events.where(kind == 3).select("topic", broker)),
    )


@query
def entry_failures(spark: SparkSession, sf: str) -> DataFrame:
    messages = X.event_messages(X.table(spark, sf, "events")).select(
        F.col("topic").alias("stream"), "off", "event_id", "user_id"
    )
    n = F.col("event_id")
    code = F.when(n % 19 == 0, "ProvisionedThroughputExceededException").when(
        n % 23 == 0, "InternalFailure"
    )
    ok = code.isNull()
    shard = F.concat(F.lit("shard-"), (F.col("user_id") % 4).cast("string"))
    chunked = batches.chunks(messages, ["stream"], "off").withColumns(
        {
            "error_code": code,
            "error_message": F.when(n % 19 == 0, "rate limited"),
            "shard_id": F.when(ok, shard),
            "sequence_number": F.when(ok, X.sequence_number(n)),
        }
    )
    calls = (
        chunked.select("stream", "chunk_no")
        .distinct()
        .withColumn(
            "call_error",
            F.when((F.col("chunk_no") + F.length("stream")) % 5 == 0, "connection reset"),
        )
    )
    return batches.entry_outcomes(chunked, calls).select(
        "event_id", "stream", "chunk_no", _flag(F.col("ok"), "ok"), "error", "message_id"
    )


# --- routing ----------------------------------------------------------------


def _bridge_routes(spark: SparkSession, sf: str) -> DataFrame:
    return X.bridge_routes(X.table(spark, sf, "nation"), X.table(spark, sf, "region"))


def _accepted_bridge(spark: SparkSession, sf: str) -> DataFrame:
    return settle(routing.accepted(routing.check_bridge_routes(_bridge_routes(spark, sf))))


def _accepted_relay(spark: SparkSession, sf: str) -> DataFrame:
    routes = X.relay_routes(X.table(spark, sf, "nation"))
    return settle(routing.accepted(routing.check_relay_routes(routes)))


def _backbone(spark: SparkSession, sf: str) -> DataFrame:
    return routing.fan_in(X.all_messages(spark, sf), _accepted_bridge(spark, sf))


@query
def bridge_fan_in(spark: SparkSession, sf: str) -> DataFrame:
    return _backbone(spark, sf).select(
        "id", "topic", F.md5("payload").alias("payload_md5"), _attributes()
    )


@query
def bridge_topic_counts(spark: SparkSession, sf: str) -> DataFrame:
    source = F.element_at("attributes", "bridge.sourceId").alias("source_id")
    return _backbone(spark, sf).groupBy("topic", source).agg(F.count("*").alias("messages"))


@query
def relay_fan_out(spark: SparkSession, sf: str) -> DataFrame:
    out = routing.fan_out(_backbone(spark, sf), _accepted_relay(spark, sf))
    return out.select("id", "topic", F.md5("payload").alias("payload_md5"), _attributes())


@query
def path_report(spark: SparkSession, sf: str) -> DataFrame:
    return routing.paths(routing.fan_out(_backbone(spark, sf), _accepted_relay(spark, sf)))


@query
def bridge_route_checks(spark: SparkSession, sf: str) -> DataFrame:
    return routing.check_bridge_routes(_bridge_routes(spark, sf)).select(
        "reg_no", "source_id", "channel", "target_topic", "refusal"
    )


@query
def relay_route_checks(spark: SparkSession, sf: str) -> DataFrame:
    routes = X.relay_routes(X.table(spark, sf, "nation"))
    return routing.check_relay_routes(routes).select(
        "reg_no", "destination_id", "source_topic", "refusal"
    )


@query
def topic_plan(spark: SparkSession, sf: str) -> DataFrame:
    plan = routing.topic_plan(_bridge_routes(spark, sf), 6, 2)
    return plan.select(
        "reg_no", "effective_partitions", "effective_replication", "option_refusal"
    )


@query
def topics_to_create(spark: SparkSession, sf: str) -> DataFrame:
    plan = routing.topic_plan(_accepted_bridge(spark, sf), 6, 2)
    topic = F.replace("topic", F.lit("-"), F.lit("."))
    made = F.col("topic").endswith("e") | F.col("topic").endswith("k")
    there = X.all_messages(spark, sf).select(
        F.when(made, topic).otherwise(F.concat(F.lit("old."), topic)).alias("topic")
    )
    return routing.to_create(plan, there).select(
        "target_topic", "effective_partitions", "effective_replication"
    )


# --- delivery ledger --------------------------------------------------------


def _delivered(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = X.table(spark, sf, "events")
    return X.event_messages(events).select("id", "topic", "part", "off"), X.acks(events)


def _kinesis(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = X.table(spark, sf, "events")
    delivered = X.kinesis_delivered(events).select("id", "part", "pos", "arrived_at")
    return delivered, X.kinesis_acks(events)


@query
def ack_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    out = delivery.checkpoints(*_delivered(spark, sf), F.col("off"))
    return out.withColumn("commit_offset", F.col("checkpoint") + 1)


@query
def kafka_start_options(spark: SparkSession, sf: str) -> DataFrame:
    """Each topic's next scan goes on after the checkpoints."""
    reached = delivery.checkpoints(*_delivered(spark, sf), F.col("off"))
    return positions.kafka_start_texts(positions.kafka_restored(reached))


def _sessions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = X.table(spark, sf, "events")
    delivered = X.event_messages(events).select("id", "topic", "part", "off", "event_id")
    again = settle(delivery.redelivered(delivered, X.acks(events)).select(*delivered.columns))
    return X.two_sessions(delivered, again, X.noisy_acks(events))


@query
def redelivered_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """Checkpoints after a reset: acks beyond the first session's prefix are forgotten."""
    return delivery.session_checkpoints(*_sessions(spark, sf), F.col("off"))


@query
def refused_session_acks(spark: SparkSession, sf: str) -> DataFrame:
    return delivery.refused_acks(*_sessions(spark, sf), "session").select(
        "id", "session", "ack_seq", "cause", "message"
    )


@query
def kinesis_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    return delivery.shard_checkpoints(*_kinesis(spark, sf))


@query
def match_acks(spark: SparkSession, sf: str) -> DataFrame:
    events = X.table(spark, sf, "events")
    delivered = X.event_messages(events).select("id", "topic", "part", "off")
    return delivery.acked(delivered, X.noisy_acks(events)).select(
        "id", "topic", "part", "off", "ack_seq"
    )


def late_ledger(events: DataFrame) -> DataFrame:
    """Nearly everything acked, so that prefixes grow long."""
    open_row = F.col("event_id") % 4999 == 4998
    return X.event_messages(events).select(
        "topic", "part", "off", F.when(~open_row, X.ack_seq()).alias("ack_seq")
    )


@query
def commit_history(spark: SparkSession, sf: str) -> DataFrame:
    return delivery.commits(late_ledger(X.table(spark, sf, "events")))


@query
def commit_attempts(spark: SparkSession, sf: str) -> DataFrame:
    """The same history when every commit of a third of the acks fails."""
    ledger = late_ledger(X.table(spark, sf, "events")).withColumn(
        "commit_ok", F.col("ack_seq") % 3 != 0
    )
    tried = delivery.commit_attempts(ledger)
    return tried.select(
        "topic", "part", "ack_seq", "commit_offset", _flag(F.col("commit_ok"), "commit_ok")
    )


@query
def inflight(spark: SparkSession, sf: str) -> DataFrame:
    out = delivery.in_flight(*_delivered(spark, sf), cap=180, keys=["topic"])
    return out.select("topic", "in_flight", _flag(F.col("cap_reached"), "cap_reached"))


@query
def bad_acks(spark: SparkSession, sf: str) -> DataFrame:
    events = X.table(spark, sf, "events")
    delivered = X.event_messages(events).select("id")
    return delivery.refused_acks(delivered, X.noisy_acks(events)).select(
        "id", "ack_seq", "cause", "message"
    )


def saved_checkpoints(events: DataFrame) -> DataFrame:
    """Checkpoints of an earlier session: ahead of the new ones on some shards."""
    n, shard = F.col("event_id"), (F.col("user_id") % 16).cast("string")
    saved = n % 16 < F.col("user_id") % 16
    return (
        events.groupBy(F.concat(F.lit("shard-"), shard).alias("part"))
        .agg(F.coalesce(F.min(F.when(saved, n)), F.max(n)).alias("n"))
        .select("part", F.concat(F.lit("00"), F.col("n").cast("string")).alias("checkpoint"))
    )


@query
def checkpoint_merge(spark: SparkSession, sf: str) -> DataFrame:
    new = delivery.shard_checkpoints(*_kinesis(spark, sf))
    return delivery.merge_checkpoints(new, saved_checkpoints(X.table(spark, sf, "events")))


@query
def redelivery_plan(spark: SparkSession, sf: str) -> DataFrame:
    return delivery.seek_positions(*_delivered(spark, sf))


@query
def redelivered_rows(spark: SparkSession, sf: str) -> DataFrame:
    return delivery.redelivered(*_delivered(spark, sf)).select("id", "topic", "part", "off")


def _shards(spark: SparkSession, sf: str) -> DataFrame:
    """The shards that delivered, and 999 and 1000 that did not."""
    seen = _kinesis(spark, sf)[0].select("part")
    idle = X.table(spark, sf, "region").select(
        F.concat(F.lit("shard-"), (F.col("r_regionkey") % 2 + 999).cast("string")).alias("part")
    )
    return seen.unionByName(idle)


def _default_start() -> positions.Start:
    return positions.Start(positions.AT_TIMESTAMP, timestamp="2024-01-10 12:00:00")


def _resume_columns(df: DataFrame) -> DataFrame:
    ts = F.date_format("start_ts", "yyyy-MM-dd HH:mm:ss").alias("start_ts")
    return df.select("part", "start_kind", ts, "start_seq")


@query
def resume_positions(spark: SparkSession, sf: str) -> DataFrame:
    out = delivery.resume_positions(
        _shards(spark, sf),
        *_kinesis(spark, sf),
        _default_start(),
        start_overrides(X.table(spark, sf, "region")),
    )
    return _resume_columns(out)


@query
def cap_reacquired(spark: SparkSession, sf: str) -> DataFrame:
    return _resume_columns(delivery.touched_at_cap(*_kinesis(spark, sf), _default_start()))


@query
def checkpoint_restore(spark: SparkSession, sf: str) -> DataFrame:
    delivered, acks = _kinesis(spark, sf)
    exported = delivery.shard_checkpoints(delivered, acks)
    folder = work_folder(spark, "checkpoints")
    exported.write.parquet(folder)
    restored = positions.restored(spark.read.schema(exported.schema).parquet(folder))
    left = positions.start_at(delivered, positions.Start(positions.TRIM_HORIZON), restored)
    return left.groupBy("part").agg(F.count("*").alias("to_read"))


@query
def latest_ack(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("event_id")
    deliveries = X.table(spark, sf, "events").select(
        F.concat(F.lit("m"), (n * 31 % 2503).cast("string")).alias("id"),
        F.concat(F.lit("ack"), n.cast("string")).alias("ack_id"),
        F.col("ts").alias("delivered_at"),
    )
    return delivery.latest_handles(deliveries)


# --- publish outcomes -------------------------------------------------------


@query
def batch_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return outcomes.batch_results(X.outcomes(X.table(spark, sf, "events"))).select(
        "reg", "batch_no", "succeeded", "failed", "first_failed_idx", "cause", "message"
    )


@query
def batch_outcome_entries(spark: SparkSession, sf: str) -> DataFrame:
    return outcomes.batch_entries(X.outcomes(X.table(spark, sf, "events"))).select(
        "reg", "batch_no", "idx", "id", "success_no", "error"
    )


@query
def batch_cut(spark: SparkSession, sf: str) -> DataFrame:
    return outcomes.batch_cut(X.outcomes(X.table(spark, sf, "events"))).select(
        "reg", "batch_no", "idx", "id", "state"
    )


@query
def breaker_trips(spark: SparkSession, sf: str) -> DataFrame:
    return outcomes.breaker_trips(X.outcomes(X.table(spark, sf, "events")), 3)


@query
def relay_attempts(spark: SparkSession, sf: str) -> DataFrame:
    ledger = outcomes.relay_ledger(X.relay_attempts(X.table(spark, sf, "events")))
    return ledger.select(
        "reg",
        "msg_no",
        "attempts",
        "first_at",
        "delivered_at",
        "wait",
        _flag(F.col("in_order"), "in_order"),
    )


def _relay_acks(spark: SparkSession, sf: str) -> DataFrame:
    published = X.outcomes(X.table(spark, sf, "events")).where("ok")
    return published.withColumn("ack_ok", F.col("event_id") % 37 != 0)


@query
def ack_failures(spark: SparkSession, sf: str) -> DataFrame:
    return outcomes.ack_failures(_relay_acks(spark, sf))


@query
def duplicate_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return outcomes.duplicate_candidates(_relay_acks(spark, sf)).select("reg", "batch_no", "id")


# --- contracts --------------------------------------------------------------


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    events = X.table(spark, sf, "events")
    return contracts.check(
        X.payload_cases(events).select("id", "topic", "payload", "attributes"),
        settle(X.payload_schemas(events)),
    )


@query
def contract_violations(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.violations(_checked(spark, sf))


def _versioned(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Payloads in the order of their events, and the changes of their contracts among them."""
    events = X.table(spark, sf, "events")
    messages = X.payload_cases(events).select(
        "id", "topic", "payload", "attributes", F.col("event_id").alias("seq")
    )
    return messages, X.schema_changes(events)


@query
def contract_asof(spark: SparkSession, sf: str) -> DataFrame:
    """Every message by the contract valid at it; contracts change all the time."""
    return contracts.violations(contracts.check_as_of(*_versioned(spark, sf)))


@query
def contract_asof_few(spark: SparkSession, sf: str) -> DataFrame:
    """The same with one change in 500 events, few enough to be broadcast as intervals."""
    messages, changes = _versioned(spark, sf)
    rare = changes.where(F.col("seq") % 500 == 0)
    return contracts.violations(contracts.check_as_of(messages, rare, few=1 << 20))


@query
def contract_report(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.report(_checked(spark, sf))


@query
def quarantine_split(spark: SparkSession, sf: str) -> DataFrame:
    """Where each message goes; one pass decides both sides."""
    side = F.when(F.col("violation").isNull(), "valid").otherwise("quarantine")
    return _checked(spark, sf).select("id", side.alias("side"))


@query
def contract_fail_policy(spark: SparkSession, sf: str) -> DataFrame:
    """Policy FAIL over payloads that all pass."""
    events = X.table(spark, sf, "events")
    good = X.event_messages(events)
    fields = contracts.declare(("k", "NUMBER"))
    schemas = X.payload_schemas(events).withColumn("required_fields", fields)
    return contracts.fail_on_invalid(contracts.check(good, settle(schemas))).select("id", "topic")


@query
def registry_state(spark: SparkSession, sf: str) -> DataFrame:
    current = contracts.registry(X.schema_changes(X.table(spark, sf, "events")))
    return current.select("topic", contracts.encode(F.col("required_fields")).alias("definition"))


@query
def registered_topics(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.registry(X.schema_changes(X.table(spark, sf, "events"))).select("topic")


@query
def schema_encode(spark: SparkSession, sf: str) -> DataFrame:
    changes = X.schema_changes(X.table(spark, sf, "events")).where("op = 'register'")
    return changes.select(
        "seq", "topic", contracts.encode(F.col("required_fields")).alias("definition")
    )


@query
def schema_decode(spark: SparkSession, sf: str) -> DataFrame:
    decoded = contracts.decode(X.definitions(X.table(spark, sf, "events")), "definition")
    fields = F.transform("required_fields", lambda f: F.concat_ws(":", f["name"], f["type"]))
    return decoded.select("event_id", "reason", F.array_join(fields, ",").alias("fields"))


# --- streams ----------------------------------------------------------------

#: Steps in which a stream's table arrives; the stream is stopped and started again for each.
STEPS = 3


def _arrive(whole: DataFrame, name: str, position: str = "event_id") -> Iterator[DataFrame]:
    """``whole`` as a file stream, by ``position`` in STEPS steps: one stream per step."""
    spark = whole.sparkSession
    low, high = whole.agg(F.min(position), F.max(position)).first()
    low, high = low or 0, high or 0
    step = F.call_function("div", (F.col(position) - low) * STEPS, F.lit(high - low + 1))
    folder = work_folder(spark, f"arriving-{name}")
    for n in range(STEPS):
        rows = whole.where(F.coalesce(step, F.lit(0)) == n)
        rows.write.mode("append").parquet(folder)
        yield spark.readStream.schema(whole.schema).parquet(folder)


def _messages(events: DataFrame) -> DataFrame:
    return X.event_messages(events).select("id", "topic", "payload", "attributes")


def _published(df: DataFrame) -> DataFrame:
    return df.select("id", "topic", F.md5("payload").alias("payload_md5"), _attributes())


def _landing(folder: str) -> route_streams.Sink:
    return lambda df, checkpoint: writers.land_stream(df, folder, checkpoint)


@query
def stream_bridge(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "bridge")
    sink, routes = _landing(f"{folder}/backbone"), _accepted_bridge(spark, sf)
    _, trigger = route_streams.intake()
    for events in _arrive(X.table(spark, sf, "events"), "events"):
        stream = _messages(events)
        running = route_streams.bridge_together(stream, routes, sink, f"{folder}/offsets", trigger)
        route_streams.finish([running])
    return _published(spark.read.schema(MESSAGE).parquet(f"{folder}/backbone"))


@query
def stream_bridge_each(spark: SparkSession, sf: str) -> DataFrame:
    """One query per route, each with a landing folder of its own."""
    folder = work_folder(spark, "bridge-each")
    routes = _accepted_bridge(spark, sf).collect()  # configuration, one query each
    _, trigger = route_streams.intake()
    for events in _arrive(X.table(spark, sf, "events"), "events"):
        stream = _messages(events)
        started = [
            route_streams.bridge_each(
                lambda topic: stream.where(F.col("topic") == topic),
                [route],
                _landing(f"{folder}/out/{route.target_topic}"),
                f"{folder}/offsets",
                trigger,
            )
            for route in routes
        ]
        route_streams.finish(q for queries in started for q in queries)
    outs = [spark.read.schema(MESSAGE).parquet(f"{folder}/out/{r.target_topic}") for r in routes]
    return _published(reduce(DataFrame.unionByName, [o.select(*MESSAGE_COLUMNS) for o in outs]))


@query
def stream_bounded_intake(spark: SparkSession, sf: str) -> DataFrame:
    """The bridge over a landed table, at most one file per micro-batch."""
    folder = work_folder(spark, "intake")
    options, trigger = route_streams.intake(max_files=1)
    X.table(spark, sf, "events").repartition(STEPS, "event_id").write.parquet(f"{folder}/in")
    schema = X.table(spark, sf, "events").schema
    stream = _messages(spark.readStream.schema(schema).options(**options).parquet(f"{folder}/in"))
    running = route_streams.bridge_together(
        stream,
        _accepted_bridge(spark, sf),
        _landing(f"{folder}/backbone"),
        f"{folder}/offsets",
        trigger,
    )
    route_streams.finish([running])
    return _published(spark.read.schema(MESSAGE).parquet(f"{folder}/backbone"))


@query
def stream_relay(spark: SparkSession, sf: str) -> DataFrame:
    """Bridge once into the backbone; each destination then reads its own topic folder there."""
    folder = work_folder(spark, "relay")
    backbone = f"{folder}/backbone"
    bridges = _accepted_bridge(spark, sf)

    def source(topic: str) -> DataFrame:
        landed = spark.readStream.schema(MESSAGE).parquet(backbone)
        return landed.where(F.col("topic") == topic).select(*MESSAGE_COLUMNS)

    def target(route) -> str:
        return f"{folder}/out/{route.destination_id}/{route.downstream_topic}"

    # Routes are configuration: one query each, so their number is what a cluster can run.
    routes = _accepted_relay(spark, sf).collect()
    _, trigger = route_streams.intake()
    for events in _arrive(X.table(spark, sf, "events"), "events"):
        bridged = route_streams.bridge_together(
            _messages(events), bridges, _landing(backbone), f"{folder}/bridged", trigger
        )
        route_streams.finish([bridged])
        route_streams.finish(
            route_streams.relay_each(
                source, routes, lambda r: _landing(target(r)), f"{folder}/offsets", trigger
            )
        )
    outs = [spark.read.schema(MESSAGE).parquet(target(route)) for route in routes]
    return _published(reduce(DataFrame.unionByName, [o.select(*MESSAGE_COLUMNS) for o in outs]))


def _ack_log(messages: DataFrame, *place: str) -> DataFrame:
    """Deliveries come first, then the acks in their order."""
    delivered = F.struct(F.lit("delivered").alias("kind"), F.lit(0).cast("bigint").alias("at"))
    ack = F.struct(F.lit("ack").alias("kind"), X.ack_seq().cast("bigint").alias("at"))
    open_row = F.col("event_id") % 4999 == 4998
    both = F.when(~open_row, F.array(delivered, ack)).otherwise(F.array(delivered))
    return (
        messages.withColumn("entry", F.explode(both))
        .withColumns({"kind": F.col("entry.kind"), "ack_seq": F.col("entry.at")})
        .select("kind", "id", *place, "ack_seq")
    )


@query
def stream_ack(spark: SparkSession, sf: str) -> DataFrame:
    messages = X.event_messages(X.table(spark, sf, "events"))
    ledger = ledgers.AckLedger(spark, work_folder(spark, "acks"))
    _, trigger = route_streams.intake()
    for entries in _arrive(_ack_log(messages, "topic", "part", "off"), "log", "ack_seq"):
        route_streams.finish([ledger.start(entries, trigger)])
    return ledger.commits()


@query
def stream_ack_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same with keyed state, a block of offsets to a key."""
    keyed_blocks.configure(spark)
    messages = X.event_messages(X.table(spark, sf, "events"))
    ledger = keyed_blocks.BlockLedger(spark, work_folder(spark, "ack-blocks"))
    _, trigger = route_streams.intake()
    for entries in _arrive(_ack_log(messages, "topic", "part", "off"), "block-log", "ack_seq"):
        route_streams.finish([ledger.start(entries.select("kind", "id", "ack_seq"), trigger)])
    return ledger.commits()


@query
def stream_kinesis_ack(spark: SparkSession, sf: str) -> DataFrame:
    """The same from shards with digit-string positions."""
    messages = X.kinesis_delivered(X.table(spark, sf, "events"))
    ledger = ledgers.ShardLedger(spark, work_folder(spark, "shard-acks"))
    _, trigger = route_streams.intake()
    for entries in _arrive(_ack_log(messages, "part", "pos"), "shard-log", "ack_seq"):
        route_streams.finish([ledger.start(entries, trigger)])
    return ledger.commits()


@query
def stream_fair_share(spark: SparkSession, sf: str) -> DataFrame:
    """The segment log in fair pulls, one micro-batch each; the stream starts anew for every pull."""
    events = X.table(spark, sf, "events")
    folder = _segment_log(spark, events, "log-pulls")
    sizes = {r.topic: r["count"] for r in X.event_messages(events).groupBy("topic").count().collect()}
    topics = sorted(sizes)
    budget = max(1, -(-sum(sizes.values()) // 4))
    share = max(1, budget // max(1, len(topics)))
    _, trigger = route_streams.intake()
    for _ in range(-(-max(sizes.values(), default=0) // share)):
        pulled = (
            spark.readStream.format("message_log")
            .options(path=folder, topics=json.dumps(topics), budget=budget, checkpoint=f"{folder}-offsets")
            .load()
        )
        landing = writers.land_stream(pulled, f"{folder}-pulled", f"{folder}-offsets")
        route_streams.finish([landing.trigger(**trigger).start()])
    got = spark.read.parquet(f"{folder}-pulled")
    return got.select("id", "topic", F.col("batch_id").cast("bigint").alias("pull"))


@query
def stream_offset_export(spark: SparkSession, sf: str) -> DataFrame:
    """Two fair pulls with one checkpoint; its exported offsets start a new one for the rest."""
    events = X.table(spark, sf, "events")
    folder = _segment_log(spark, events, "log-moved")
    sizes = {r.topic: r["count"] for r in X.event_messages(events).groupBy("topic").count().collect()}
    budget = max(1, -(-sum(sizes.values()) // 4))
    share = max(1, budget // max(1, len(sizes)))
    _, trigger = route_streams.intake()

    def pull(name: str, options: dict[str, str]) -> None:
        checkpoint = f"{folder}-offsets-{name}"
        pulled = (
            spark.readStream.format("message_log")
            .options(path=folder, topics=json.dumps(sorted(sizes)), budget=budget, checkpoint=checkpoint, **options)
            .load()
        )
        landing = writers.land_stream(pulled, f"{folder}-{name}", checkpoint)
        started = landing.queryName(f"moved-{name}").trigger(**trigger).start()
        route_streams.finish([started])
        offsets.export(started, f"{folder}-exported")

    for _ in range(2):
        pull("first", {})
    resume = offsets.log_options(offsets.exported(spark, f"{folder}-exported"), "moved-first")
    for _ in range(-(-max(sizes.values(), default=0) // share) - 2):
        pull("second", resume)
    runs = [
        spark.read.parquet(f"{folder}-{name}").select("id", "topic", F.lit(name).alias("run"))
        for name in ("first", "second")
    ]
    return runs[0].unionByName(runs[1])


#: Unacked rows at which the consumer of the capped stream is sent back.
CAP = 50


@query
def stream_ack_cap(spark: SparkSession, sf: str) -> DataFrame:
    """A capped consumer in three sessions: each reads on where the ledger sends it.

    The first session acks ten of eleven rows, the second four of five of what comes again, the
    third all. Acks of the first session that come later are refused.
    """
    messages = X.event_messages(X.table(spark, sf, "events")).select(
        "event_id", "id", "topic", "part", "off"
    )
    folder = work_folder(spark, "capped")
    ledger = ledgers.CappedAckLedger(spark, f"{folder}/ledger", CAP)
    _, trigger = route_streams.intake()
    n = F.col("event_id")
    for step, acked in enumerate((X.is_acked(), n % 5 != 0, F.lit(True))):
        epoch = F.lit(ledger.epoch())
        read = positions.kafka_read_from(messages, settle(ledger.starts()))

        def entry(kind: str, ack_no: int | None, session: Column) -> Column:
            seq = F.lit(None) if ack_no is None else X.ack_seq() + ack_no * X.ACK_RANGE
            return F.struct(
                F.lit(kind).alias("kind"), seq.cast("bigint").alias("ack_seq"), session.cast("bigint").alias("epoch")
            )

        entries = F.array_compact(
            F.array(
                entry("delivered", None, epoch),
                F.when(acked, entry("ack", step, epoch)),
                F.when((n % 29 == 0) & F.lit(step > 0), entry("ack", step + 5, F.lit(0))),
            )
        )
        log = read.select("id", "topic", "part", "off", F.inline(entries))
        log.write.mode("append").parquet(f"{folder}/log")
        stream = spark.readStream.schema(log.schema).parquet(f"{folder}/log")
        route_streams.finish([ledger.start(stream, trigger)])
    moved = ledger.commits().select(
        F.lit("commit").alias("event"), "topic", "part", F.col("at_ack").alias("at"), F.col("commit_offset").alias("position")
    )
    sent = ledger.seeks().select(
        F.lit("seek").alias("event"), "topic", "part", F.col("epoch").alias("at"), F.col("seek_to").alias("position")
    )
    refused = ledger.refused().select(
        F.lit("refused").alias("event"),
        F.lit("").alias("topic"),
        F.lit("").alias("part"),
        F.col("ack_seq").alias("at"),
        F.substring_index("id", "-", -1).cast("bigint").alias("position"),
    )
    return moved.unionByName(sent).unionByName(refused)


@query
def stream_breaker(spark: SparkSession, sf: str) -> DataFrame:
    ledger = ledgers.BreakerLedger(spark, work_folder(spark, "breaker"), 3)
    _, trigger = route_streams.intake()
    for events in _arrive(X.table(spark, sf, "events"), "events"):
        route_streams.finish([ledger.start(X.outcomes(events), trigger)])
    return ledger.trips(final=True)


@query
def stream_entry_report(spark: SparkSession, sf: str) -> DataFrame:
    """The event messages through a sink that reports every entry; refusals stop nothing."""
    folder, answer = work_folder(spark, "reported"), reporting.Sent

    def broker(stream: str, entries: list) -> list:
        """Refuses one payload value in ten and deals the rest to four shards."""
        values = [int(json.loads(data)["k"]) for _, data in entries]
        return [
            answer(None, None, "Throttled", f"{stream} is busy")
            if value % 10 == 3
            else answer(f"shard-{value % 4}", f"{key}{value:04d}")
            for (key, _), value in zip(entries, values)
        ]

    spark.dataSource.register(reporting.reporting_sink("wharf_reporting", broker))
    _, trigger = route_streams.intake()
    for events in _arrive(X.table(spark, sf, "events"), "reported"):
        entries = X.event_messages(events).select(
            F.col("topic").alias("reg"),
            F.col("off").alias("idx"),
            "id",
            F.concat(F.lit("stream-"), F.col("part")).alias("stream"),
            F.col("user_id").cast("string").alias("key"),
            F.col("payload").alias("data"),
        )
        sent = entries.writeStream.format("wharf_reporting").option("outcomes", folder)
        started = sent.option("checkpointLocation", f"{folder}-offsets").trigger(**trigger).start()
        route_streams.finish([started])
    message_id = F.when(F.col("ok"), F.concat_ws(":", "shard_id", "sequence_number"))
    return reporting.reported(spark, folder).select(
        "reg", "batch_no", "idx", "id", _flag(F.col("ok"), "ok"), "error", message_id.alias("message_id")
    )


@query
def stream_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Messages through a breaker whose sink refuses one registration in the first two steps."""
    messages = X.event_messages(X.table(spark, sf, "events")).select(
        F.col("topic").alias("reg"), F.col("off").alias("seq"), F.col("ts").alias("at"), "id", "event_id"
    )

    def publish(rows_: DataFrame, name: str) -> DataFrame:
        down = name in ("0-first", "1-first")
        ok = (F.col("reg") != "app-error") | F.lit(not down)
        return rows_.select("reg", "seq", ok.alias("ok"), F.when(~ok, "refused").alias("error"))

    gate = Gate(spark, work_folder(spark, "gate"), messages.schema, publish, threshold=2)
    _, trigger = route_streams.intake()
    for events in _arrive(messages, "gated"):
        route_streams.finish([gate.start(events, trigger)])
    sent = gate.delivered().select(
        F.lit("delivered").alias("event"), "reg", "seq", F.col("batch_id").cast("bigint").alias("step")
    )
    opened = gate.trips().select(
        F.lit("opened").alias("event"), "reg", F.col("streak").alias("seq"), F.col("batch_id").cast("bigint").alias("step")
    )
    waiting = gate.held().select(F.lit("held").alias("event"), "reg", "seq", F.lit(-1).cast("bigint").alias("step"))
    return sent.unionByName(opened).unionByName(waiting)


@query
def stream_contracts(spark: SparkSession, sf: str) -> DataFrame:
    schemas = settle(X.payload_schemas(X.table(spark, sf, "events")))
    ledger = ledgers.ContractLedger(spark, work_folder(spark, "contracts"), schemas)
    _, trigger = route_streams.intake()
    for events in _arrive(X.table(spark, sf, "events"), "events"):
        stream = X.payload_cases(events).select("id", "topic", "payload", "attributes")
        route_streams.finish([ledger.start(stream, trigger)])
    kept = ledger.valid().select("id", F.lit("valid").alias("side"))
    return kept.unionByName(
        ledger.quarantine().select("id", F.lit("quarantine").alias("side"))
    )


@query
def stream_contracts_asof(spark: SparkSession, sf: str) -> DataFrame:
    """Messages and changes of their contracts in one stream; the versions are carried along."""
    messages, changes = _versioned(spark, sf)
    log = messages.withColumn("kind", F.lit("message")).unionByName(
        changes.withColumn("kind", F.lit("change")), allowMissingColumns=True
    )
    ledger = ledgers.VersionedContractLedger(spark, work_folder(spark, "versions"))
    _, trigger = route_streams.intake()
    for entries in _arrive(log, "versioned", "seq"):
        route_streams.finish([ledger.start(entries, trigger)])
    return ledger.quarantine()
