"""Message, ack and outcome views over the star-schema tables.

Every view is a function of the table's columns and covers the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wharf.schemas import KAFKA_KEY, REQUIRED_FIELDS

# The made-up contents of the views (also spelled out in the comparison SQL).
ACK_STEP = 7919
ACK_GAP = 11
ACK_RANGE = 100_003
BATCH_ROWS = 20
OK_BELOW = 100
SEQUENCE_HEAD = "4959033827"
SEQUENCE_TAIL = 46
FETCH_STEP_NANOS = 150_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _message(
    df: DataFrame, topic: Column, part: Column, off: Column, payload: Column, key: Column
) -> DataFrame:
    """Add the envelope and its place to the table's own columns."""
    placed = df.withColumns({"topic": topic, "part": part.cast("string"), "off": off})
    return placed.withColumns(
        {
            "id": F.concat_ws("-", "topic", "part", "off"),
            "payload": payload.cast("binary"),
            "attributes": F.create_map(
                F.lit(KAFKA_KEY), key.cast("string"), F.lit("schema"), F.lit("v1")
            ),
        }
    )


def event_messages(events: DataFrame) -> DataFrame:
    topic = F.concat(F.lit("app-"), F.col("event_type"))
    return _message(
        events, topic, F.col("user_id") % 4, F.col("event_id"), F.col("props"), F.col("user_id")
    )


def chat_messages(conversations: DataFrame) -> DataFrame:
    return _message(
        conversations,
        F.concat(F.lit("chat-"), F.col("role")),
        F.col("conv_id") % 4,
        F.col("conv_id") * 1000 + F.col("turn"),
        F.col("text"),
        F.col("conv_id"),
    )


def order_messages(orders: DataFrame) -> DataFrame:
    return _message(
        orders,
        F.concat(F.lit("orders-"), F.col("o_orderstatus")),
        F.col("o_custkey") % 4,
        F.col("o_orderkey"),
        F.col("o_orderpriority"),
        F.col("o_custkey"),
    )


def all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["id", "topic", "part", "off", "payload", "attributes"]
    parts = [
        event_messages(table(spark, sf_dir, "events")),
        chat_messages(table(spark, sf_dir, "conversations")),
        order_messages(table(spark, sf_dir, "orders")),
    ]
    events, chats, orders = (p.select(*columns) for p in parts)
    return events.unionByName(chats).unionByName(orders)


def sequence_number(n: Column) -> Column:
    """A 56-digit sequence number."""
    return F.concat(F.lit(SEQUENCE_HEAD), F.lpad(n.cast("string"), SEQUENCE_TAIL, "0"))


def ack_seq() -> Column:
    return (F.col("event_id") * ACK_STEP) % ACK_RANGE


def is_acked() -> Column:
    return (F.col("event_id") * ACK_STEP) % ACK_GAP != 0


def acks(events: DataFrame) -> DataFrame:
    """The ack log of the event messages."""
    return (
        event_messages(events)
        .where(is_acked())
        .select("id", ack_seq().alias("ack_seq"), "event_id", "topic", "part", "off")
    )


def noisy_acks(events: DataFrame) -> DataFrame:
    """The ack log plus repeated acks and acks of ids that were never delivered."""
    log = acks(events)
    again = log.where(F.col("event_id") % 13 == 0).withColumn(
        "ack_seq", F.col("ack_seq") + ACK_RANGE
    )
    strange = log.where(F.col("event_id") % 17 == 0).withColumn(
        "id", F.concat(F.lit("lost-"), "id")
    )
    return log.unionByName(again).unionByName(strange).select("id", "ack_seq")


def two_sessions(delivered: DataFrame, again: DataFrame, noisy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deliveries and acks before and after a reset.

    ``again`` is what comes a second time. The second session acks four of five of those, and
    some rows that it was never given.
    """
    n = F.col("event_id")
    given = delivered.withColumn("session", F.lit(0)).unionByName(
        again.withColumn("session", F.lit(1))
    )
    second = again.where(n % 5 != 0).select("id", (n + 2 * ACK_RANGE).alias("ack_seq"))
    kept = delivered.join(again, "id", "left_anti").where(n % 29 == 0)
    stale = kept.select("id", (n + 2 * ACK_RANGE).alias("ack_seq"))
    acks_ = noisy.withColumn("session", F.lit(0)).unionByName(
        second.unionByName(stale).withColumn("session", F.lit(1))
    )
    return given, acks_


def kinesis_delivered(events: DataFrame) -> DataFrame:
    """Event messages as read from 16 shards, sequence numbers of mixed width."""
    shard = F.concat(F.lit("shard-"), (F.col("user_id") % 16).cast("string"))
    short = F.col("event_id").cast("string")
    pos = F.when(F.col("user_id") % 16 < 8, sequence_number(F.col("event_id"))).otherwise(short)
    rows = event_messages(events).withColumns({"part": shard, "pos": pos, "arrived_at": F.col("ts")})
    return rows.withColumn("id", F.concat_ws(":", "part", "pos"))


def kinesis_acks(events: DataFrame) -> DataFrame:
    return (
        kinesis_delivered(events).where(is_acked()).select("id", ack_seq().alias("ack_seq"))
    )


def outcomes(events: DataFrame) -> DataFrame:
    """Publish outcomes: batches of 20 events per registration (event type)."""
    failed = F.concat(F.lit("broker refused "), F.col("event_id").cast("string"))
    ok = F.col("value") < OK_BELOW
    rows = event_messages(events).withColumns(
        {
            "reg": F.col("event_type"),
            "batch_no": F.call_function("div", F.col("event_id"), F.lit(BATCH_ROWS)),
            "idx": F.col("event_id") % BATCH_ROWS,
            "ok": ok,
            "error": F.when(~ok, failed),
        }
    )
    return rows.select("reg", "batch_no", "idx", "id", "ok", "error", "event_id")


def relay_attempts(events: DataFrame) -> DataFrame:
    """A relay attempt log: five attempts per message at most, times in ticks."""
    return events.select(
        F.col("event_type").alias("reg"),
        F.call_function("div", F.col("event_id"), F.lit(5)).alias("msg_no"),
        F.when(F.col("event_id") % 97 == 0, F.col("event_id") - 11)
        .otherwise(F.col("event_id"))
        .alias("at"),
        ((F.col("event_id") % 3 != 0) | (F.col("value") < 20)).alias("ok"),
    )


def fetch_log(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("shard-"), F.col("event_type")).alias("shard"),
        (F.col("event_id") * FETCH_STEP_NANOS).alias("at_nanos"),
        (F.col("user_id") * 20_000).alias("bytes"),
    )


def bridge_routes(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Valid routes for the message topics, then one route per nation, many of them broken."""
    topics = {
        0: ("app", "click"),
        1: ("app", "error"),
        2: ("app", "purchase"),
        3: ("app", "view"),
        4: ("chat", "user"),
    }
    # One valid route per region row, at the registration numbers 0 to 4.
    pairs = F.array(
        *[F.struct(F.lit(s).alias("s"), F.lit(c).alias("c")) for s, c in topics.values()]
    )
    picked = F.element_at(pairs, (F.col("r_regionkey") + 1).cast("int"))
    valid = region.select(
        F.col("r_regionkey").cast("bigint").alias("reg_no"),
        picked["s"].alias("source_id"),
        picked["c"].alias("channel"),
        F.concat_ws("-", picked["s"], picked["c"]).alias("source_topic"),
        F.concat_ws(".", picked["s"], picked["c"]).alias("target_topic"),
        F.lit(0).alias("partitions"),
        F.lit(3).alias("replication"),
    )
    case = F.col("n_nationkey") % 10
    name = F.lower(F.replace(F.col("n_name"), F.lit("_"), F.lit("-")))
    source_id = (
        F.when(case == 1, F.lit("  "))
        .when(case == 2, F.lit("bad id"))
        .when(case == 3, F.lit("line\n"))
        .when(case == 4, F.repeat(F.lit("s"), 249))
        .when(case == 5, F.lit("app"))
        .otherwise(name)
    )
    channel = (
        F.when(case == 4, F.lit("c"))
        .when(case == 5, F.lit("click"))
        .when(case == 6, F.lit("no/slash"))
        .when(case == 7, F.lit(None).cast("string"))
        .otherwise(F.lit("orders.v1"))
    )
    source_topic = F.when(case == 8, F.lit("")).otherwise(F.concat(F.lit("raw-"), name))
    mixed = nation.select(
        (F.col("n_nationkey") + 10).cast("bigint").alias("reg_no"),
        source_id.alias("source_id"),
        channel.alias("channel"),
        source_topic.alias("source_topic"),
        (F.col("n_nationkey") % 7 - 1).alias("partitions"),
        (F.col("n_regionkey") - 1).alias("replication"),
    ).withColumn(
        "target_topic",
        F.when(F.col("reg_no") == 19, F.lit("elsewhere")).otherwise(
            F.concat("source_id", F.lit("."), F.coalesce("channel", F.lit("?")))
        ),
    )
    return valid.unionByName(mixed)


def relay_routes(nation: DataFrame) -> DataFrame:
    """Destinations for the backbone topics; some broken, some registered twice."""
    case = F.col("n_nationkey") % 6
    source = F.element_at(
        F.array(*[F.lit(t) for t in ("app.click", "app.error", "app.view", "chat.user")]),
        (F.col("n_nationkey") % 4 + 1).cast("int"),
    )
    return nation.select(
        F.col("n_nationkey").cast("bigint").alias("reg_no"),
        F.when(case == 4, F.lit("dest id"))
        .when(case == 5, F.lit(""))
        .otherwise(F.concat(F.lit("dest-"), (F.col("n_nationkey") % 3).cast("string")))
        .alias("destination_id"),
        source.alias("source_topic"),
        F.concat(F.lit("queue_"), F.col("n_nationkey").cast("string")).alias("downstream_topic"),
    )


def payload_cases(events: DataFrame) -> DataFrame:
    """Event messages with eleven kinds of good and bad JSON payloads."""
    n = F.col("event_id").cast("string")
    kinds = [
        F.concat(F.lit('{"id":"e'), n, F.lit('","amount":'), n, F.lit(',"paid":true}')),
        F.concat(F.lit('{"id":"e'), n, F.lit('"} trailing')),
        F.concat(F.lit('{"id":"e'), n, F.lit('"}{"id":"b"}')),
        F.lit(""),
        F.lit("null"),
        F.lit("[1]"),
        F.concat(F.lit('{"id":'), n, F.lit(',"amount":1,"paid":true}')),
        F.concat(F.lit('{"amount":'), n, F.lit(',"paid":false}')),
        F.concat(F.lit('{"id":null,"amount":'), n, F.lit("}")),
        F.concat(F.lit('{"id":"e'), n, F.lit('","amount":"x","paid":true}')),
        F.concat(F.lit('{"id":"e'), n, F.lit('","amount":1.5,"paid":[1]')),
    ]
    payload = F.element_at(F.array(*kinds), (F.col("event_id") % len(kinds) + 1).cast("int"))
    return event_messages(events).withColumn("payload", payload.cast("binary"))


def schema_changes(events: DataFrame) -> DataFrame:
    """A change log of topic schemas: the event types' topics, changed over and over."""
    fields = F.array(
        F.struct(F.lit("id").alias("name"), F.lit("STRING").alias("type")),
        F.struct(F.lit("amount").alias("name"), F.lit("NUMBER").alias("type")),
        F.struct(F.lit("paid").alias("name"), F.lit("BOOLEAN").alias("type")),
    ).cast(REQUIRED_FIELDS)
    wide = (F.col("user_id") % 3 + 1).cast("int")
    return events.select(
        F.concat(F.lit("app-"), F.col("event_type")).alias("topic"),
        F.when(F.col("user_id") % 5 == 0, "unregister").otherwise("register").alias("op"),
        F.when(F.col("user_id") % 5 != 0, F.slice(fields, F.lit(1), wide)).alias("required_fields"),
        F.col("event_id").alias("seq"),
    )


def payload_schemas(events: DataFrame) -> DataFrame:
    """One contract for every event topic except signup, which has none."""
    fields = F.array(
        F.struct(F.lit("id").alias("name"), F.lit("STRING").alias("type")),
        F.struct(F.lit("amount").alias("name"), F.lit("NUMBER").alias("type")),
        F.struct(F.lit("paid").alias("name"), F.lit("BOOLEAN").alias("type")),
    ).cast(REQUIRED_FIELDS)
    return (
        events.where(F.col("event_type") != "signup")
        .select(F.concat(F.lit("app-"), F.col("event_type")).alias("topic"))
        .distinct()
        .withColumn("required_fields", fields)
    )


def definitions(events: DataFrame) -> DataFrame:
    """Schema definition texts, one per event, of fourteen good and broken kinds."""
    n = F.col("event_id").cast("string")

    def listed(*entries: str) -> Column:
        return F.concat(
            F.lit('{"requiredFields":[' + ",".join(entries)), F.lit("]}")
        )

    good = '{"name":"userId","type":"STRING"}'
    kinds = [
        F.concat(
            F.lit('{"requiredFields":[{"name":"f'),
            n,
            F.lit('","type":"NUMBER"},{"name":"ok","type":"BOOLEAN"}]}'),
        ),
        listed(),
        F.lit("{nope"),
        F.concat(F.lit("{} "), n),
        F.lit("  "),
        F.lit("[]"),
        F.lit('{"other":1}'),
        F.lit('{"requiredFields":{}}'),
        listed(good, "7"),
        listed('{"name":" ","type":"STRING"}'),
        listed('{"name":"a","type":3}'),
        listed(good, good),
        F.concat(F.lit('{"requiredFields":[{"name":"f'), n, F.lit('","type":"string"}]}')),
        listed(good, '{"name":"count","type":"NUMBER"}'),
    ]
    text = F.element_at(F.array(*kinds), (F.col("event_id") % len(kinds) + 1).cast("int"))
    return events.select("event_id", text.alias("definition"))
