"""Canonical table shapes and reserved attribute keys."""

from __future__ import annotations

from pyspark.sql import types as T

# Attribute keys that steer behaviour, kept verbatim.
KAFKA_KEY = "kafkaKey"
PARTITION_KEY = "partitionKey"
ARRIVAL = "approximateArrivalTimestamp"
BRIDGE_SOURCE_ID = "bridge.sourceId"
BRIDGE_SOURCE_TOPIC = "bridge.sourceTopic"
BRIDGE_CHANNEL = "bridge.channel"
RELAY_DESTINATION_ID = "relay.destinationId"
RELAY_SOURCE_TOPIC = "relay.sourceTopic"
RELAY_DOWNSTREAM_TOPIC = "relay.downstreamTopic"

_TEXT = T.StringType()
_ATTRIBUTES = T.MapType(_TEXT, _TEXT, valueContainsNull=False)

MESSAGE = T.StructType(
    [
        T.StructField("id", _TEXT, False),
        T.StructField("topic", _TEXT, False),
        T.StructField("payload", T.BinaryType(), False),
        T.StructField("attributes", _ATTRIBUTES, False),
    ]
)

# Raw records as a Kafka scan (or a landed copy of one) yields them.
KAFKA_RECORD = T.StructType(
    [
        T.StructField("topic", _TEXT, False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField(
            "headers",
            T.ArrayType(
                T.StructType(
                    [T.StructField("key", _TEXT), T.StructField("value", T.BinaryType())]
                )
            ),
        ),
    ]
)

KINESIS_RECORD = T.StructType(
    [
        T.StructField("shard_id", _TEXT, False),
        T.StructField("sequence_number", _TEXT, False),
        T.StructField("partition_key", _TEXT),
        T.StructField("data", T.BinaryType()),
        T.StructField("arrival", T.TimestampNTZType()),
    ]
)

PULSAR_RECORD = T.StructType(
    [
        T.StructField("topic", _TEXT, False),
        T.StructField("message_id", _TEXT, False),
        T.StructField("value", T.BinaryType()),
        T.StructField("properties", T.MapType(_TEXT, _TEXT)),
    ]
)

GCP_RECORD = T.StructType(
    [
        T.StructField("message_id", _TEXT, False),
        T.StructField("ack_id", _TEXT, False),
        T.StructField("data", T.BinaryType()),
        T.StructField("attributes", T.MapType(_TEXT, _TEXT)),
    ]
)

RESULT = T.StructType(
    [
        T.StructField("backend", _TEXT, False),
        T.StructField("message_id", _TEXT, False),
        T.StructField("topic", _TEXT, False),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("shard_id", _TEXT),
        T.StructField("sequence_number", _TEXT),
        T.StructField("timestamp", T.LongType()),
    ]
)

# A required-field list, in declaration order.
REQUIRED_FIELDS = T.ArrayType(
    T.StructType([T.StructField("name", _TEXT), T.StructField("type", _TEXT)])
)

MESSAGE_COLUMNS = MESSAGE.fieldNames()
