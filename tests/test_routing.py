from __future__ import annotations

import pytest

from conftest import rows
from wharf import schemas
from wharf.operators import routing

BRIDGE = (
    "reg_no bigint, source_id string, channel string, source_topic string, target_topic string, "
    "partitions int, replication int"
)


def bridge(spark, *routes):
    data = [(n, *r, 0, 0) for n, r in enumerate(routes)]
    return spark.createDataFrame(data, BRIDGE)


def refusal(spark, *route):
    return routing.check_bridge_routes(bridge(spark, route)).first().refusal


@pytest.mark.parametrize(
    ("route", "reason"),
    [
        (("shopify", "orders", "raw", "shopify.orders"), None),
        (("s" * 242, "orders", "raw", "s" * 242 + ".orders"), None),
        ((None, "orders", "raw", "x"), "sourceId must be non-blank"),
        (("a", " ", "raw", "x"), "channel must be non-blank"),
        (("a", "b", "\t", "x"), "sourceTopic must be non-blank"),
        (("a", "b", "raw", ""), "targetTopic must be non-blank"),
        (("a.b", "c", "raw", "x"), "sourceId must match ^[a-zA-Z0-9_-]+$, got a.b"),
        (("a\n", "c", "raw", "x"), "sourceId must match ^[a-zA-Z0-9_-]+$, got a\n"),
        (("a", "c/d", "raw", "x"), "channel must match ^[a-zA-Z0-9._-]+$, got c/d"),
        (("a", "c.d", "raw", "a.c.d"), None),
        (
            ("s" * 243, "orders", "raw", "x"),
            'sourceId + "." + channel must be at most 249 characters, got 250',
        ),
        (("a", "b", "raw", "a-b"), 'targetTopic must equal sourceId + "." + channel (a.b), got a-b'),
    ],
)
def test_bridge_route_checks(spark, route, reason):
    assert refusal(spark, *route) == reason


def test_first_registration_stays(spark):
    routes = bridge(
        spark,
        ("a", "b", "t0", "wrong"),  # invalid: does not take the place
        ("a", "b", "t1", "a.b"),
        ("a", "b", "t2", "a.b"),
        ("a", "c", "t1", "a.c"),
    )
    got = routing.check_bridge_routes(routes).select("source_topic", "channel", "refusal")
    assert [r for r in rows(got) if r[2] and "already" in r[2]] == [
        ("t2", "b", "(sourceId, channel) already registered: a.b")
    ]
    assert rows(routing.accepted(routing.check_bridge_routes(routes)).select("source_topic")) == [
        ("t1",),
        ("t1",),
    ]


def test_relay_routes_one_topic_many_destinations(spark):
    routes = spark.createDataFrame(
        [
            (0, "d-1", "shopify.orders", "q1"),
            (1, "d-2", "shopify.orders", "q2"),
            (2, "d-1", "shopify.orders", "q3"),
            (3, "d 1", "t", "q"),
            (4, "", "t", "q"),
            (5, "d", None, "q"),
            (6, "d", "t t/!", " "),
            (7, "d", "t t/!", "q"),
        ],
        "reg_no bigint, destination_id string, source_topic string, downstream_topic string",
    )
    got = {r.reg_no: r.refusal for r in routing.check_relay_routes(routes).collect()}
    assert got == {
        0: None,
        1: None,
        2: "(destinationId, sourceTopic) already registered: d-1 / shopify.orders",
        3: "destinationId must match ^[a-zA-Z0-9_-]+$, got d 1",
        4: "destinationId must be non-blank",
        5: "sourceTopic must be non-blank",
        6: "downstreamTopic must be non-blank",
        7: None,
    }


def test_topic_plan_and_what_to_create(spark):
    routes = spark.createDataFrame(
        [("a.b", 0, 0), ("a.c", 12, 2), ("a.d", -1, 0), ("a.e", 0, -2)],
        "target_topic string, partitions int, replication int",
    )
    plan = routing.topic_plan(routes, 6, 3)
    assert rows(plan.select("target_topic", "effective_partitions", "effective_replication").limit(2)) == [
        ("a.b", 6, 3),
        ("a.c", 12, 2),
    ]
    assert {r.target_topic: r.option_refusal for r in plan.collect()} == {
        "a.b": None,
        "a.c": None,
        "a.d": "partitions must be >= 0, got -1",
        "a.e": "replicationFactor must be >= 0, got -2",
    }
    there = spark.createDataFrame([("a.b",), ("x",)], "topic string")
    assert rows(routing.to_create(plan, there).select("target_topic")) == [("a.c",)]
    with pytest.raises(ValueError, match="defaultPartitions must be > 0, got 0"):
        routing.topic_plan(routes, 0)


def test_layered_provenance(spark):
    messages = spark.createDataFrame(
        [
            ("m-1", "raw-orders", b"\x01\x02\x03", {"bridge.sourceId": "wrong", "kafkaKey": "k-1"}),
            ("m-2", "unrouted", b"", {}),
        ],
        schemas.MESSAGE,
    )
    routes = bridge(spark, ("shopify", "orders", "raw-orders", "shopify.orders"))
    backbone = routing.fan_in(messages, routes)
    got = backbone.first()
    assert backbone.count() == 1
    assert (got.id, got.topic, bytes(got.payload)) == ("m-1", "shopify.orders", b"\x01\x02\x03")
    assert got.attributes == {
        "bridge.sourceId": "shopify",
        "bridge.sourceTopic": "raw-orders",
        "bridge.channel": "orders",
        "kafkaKey": "k-1",
    }
    relays = spark.createDataFrame(
        [(0, "rabbit-prod", "shopify.orders", "orders_q"), (1, "other", "shopify.orders", "q2")],
        "reg_no bigint, destination_id string, source_topic string, downstream_topic string",
    )
    out = routing.fan_out(backbone, relays)
    sent = {r.topic: r.attributes for r in out.collect()}
    assert sent["orders_q"] == {
        **got.attributes,
        "relay.destinationId": "rabbit-prod",
        "relay.sourceTopic": "shopify.orders",
        "relay.downstreamTopic": "orders_q",
    }
    assert rows(routing.paths(out)) == [
        ("shopify", "orders", "other", "q2", 1),
        ("shopify", "orders", "rabbit-prod", "orders_q", 1),
    ]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_same_topic_name_in_two_sources(spark):
    messages = spark.createDataFrame(
        [("m1", "orders", b"", {}), ("m2", "orders", b"", {})], schemas.MESSAGE
    ).selectExpr("*", "if(id = 'm1', 'shop', 'erp') AS source_id")
    routes = bridge(spark, ("shop", "o", "orders", "shop.o"), ("erp", "o", "orders", "erp.o"))
    got = routing.fan_in(messages, routes, source="source_id")
    assert rows(got.select("id", "topic", "source_id")) == [
        ("m1", "shop.o", "shop"),
        ("m2", "erp.o", "erp"),
    ]
    assert routing.fan_in(messages, routes).count() == 4


def test_long_route_tables_are_shuffled(spark, monkeypatch):
    from wharf.plans import joins

    messages = spark.range(300).selectExpr(
        "string(id) AS id", "concat('t', id % 3) AS topic", "binary('x') AS payload",
        "map('a', 'b') AS attributes",
    )
    routes = bridge(spark, *[("s", f"c{n}", f"t{n}", f"s.c{n}") for n in range(5)])
    few = routing.fan_in(messages, routes).select("id", "topic")
    monkeypatch.setattr(joins, "fits", lambda *_: False)
    many = routing.fan_in(messages, routes).select("id", "topic")
    assert "ResolvedHint" not in many._jdf.queryExecution().analyzed().toString()
    assert rows(few) == rows(many)
