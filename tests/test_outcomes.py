from __future__ import annotations

import random

import pytest

from conftest import rows
from wharf.operators import outcomes

OUTCOMES = "reg string, batch_no bigint, idx bigint, id string, ok boolean, error string"


def log(spark, batches: list[tuple[str, int, list[bool]]]):
    data = [
        (reg, n, i, f"{reg}-{n}-{i}", ok, None if ok else f"e{i}")
        for reg, n, oks in batches
        for i, ok in enumerate(oks)
    ]
    return spark.createDataFrame(data, OUTCOMES).repartition(5)


def trips_fold(batches: list[tuple[str, int, list[bool]]], threshold: int) -> list[tuple[str, int]]:
    count, out = {}, []
    for reg, n, oks in sorted(batches):
        c = count.get(reg, 0)
        if not all(oks):
            oks = oks[: oks.index(False) + 1]  # nothing is attempted after a failure
        if any(oks):
            c = 0
        if not all(oks):
            c += 1
            if c >= threshold:
                out.append((reg, n))
                c = threshold - 1
        count[reg] = c
    return out


def test_successes_after_a_failure_were_never_attempted(spark):
    got = outcomes.breaker_trips(log(spark, [("r", n, [False, True]) for n in range(4)]), 3)
    assert rows(got) == [("r", 2, 3), ("r", 3, 4)]


def test_a_registration_without_a_name_trips_too(spark):
    got = outcomes.breaker_trips(log(spark, [(None, n, [False]) for n in range(4)]), 3)
    assert rows(got) == [(None, 2, 3), (None, 3, 4)]


def test_batch_results(spark):
    got = outcomes.batch_results(
        log(spark, [("r", 1, [True, False, True, False]), ("r", 2, [True]), ("r", 3, [False])])
    )
    assert rows(got.select("batch_no", "succeeded", "failed", "first_failed_idx", "cause", "message")) == [
        (1, 2, 2, 1, "e1", "publishBatch had 2 failures"),
        (2, 1, 0, None, None, None),
        (3, 0, 1, 0, "e0", "publishBatch had 1 failure"),
    ]


@pytest.mark.parametrize("span", [2, 1 << 20])
def test_batch_entries_keep_input_order(spark, span):
    got = outcomes.batch_entries(log(spark, [("r", 1, [True, False, True, True])]), span=span)
    assert rows(got.select("idx", "id", "success_no", "error")) == [
        (0, "r-1-0", 0, None),
        (1, "r-1-1", None, "e1"),
        (2, "r-1-2", 1, None),
        (3, "r-1-3", 2, None),
    ]


@pytest.mark.parametrize("span", [2, 1 << 20])
def test_batch_stops_at_its_first_failure(spark, span):
    got = outcomes.batch_cut(
        log(spark, [("r", 1, [True, False, True, False]), ("r", 2, [True, True])]), span
    )
    assert rows(got.select("batch_no", "idx", "state")) == [
        (1, 0, "acked"),
        (1, 1, "failed"),
        (1, 2, "not_attempted"),
        (1, 3, "not_attempted"),
        (2, 0, "acked"),
        (2, 1, "acked"),
    ]


def test_breaker_probe_trips_on_every_further_failure(spark):
    batches = [("r", n, [False]) for n in range(5)] + [("r", 5, [True]), ("r", 6, [False])]
    got = outcomes.breaker_trips(log(spark, batches), 3)
    assert rows(got.select("batch_no")) == [(2,), (3,), (4,)]
    with pytest.raises(ValueError, match="publishFailureThreshold must be > 0, got 0"):
        outcomes.breaker_trips(log(spark, batches), 0)


def test_rows_and_block_totals_share_one_exchange(spark, tmp_path):
    batches = [("r", n, [n % 7 == 0]) for n in range(60)]
    log(spark, batches).write.parquet(str(tmp_path / "log"))
    trips = outcomes.breaker_trips(spark.read.parquet(str(tmp_path / "log")), 3, span=5)
    assert [r.batch_no for r in trips.orderBy("batch_no").collect()] == [
        n for _, n in trips_fold(batches, 3)
    ]
    trips.collect()
    assert "ReusedExchange" in trips._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(8))
def test_breaker_equals_batch_by_batch_fold(spark, seed):
    rng = random.Random(seed)
    batches = []
    for reg in ("hot", "a", "b"):
        n = 0
        for _ in range(200 if reg == "hot" else 30):
            n += rng.choice([1, 1, 1, 9])
            oks = [rng.random() < 0.35 for _ in range(rng.randint(1, 3))]
            batches.append((reg, n, oks))
    threshold = 1 + seed % 4
    got = outcomes.breaker_trips(log(spark, batches), threshold, span=rng.choice([1, 5, 64, 1 << 20]))
    assert rows(got.select("reg", "batch_no")) == sorted(trips_fold(batches, threshold), key=repr)


@pytest.mark.parametrize("span", [2, 1 << 20])
def test_relay_retries_in_place(spark, span):
    data = [
        ("d", 1, 10, False),
        ("d", 1, 12, True),
        ("d", 2, 12, True),
        ("d", 3, 11, True),  # before message 2 was delivered
        ("d", 4, 20, False),
        ("d", 5, 30, True),  # message 4 was never delivered
    ]
    df = spark.createDataFrame(data, "reg string, msg_no bigint, at bigint, ok boolean")
    got = outcomes.relay_ledger(df, span)
    assert rows(got.select("msg_no", "attempts", "delivered_at", "wait", "in_order")) == [
        (1, 2, 12, 2, True),
        (2, 1, 12, 0, True),
        (3, 1, 11, 0, False),
        (4, 1, None, None, True),
        (5, 1, 30, 0, False),
    ]


def test_one_backoff_per_batch(spark):
    data = [("d", 1, "a", False), ("d", 1, "b", False), ("d", 1, "c", True), ("d", 2, "d", True)]
    df = spark.createDataFrame(data, "reg string, batch_no bigint, id string, ack_ok boolean")
    assert rows(outcomes.ack_failures(df)) == [("d", 1, 3, 2, 1), ("d", 2, 1, 0, 0)]
    assert rows(outcomes.duplicate_candidates(df).select("id")) == [("a",), ("b",)]
