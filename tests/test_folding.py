"""Folding of closed micro-batches: few folders, the same rows, replays and cut-short folds."""

from __future__ import annotations

import os
import random
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from test_outcomes import OUTCOMES
from wharf.operators import outcomes
from wharf.streaming import batches, ledgers

SHAPE = T.StructType([T.StructField("n", T.LongType()), T.StructField("word", T.StringType())])


def put(base, batch_id, values):
    folder = f"{base}/batch_id={batch_id}"
    shutil.rmtree(folder, ignore_errors=True)
    os.makedirs(folder)
    table = pa.table({"n": pa.array(values, pa.int64()), "word": pa.array([f"w{v}" for v in values], pa.string())})
    pq.write_table(table, f"{folder}/part-0.parquet")


def folders(base) -> int:
    return sum(len(os.listdir(f)) for f in (base, f"{base}.folded") if os.path.isdir(f))


def numbers(spark, base):
    return sorted((r.n, r.batch_id) for r in batches.everything(spark, base, SHAPE).collect())


def test_listing_is_bounded_over_a_thousand_micro_batches(spark, tmp_path):
    base, every, most = str(tmp_path / "t"), 16, 0
    for b in range(1000):
        put(base, b, [b, b] if b % 7 else [])
        batches.fold(spark, base, b, SHAPE, every)
        most = max(most, folders(base))
    want = sorted((b, b) for b in range(1000) if b % 7 for _ in range(2))
    assert numbers(spark, base) == want
    # Each level holds fewer than ``every`` tables, and as many that wait for the next fold.
    assert most <= 4 * every + 8
    out = batches.everything(spark, base, SHAPE)
    assert out.schema.fieldNames() == ["n", "word", "batch_id"]
    assert out.where("n = 500").select("word", "batch_id").distinct().collect() == [("w500", 500)]


def test_replays_and_folds_that_are_cut_short(spark, tmp_path):
    base, rng = str(tmp_path / "t"), random.Random(2)
    want, copy = {}, None
    for b in range(40):
        for _ in range(rng.choice([1, 1, 2])):  # written again
            values = [rng.randrange(1000) for _ in range(rng.randrange(3))]
            put(base, b, values)
            want[b] = values
            if b == 21:
                copy = str(tmp_path / "before")
                shutil.rmtree(copy, ignore_errors=True)
                shutil.copytree(base, copy)
            batches.fold(spark, base, b, SHAPE, 3)
        # A micro-batch that is not closed yet is never folded.
        assert os.path.isdir(f"{base}/batch_id={b}") and (b == 0 or os.path.isdir(f"{base}/batch_id={b - 1}"))
    assert numbers(spark, base) == sorted((n, b) for b, values in want.items() for n in values)
    # A fold that stopped after its rename leaves what it covers; it is not read twice.
    for b in range(20):
        put(base, b, want[b])
    os.makedirs(f"{base}.folded/_staged-9")
    assert numbers(spark, base) == sorted((n, b) for b, values in want.items() for n in values)


def test_old_tables_go_when_only_so_many_are_kept(spark, tmp_path):
    base = str(tmp_path / "t")
    for b in range(60):
        put(base, b, [b])
        batches.fold(spark, base, b, SHAPE, 4, keep=20)
    got = [n for n, _ in numbers(spark, base)]
    assert got == list(range(got[0], 60)) and 10 < got[0] <= 40
    with pytest.raises(ValueError):
        batches.fold(spark, base, 60, SHAPE, 1)


def test_ledger_tells_the_same_folded_or_not(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    logs = [
        [(reg, b, i, f"{reg}{b}-{i}", rng.random() < 0.4, "e") for reg in "ab" for i in range(rng.randrange(1, 3))]
        for b in range(14)
    ]
    told = []
    for every in (2, 64):
        monkeypatch.setattr(ledgers.BreakerLedger, "every", every)
        ledger = ledgers.BreakerLedger(spark, str(tmp_path / f"every-{every}"), threshold=2)
        for b, log in enumerate(logs):
            ledger.process(spark.createDataFrame(log, OUTCOMES), b)
        told.append(rows(ledger.trips(final=True)))
    whole = spark.createDataFrame([row for log in logs for row in log], OUTCOMES)
    assert told[0] == told[1] == rows(outcomes.breaker_trips(whole, 2)) != []
    assert folders(str(tmp_path / "every-2" / "streaks")) < folders(str(tmp_path / "every-64" / "streaks"))


def test_partitioned_tables_are_folded_too(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledgers.ContractLedger, "every", 2)
    fields = "topic string, required_fields array<struct<name string, type string>>"
    schemas = spark.createDataFrame([("t", [("a", "NUMBER")])], fields)
    ledger = ledgers.ContractLedger(spark, str(tmp_path / "ledger"), schemas)
    shape = "id string, topic string, payload binary, attributes map<string,string>"
    for b in range(7):
        payload = b'{"a": 1}' if b % 2 else b"{}"
        ledger.process(spark.createDataFrame([(f"m{b}", "t", payload, {"k": "v"})], shape), b)
    assert rows(ledger.valid().select("id")) == [("m1",), ("m3",), ("m5",)]
    assert rows(ledger.quarantine().select("id", "field_name")) == [(f"m{b}", "a") for b in (0, 2, 4, 6)]
    assert ledger.valid().select(F.element_at("attributes", "k")).distinct().collect() == [("v",)]
    assert os.path.isdir(tmp_path / "ledger" / "checked.folded")
