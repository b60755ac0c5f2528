from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from wharf.plans import joins
from wharf.plans.running import Running, block_of, running, streaks
from wharf.session import settle, shared_folder, work_folder


def numbers(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for key in ("hot", "hot2", "cold"):
        size = 200 if key != "cold" else 7
        for pos in sorted(rng.sample(range(-300, 300), size)):
            out.append((key, pos, rng.choice([None, 0, 1, 2, 5])))
    return out


@pytest.mark.parametrize(("span", "levels"), [(1, 1), (7, 1), (7, 2), (3, 3), (1 << 20, 1)])
def test_running_equals_plain_fold(spark, span, levels):
    data = numbers(span)
    df = spark.createDataFrame(data, "k string, p bigint, v bigint").repartition(5)
    got = running(
        df,
        ["k"],
        "p",
        {
            "s": Running("sum", F.col("v")),
            "before": Running("sum", F.lit(1).cast("bigint"), exclusive=True),
            "hi": Running("max", F.col("v")),
            "lo": Running("min", F.col("v"), exclusive=True),
            "prev": Running("max", F.struct("p", "v"), exclusive=True),
        },
        span,
        levels,
    ).select("k", "p", "s", "before", "hi", "lo", F.col("prev.p"), F.col("prev.v"))
    want = []
    for key in {d[0] for d in data}:
        seen, last = [], (None, None)
        for n, (_, p, v) in enumerate(d for d in data if d[0] == key):
            lo = min(seen, default=None)
            if v is not None:
                seen.append(v)
            want.append((key, p, sum(seen), n, max(seen, default=None), lo, *last))
            last = (p, v)
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("span", [1, 4, 1 << 20])
def test_streaks_equal_plain_fold(spark, span):
    rng = random.Random(span)
    data, want = [], []
    for key in "ab":
        count = 0
        for pos in sorted(rng.sample(range(500), 150)):
            ok, fails = rng.random() < 0.2, rng.choice([0, 1])
            count = fails if ok else count + fails
            data.append((key, pos, ok, fails))
            want.append((key, pos, count))
    df = spark.createDataFrame(data, "k string, p bigint, ok boolean, f bigint").repartition(3)
    got = streaks(df, ["k"], "p", "ok", "f", "n", span).select("k", "p", "n")
    assert rows(got) == sorted(want, key=repr)


def test_blocks_round_down(spark):
    df = spark.createDataFrame([(-5,), (-4,), (-1,), (0,), (3,), (4,), (2**62,)], "p bigint")
    got = [r[0] for r in df.select(block_of(F.col("p"), 4)).collect()]
    assert got == [-2, -1, -1, 0, 0, 1, 2**60]


def test_lookup_is_the_same_beyond_the_broadcast_bound(spark):
    # One key holds a third of the rows; adaptive execution may split it.
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    right = settle(spark.range(0, 3000, 2).select(F.col("id").alias("k"), (-F.col("id")).alias("v")))
    small = joins.lookup(left, right, ["k"], "left")
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString()
    large = joins.lookup(left, right, ["k"], "left", rows=10)
    assert rows(small) == rows(large)
    assert joins.fits(right) and not joins.fits(right, rows=10) and not joins.fits(right, size=10)


def test_hot_key_is_split_beyond_the_broadcast_bound(spark):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        left = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("load"),
        )
        right = settle(spark.range(60000).select(F.col("id").alias("k")))
        joined = joins.lookup(left, right, ["k"], rows=10).groupBy("k").agg(
            F.count("*").alias("count"), F.max("load").alias("load")
        )
        assert {r["k"]: r["count"] for r in joined.collect()}[0] == 20000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, v in old.items():
            spark.conf.set(n, v)


def test_work_folders_lie_in_the_shared_folder(spark):
    folder = work_folder(spark, "x")
    assert folder.startswith(shared_folder(spark))
    assert folder != work_folder(spark, "x")
