"""Histories beyond any broadcast: the search tree over their segments, and months dealt over tasks."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starlot.operators import temporal
from starlot.operators.temporal import months_of_periods, period_side, value_at

HISTORY = "id_vendedor bigint, id_loja bigint, data_inicio timestamp_ntz, data_fim timestamp_ntz"
START = datetime(2020, 1, 1)


def rows_and_events():
    rng = random.Random(12)
    rows = []
    for key, many in ((-1, 90), (3, 300), (4, 1), (5, 9), (6, 40)):
        for _ in range(many):
            a = START + timedelta(hours=rng.randrange(9000))
            rows.append((key, rng.choice([None, *range(9)]), a, None if rng.random() < 0.05 else a + timedelta(hours=rng.randrange(900))))
    events = [(rng.choice([None, -1, 3, 3, 3, 4, 5, 6, 7]), START + timedelta(minutes=30 * rng.randrange(22_000))) for _ in range(1500)]
    return rows, [*events, *events[:50], (3, None), (None, None)]


def brute(rows, key, at):
    last = datetime(2099, 12, 31)
    hits = [(a, b or last, -1 if s is None else s) for k, s, a, b in rows if at is not None and k == key and a <= at <= (b or last)]
    return max(hits)[2] if hits else -1


@pytest.mark.parametrize("small", [None, False])
@pytest.mark.parametrize("fanout", [2, 4, 1000])
def test_every_event_finds_its_owner_at_any_depth(spark, small_limits, fanout, small):
    rows, events = rows_and_events()
    spark.conf.set(temporal.FANOUT_SETTING, str(fanout))
    try:
        side = period_side(spark.createDataFrame(rows, HISTORY), "id_vendedor", "id_loja", small=small)
    finally:
        spark.conf.unset(temporal.FANOUT_SETTING)
    assert not side.small and (side.depth == 1) == (fanout == 1000)
    assert max(r["count"] for r in side.df.groupBy("key", "node").count().collect()) <= fanout
    df = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(events)], "i int, k bigint, t timestamp_ntz")
    found = value_at(df, side, "k", "t", "store").collect()
    assert len(found) == len(events)
    assert {r["i"]: r["store"] for r in found} == {i: brute(rows, k, t) for i, (k, t) in enumerate(events)}


def test_events_are_read_once_and_not_multiplied(spark, small_limits):
    side = period_side(spark.createDataFrame([(1, 10, START, None)], HISTORY), "id_vendedor", "id_loja")
    events = spark.range(1000).select((F.col("id") % 3).alias("k"), F.lit(START).cast("timestamp_ntz").alias("t"))
    plan = value_at(events, side, "k", "t", "store")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 1000") == 1 and "Aggregate" not in plan


def test_events_of_nobody_do_not_meet_in_one_task(spark, small_limits):
    side = period_side(spark.createDataFrame([(1, 10, START, None), (-1, 7, START, None)], HISTORY), "id_vendedor", "id_loja")
    events = spark.range(20_000).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, -1).cast("bigint").alias("k"), F.lit(START).cast("timestamp_ntz").alias("t")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = value_at(events, side, "k", "t", "store")
        parts = {r["p"]: r["n"] for r in placed.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
        assert max(parts.values()) < 5000 and sum(parts.values()) == 20_000
        assert {(r["k"], r["store"], r["count"]) for r in placed.groupBy("k", "store").count().collect()} == {(None, -1, 10_000), (-1, 7, 10_000)}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_months_are_made_in_as_many_tasks_as_they_need(spark, monkeypatch):
    monkeypatch.setattr(temporal, "MONTHS_PER_TASK", 500)
    rng = random.Random(5)
    rows = []
    for key in range(60):
        for _ in range(4):
            a = START + timedelta(days=rng.randrange(2000))
            rows.append((key if key else None, rng.randrange(9), a, a + timedelta(days=rng.randrange(1500))))
    hist = spark.createDataFrame(rows + rows[:9], HISTORY).coalesce(1)
    months = months_of_periods(hist, "id_vendedor", "id_loja")
    plan = months._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and months.rdd.getNumPartitions() > 5
    want = {}
    for key, store, a, b in sorted(rows, key=lambda r: (r[2], r[1])):
        for m in range(a.year * 12 + a.month - 1, b.year * 12 + b.month):
            want.setdefault((key, m // 12 * 100 + m % 12 + 1), store)
    got = [((r["id_vendedor"], r["ano_mes"]), r["id_loja"]) for r in months.collect()]
    assert dict(got) == want and len(got) == len(want)
