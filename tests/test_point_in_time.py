import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starlot.operators.lookup import code_map_side
from starlot.operators.temporal import (
    disjoint_segments, months_of_periods, period_side, validity_periods, value_at,
)
from starlot.plans.dims import seller_dim
from starlot.plans.facts import seller_sides, with_seller_and_store

HISTORY = "id_vendedor bigint, id_loja bigint, loja string, data_inicio timestamp_ntz, data_fim timestamp_ntz"


def day(text):
    return datetime.fromisoformat(text) if text else None


def history(spark, rows):
    return spark.createDataFrame([(k, s, f"Loja {s}", day(a), day(b)) for k, s, a, b in rows], HISTORY)


@pytest.fixture
def sides(spark):
    users = spark.createDataFrame([(1, "joao"), (2, "maria")], "id_vendedor bigint, nome string")
    hist = history(
        spark, [(1, 10, "2022-01-01", "2022-12-31"), (1, 20, "2023-01-01", None), (2, 10, "2022-01-01", None)]
    )
    codes = spark.createDataFrame([("j silva", "joao")], "nome_origem string, nome_padrao string")
    return lambda **kw: seller_sides(seller_dim(users), hist, code_map_side(codes, "nome_origem", "nome_padrao"), **kw)


def resolve(spark, sides, events, **kw):
    df = spark.createDataFrame(
        [(i, n, day(t)) for i, (n, t) in enumerate(events)], "i int, resp string, data timestamp_ntz"
    )
    found = with_seller_and_store(df, "resp", "data", sides(**kw))
    assert found.schema["id_vendedor"].dataType.simpleString() == "bigint"
    assert found.schema["id_loja"].dataType.simpleString() == "bigint"
    return [(r["id_vendedor"], r["id_loja"]) for r in found.orderBy("i").collect()]


CASES = [
    ("joao", "2022-03-01", 1, 10),
    ("joao", "2022-06-01", 1, 10),
    ("joao", "2022-09-01", 1, 10),
    ("joao", "2023-03-01", 1, 20),
    ("joao", "2023-06-01", 1, 20),
    ("maria", "2022-06-01", 2, 10),
    ("j silva", "2023-06-01", 1, 20),
    (" J. SÍLVA ", "2023-06-01", 1, 20),
    ("ninguem", "2022-06-01", -1, -1),
    ("desconhecido_xyz", "2022-06-01", -1, -1),
    ("desconhecido", "2022-06-01", -1, -1),
    ("", "2022-06-01", -1, -1),
    (None, "2022-06-01", -1, -1),
    ("joao", None, 1, -1),
    ("joao", "2021-12-31", 1, -1),
    ("joao", "2022-12-31", 1, 10),
    ("joao", "2022-12-31 15:00", 1, -1),
    ("joao", "2023-01-01", 1, 20),
]


def test_seller_and_store(spark, sides):
    assert resolve(spark, sides, [c[:2] for c in CASES]) == [c[2:] for c in CASES]


def test_seller_and_store_large_sides(spark, sides, small_limits):
    assert resolve(spark, sides, [c[:2] for c in CASES]) == [c[2:] for c in CASES]


def test_by_date_counts_the_whole_last_day(spark, sides):
    got = resolve(spark, sides, [("joao", "2022-12-31 15:00"), ("joao", "2023-01-01 00:00:01")], by_date=True)
    assert got == [(1, 10), (1, 20)]


def brute(rows, key, at):
    hits = [(a, b or "2099-12-31", s) for k, s, a, b in rows if k == key and day(a) <= at <= day(b or "2099-12-31")]
    return max(hits)[2] if hits else -1


@pytest.fixture(scope="module")
def random_case():
    rng = random.Random(3)
    start = datetime(2020, 1, 1)
    rows = []
    for key in range(12):
        # Key 0 holds far more periods than the others, nested and overlapping.
        for _ in range(120 if key == 0 else 5):
            a = start + timedelta(days=rng.randint(0, 500))
            b = None if rng.random() < 0.1 else a + timedelta(days=rng.randint(0, 200))
            rows.append((key, rng.randint(1, 9), a.date().isoformat(), b and b.date().isoformat()))
    events = [
        (rng.choice([0, 0, 0, 0, *range(14)]), start + timedelta(hours=rng.randint(0, 24 * 800))) for _ in range(1500)
    ]
    return rows, events


def check_random(spark, random_case, small):
    rows, events = random_case
    side = period_side(history(spark, rows), "id_vendedor", "id_loja")
    assert side.small is small
    df = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(events)], "i int, k bigint, t timestamp_ntz")
    got = {r["i"]: r["store"] for r in value_at(df, side, "k", "t", "store").collect()}
    assert got == {i: brute(rows, k, t) for i, (k, t) in enumerate(events)}


def test_overlaps_latest_start_wins(spark, random_case):
    check_random(spark, random_case, True)


def test_overlaps_large_history(spark, random_case, small_limits):
    check_random(spark, random_case, False)


def test_segments_do_not_overlap(spark, random_case):
    periods = validity_periods(history(spark, random_case[0]), "id_vendedor", "id_loja", "data_inicio", "data_fim")
    segments = disjoint_segments(periods).alias("a")
    other = segments.alias("b")
    overlap = segments.join(
        other, F.expr("a.key = b.key and a.since < b.since and b.since < a.before")
    )
    assert overlap.count() == 0


def test_small_history_shuffles_no_event(spark, sides):
    df = spark.createDataFrame([("joao", day("2022-03-01"))], "resp string, data timestamp_ntz")
    plan = with_seller_and_store(df, "resp", "data", sides())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rightHint=(strategy=broadcast)") == 3 and "Distinct" not in plan


def test_months(spark):
    hist = history(
        spark,
        [(1, 10, "2022-11-15", "2023-02-01"), (1, 20, "2023-02-01", "2023-03-31"), (2, 5, "2099-11-30", None),
         (3, 7, "2023-05-01", "2023-04-01")],
    )
    got = {tuple(r) for r in months_of_periods(hist, "id_vendedor", "id_loja").collect()}
    assert got == {
        (1, 10, 202211), (1, 10, 202212), (1, 10, 202301), (1, 10, 202302), (1, 20, 202303),
        (2, 5, 209911), (2, 5, 209912),
    }


def test_nodes_of_a_period_make_it_up(spark):
    """Random moments, around all edges: a moment is in a period exactly if one node of each level list holds it."""
    rng = random.Random(8)
    base = datetime(2021, 3, 1)
    spans = [(base, base), (base, base + timedelta(days=1, microseconds=-1)), (base, base + timedelta(days=400)),
             (base - timedelta(microseconds=1), base), (datetime(1900, 1, 1), datetime(2099, 12, 31))]
    for _ in range(40):
        a = base + timedelta(microseconds=rng.randrange(10**rng.randrange(1, 14)))
        spans.append((a, a + timedelta(microseconds=rng.randrange(10**rng.randrange(1, 14)))))
    tick = timedelta(microseconds=1)
    for k, (a, b) in enumerate(spans):
        assert a <= b, k
    rows = [(k, k + 100, a, b) for k, (a, b) in enumerate(spans)]
    hist = spark.createDataFrame(rows, "id_vendedor bigint, id_loja bigint, data_inicio timestamp_ntz, data_fim timestamp_ntz")
    asked = []
    for k, (a, b) in enumerate(spans):
        for t in (a - tick, a, a + tick, a + (b - a) / 2, b - tick, b, b + tick, *[a + (b - a) * rng.uniform(-0.2, 1.2) for _ in range(8)]):
            asked.append((k, t))
    events = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(asked)], "i int, k bigint, t timestamp_ntz")
    side = period_side(hist, "id_vendedor", "id_loja", small=False)
    assert not side.small and max(side.df.groupBy("key").count().toPandas()["count"]) <= 2 * 37 + 2 * 37 + 2 * 20
    got = {r["i"]: r["store"] for r in value_at(events, side, "k", "t", "store").collect()}
    assert got == {i: k + 100 if spans[k][0] <= t <= spans[k][1] else -1 for i, (k, t) in enumerate(asked)}


def test_a_hundred_thousand_periods_of_a_key_in_one_month(spark):
    """All overlap; the latest start wins, as a plain running maximum over the starts tells."""
    n, month = 100_000, datetime(2022, 5, 1)
    starts = F.col("id") * 24  # seconds; every period runs to the end of the month
    hist = spark.range(n).select(
        F.lit(1).cast("bigint").alias("id_vendedor"), F.col("id").alias("id_loja"),
        (F.lit(month).cast("timestamp_ntz") + F.make_dt_interval(secs=starts)).cast("timestamp_ntz").alias("data_inicio"),
        F.lit(datetime(2022, 6, 1)).cast("timestamp_ntz").alias("data_fim"),
    )
    events = [(1, month + timedelta(seconds=s)) for s in range(0, 31 * 86_400, 1999)] + [(1, datetime(2022, 6, 1)), (1, datetime(2022, 6, 2)), (2, month), (None, month), (1, None)]
    df = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(events)], "i int, k bigint, t timestamp_ntz")
    side = period_side(hist, "id_vendedor", "id_loja")
    assert not side.small
    got = {r["i"]: r["store"] for r in value_at(df, side, "k", "t", "store").collect()}
    seconds = [(t - month).total_seconds() if t else 0 for _, t in events]
    assert got == {
        i: min(n - 1, int(s // 24)) if k == 1 and t and t <= datetime(2022, 6, 1) else -1 for i, ((k, t), s) in enumerate(zip(events, seconds))
    }
