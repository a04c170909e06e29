import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starlot.functions import scalars as S
from starlot.operators.calendar import date_spine, with_calendar
from starlot.operators.columns import conform_to, first_with_prefix, keep_present, layout
from starlot.operators.dedup import keep_first, keep_latest
from starlot.operators.keys import surrogate_keys
from starlot.operators.lookup import (
    apply_code_map, as_side, code_map_side, left_lookup, lookup_key, unknown_member, unmatched,
)
from starlot.operators.overlay import fill_by_priority, overlay
from starlot.operators.reshape import months_to_rows


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def check_lookup(spark):
    rng = random.Random(1)
    facts = [(i, rng.choice([None, 7, 7, 7, *range(20)]), rng.choice(["a", "b", None])) for i in range(600)]
    side = {(k, s): k * 10 + len(s) for k in range(15) for s in ("a", "b")}
    left = spark.createDataFrame(facts, "i int, k int, s string")
    right = spark.createDataFrame([(k, s, v) for (k, s), v in side.items()], "k2 bigint, s2 string, v bigint")
    got = left_lookup(left, right, {"k": "k2", "s": "s2"}, {"v": "v"})
    assert got.columns == ["i", "k", "s", "v"]
    assert rows(got) == sorted(((i, k, s, side.get((k, s))) for i, k, s in facts), key=repr)


def test_left_lookup(spark):
    check_lookup(spark)


def test_left_lookup_large(spark, small_limits):
    check_lookup(spark)


def check_null_safe(spark):
    left = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "i int, s string")
    right = spark.createDataFrame([("x", 1), (None, 2)], "s string, k int")
    assert rows(left_lookup(left, right, {"s": "s"}, {"k": "k"}, null_safe=True)) == [
        (1, "x", 1), (2, None, 2), (3, "z", None),
    ]
    assert rows(lookup_key(left, right, {"s": "s"}, "k", "k")) == [(1, "x", 1), (2, None, -1), (3, "z", -1)]


def test_null_keys(spark):
    check_null_safe(spark)


def test_null_keys_large(spark, small_limits):
    check_null_safe(spark)


def test_text_never_meets_number(spark):
    left, right = spark.createDataFrame([("1",)], "k string"), spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(TypeError, match="string"):
        left_lookup(left, right, {"k": "k"}, {"v": "v"})


def test_size_check_decides_broadcast(spark):
    df = spark.range(50).select("id", F.lit("x" * 100).alias("t"))
    assert as_side(df).small
    for key, value in (("starlot.broadcast.maxRows", "49"), ("starlot.broadcast.maxBytes", "5000")):
        spark.conf.set(key, value)
        try:
            assert not as_side(df).small
        finally:
            spark.conf.unset(key)


def test_large_side_of_small_files_is_not_broadcast(spark, tmp_path):
    """runs of equal values are a few kilobytes in files, and many times that in a broadcast."""
    every = spark.range(0, 300_000, 1, 1).select((F.col("id") % 1000).alias("month"), F.floor(F.col("id") / 1000).alias("seller"), F.lit(1).alias("store"))
    every.write.parquet(str(tmp_path / "months"))
    stored = spark.read.parquet(str(tmp_path / "months"))
    spark.conf.set("starlot.broadcast.maxRows", "299999")
    try:
        side = as_side(stored, stored=True)
        assert not side.small
        facts = spark.createDataFrame([(1, 2), (1, None), (400, 2)], "s bigint, m bigint")
        found = left_lookup(facts, side, {"s": "seller", "m": "month"}, {"store": "store"})
        assert rows(found) == rows(spark.createDataFrame([(1, 2, 1), (1, None, None), (400, 2, None)], "s bigint, m bigint, store int"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    finally:
        spark.conf.unset("starlot.broadcast.maxRows")


def test_hot_key_is_split_at_run_time(spark, small_limits):
    """A third of the rows on one key, the side deduplicated on that very key just before."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        ids = spark.range(0, 60_000, 1, 16)
        hot = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id"))
        for key in (hot, F.when(F.col("id") % 3 != 0, F.col("id"))):
            facts = ids.select(key.alias("k"), F.xxhash64("id").alias("payload"))
            side = keep_first(
                ids.select(F.col("id").alias("code"), (F.col("id") * 2).alias("v")), ["code"], ["v"]
            )
            joined = left_lookup(facts, side, {"k": "code"}, {"v": "v"})
            done = joined.agg(F.count(F.lit(1)), F.sum("v"), F.max("payload"))
            found = done.collect()[0]
            plan = done._jdf.queryExecution().executedPlan().toString()
            assert "skew=true" in plan
            total = facts.agg(F.sum(F.col("k") * 2)).first()[0]
            assert tuple(found)[:2] == (60_000, total)
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_code_map(spark):
    codes = spark.createDataFrame(
        [("Face Book", "Meta"), ("face book!", "Alpha"), ("Tv", None)], "o string, p string"
    )
    side = code_map_side(codes, "o", "p")
    df = spark.createDataFrame([(1, " FACE  BOOK "), (2, "tv"), (3, "Rádio"), (4, None)], "i int, canal string")
    assert rows(apply_code_map(df, "canal", side)) == [(1, "alpha"), (2, ""), (3, "radio"), (4, "")]
    with pytest.raises(ValueError, match="face book"):
        code_map_side(codes, "o", "p", strict=True)


def test_unmatched_and_sentinel(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "c string")
    dim = spark.createDataFrame([("a", 1)], "c string, k int")
    assert rows(unmatched(df, dim, {"c": "c"})) == [("b",)]
    assert rows(unknown_member(dim, k=-1, c="desconhecido")) == [("a", 1), ("desconhecido", -1)]


def test_keep_first_and_latest(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, None), ("a", None, "n"), ("b", None, "only"), (None, 1, "p"), (None, 2, "q")],
        "k string, t int, v string",
    )
    assert rows(keep_latest(df, ["k"], ["t"])) == [("a", 2, "x"), ("b", None, "only"), (None, 2, "q")]
    assert rows(keep_first(df.dropna(subset=["t"]), ["k"], ["t"])) == [("a", 1, None), (None, 1, "p")]


def test_dedup_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("t"), F.hash("id").alias("v"))
    results = [rows(keep_first(df.repartition(n), ["k"], ["t"])) for n in (1, 8)]
    assert results[0] == results[1]


def check_keys(spark):
    df = spark.createDataFrame(
        [("c", 1), ("a", 2), (None, 3), ("c", 4), ("b", 5), ("d", 6), ("e", 7)], "v string, at int"
    )
    assert rows(surrogate_keys(df, "v", "k", ["at"])) == [
        ("a", 2), ("b", 4), ("c", 1), ("d", 5), ("e", 6), (None, 3),
    ]
    assert rows(surrogate_keys(df.dropna(), "v", "k")) == [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5)]
    many = spark.range(500).select(F.hash("id").alias("v"), F.col("id").alias("at"))
    assert rows(surrogate_keys(many, "v", "k", ["at"]).select("k")) == sorted(((i,) for i in range(1, 501)), key=repr)


def test_surrogate_keys(spark):
    check_keys(spark)


def test_surrogate_keys_in_ranges(spark, small_limits):
    check_keys(spark)


def check_overlay(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "n")], "id int, v string")
    fix = spark.createDataFrame([(2, "B", 9), (None, "N", 9)], "id int, v string, extra int")
    assert rows(overlay(base, fix, "id")) == sorted(
        [(1, "a", None), (None, "n", None), (2, "B", 9), (None, "N", 9)], key=repr
    )


def test_overlay(spark):
    check_overlay(spark)


def test_overlay_large(spark, small_limits):
    check_overlay(spark)


def test_fill_by_priority(spark):
    base = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id int")
    first = spark.createDataFrame([(1, "x"), (2, None)], "k int, m string")
    second = spark.createDataFrame([(1, "y"), (2, "z")], "k int, m string")
    got = fill_by_priority(base, "id", "m", [(first, "k", "m"), (second, "k", "m")], "desconhecida")
    assert rows(got) == sorted([(1, "x"), (2, "z"), (3, "desconhecida"), (None, "desconhecida")], key=repr)


def test_months_to_rows(spark):
    wide = spark.createDataFrame([("A", 1.0, None, 5.0), ("B", 2.0, 3.0, None)], "`Canal` string, `01/01/2024` double, `01/02/2024` double, total double")
    assert rows(months_to_rows(wide, "Canal", "custo")) == [
        ("A", 20240101, 1.0), ("A", None, 5.0), ("B", 20240101, 2.0), ("B", 20240201, 3.0),
    ]
    with pytest.raises(ValueError):
        months_to_rows(wide.select("Canal"), "Canal", "custo")
    with pytest.raises(ValueError):
        months_to_rows(wide.drop("Canal"), "Canal", "custo")


def test_calendar(spark):
    import numpy as np

    days = with_calendar(date_spine(spark, "2022-01-01", "2027-12-31"))
    got = {r["id_data"]: r for r in days.collect()}
    assert len(got) == 2191
    for key in (20220101, 20240229, 20271231):
        d = datetime.strptime(str(key), "%Y%m%d").date()
        r = got[key]
        assert (r["num_dia_semana"], r["fim_de_semana"]) == (d.weekday(), int(d.weekday() >= 5))
        assert (r["ano_mes"], r["ano_mes_desc"]) == (d.year * 100 + d.month, d.strftime("%Y-%m"))
        assert (r["trimestre"], r["semestre"]) == ((d.month - 1) // 3 + 1, 1 if d.month <= 6 else 2)
    assert (got[20240301]["nome_mes"], got[20240302]["dia_semana"]) == ("Março", "Sábado")
    for key, r in got.items():
        first = np.datetime64(f"{key // 10000:04d}-{key // 100 % 100:02d}")
        assert r["dias_uteis_mes"] == np.busday_count(first, first + 1)


def test_scalars(spark):
    df = spark.createDataFrame(
        [("Ganho", "7", "15/01/2024"), ("ganho ", "7.0", "31/02/2024"), (None, "x", None), ("GANHO", "7.5", "2024-01-15")],
        "w string, n string, d string",
    )
    got = [
        tuple(r)
        for r in df.select(
            S.equals_flag(F.col("w"), "ganho"), S.lenient_number(F.col("n"), "bigint"), S.lenient_number(F.col("n")),
            S.date_key(S.lenient_timestamp(F.col("d"), "dd/MM/yyyy")),
        ).collect()
    ]
    assert got == [(1, 7, 7.0, 20240115), (0, 7, 7.0, None), (0, None, None, None), (1, None, 7.5, None)]


def test_projections(spark):
    df = spark.createDataFrame([(1, "x", 2)], "a int, `dt._venda` string, c int")
    assert keep_present(df, ["c", "nope", "a"]).columns == ["c", "a"]
    assert first_with_prefix(df, "dt") == "dt._venda" and first_with_prefix(df, "zz") is None
    shaped = conform_to(df, layout("a bigint, missing string"))
    assert shaped.schema.simpleString() == "struct<a:bigint,missing:string>" and rows(shaped) == [(1, None)]
