"""What tables leave on disk: shuffles go with the write, files are compressed, exports too."""

import glob
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starlot.session import materialise, releasing_shuffles
from starlot.sources.sinks import save_counted

RELEASE, CODEC = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.parquet.compression.codec"


def shuffles(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {x for x in files if "/shuffle_" in x and os.path.exists(x)}


def codecs(path):
    import pyarrow.parquet as pq

    return {pq.ParquetFile(p).metadata.row_group(0).column(0).compression for p in glob.glob(f"{path}/*.parquet")}


def grouped(spark):
    return spark.range(20_000).groupBy((F.col("id") % 5_000).alias("k")).agg(F.count(F.lit(1)).alias("n"))


def writers(tmp_path):
    return {
        "counted": lambda df: save_counted(df, f"{tmp_path}/counted"),
        "dealt": lambda df: save_counted(df, f"{tmp_path}/dealt", table="disk_dealt", buckets=(4, "k")),
        "side": lambda df: materialise(df, f"{tmp_path}/side", compact=True),
    }


@pytest.mark.parametrize("kind", ["counted", "dealt", "side"])
def test_a_written_table_leaves_no_shuffle(spark, tmp_path, kind):
    before = shuffles(spark)
    writers(tmp_path)[kind](grouped(spark))
    until = time.time() + 20
    while shuffles(spark) - before and time.time() < until:  # they go beside the next steps
        time.sleep(0.1)
    assert not shuffles(spark) - before
    assert codecs(f"{tmp_path}/{kind}") == {"ZSTD"}
    assert spark.read.parquet(f"{tmp_path}/{kind}").agg(F.sum("n")).first()[0] == 20_000
    spark.sql("DROP TABLE IF EXISTS disk_dealt")


def test_own_settings_hold(spark, tmp_path):
    assert spark.conf.get(RELEASE, None) is None
    with releasing_shuffles(spark), releasing_shuffles(spark):
        assert spark.conf.get(RELEASE) == "true"
    assert spark.conf.get(RELEASE, None) is None
    spark.conf.set(RELEASE, "false")
    spark.conf.set(CODEC, "gzip")
    try:
        with releasing_shuffles(spark):
            assert spark.conf.get(RELEASE) == "false"
        save_counted(grouped(spark), f"{tmp_path}/own")
        assert codecs(f"{tmp_path}/own") == {"GZIP"} and spark.conf.get(RELEASE) == "false"
    finally:
        spark.conf.unset(RELEASE)
        spark.conf.unset(CODEC)


def test_what_is_read_again_is_there(spark, tmp_path):
    """A query that shuffles, written and then asked twice."""
    df = grouped(spark)
    materialise(df, f"{tmp_path}/t", compact=True)
    assert df.count() == len(df.collect()) == len(df.collect()) == 5_000


def given_tables(spark, folder):
    day = lambda k: datetime(2024, 1, 1 + k, 9, 30, k, 120)
    tables = {
        "supplier": ([(k, f"Supplier#{k:09d}", 14 + k, [-5.0, 100.0, 9500.0][k % 3]) for k in range(4)],
                     "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(k, f"part {k}", f"Brand {k}", ["PROMO", "ECONOMY"][k % 2], 4 + 12 * k, 1.5) for k in range(4)],
                 "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(k, k, "F", 10.0 * k, day(k), "2-HIGH") for k in range(3)],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(k // 2, k % 4, k % 4, 1 + k % 2, 49.0, 10.5 * k, 0.1, 0.02, "ANR"[k % 3], "FO"[k % 2], day(k)) for k in range(8)],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "events": ([(k, day(k + 12), k % 4, ["view", "click", "purchase", "signup", "error"][k % 5], 6.0 * k, f'{{"k": {k}}}' if k else None) for k in range(12)],
                   "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_exports_are_compressed_and_give_the_same_leads(spark, tmp_path, monkeypatch):
    from benchmarks import queries

    d = given_tables(spark, tmp_path / "given")
    monkeypatch.setattr(queries, "shared_folder", lambda spark, purpose: f"{tmp_path}/{purpose}-{time.time_ns()}")
    found, want = (sorted(map(tuple, queries.QUERIES[n](spark, d).collect()), key=repr) for n in ("csv_landing", "fato_leads"))
    assert found == want and len(found) == 12
    exports = glob.glob(f"{tmp_path}/landing-*/*.csv/part-*")
    assert exports and all(p.endswith(".csv.gz") for p in exports)
