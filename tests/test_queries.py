"""A few registered queries beside their SQL twins; ``benchmarks.compare`` runs them all."""

import glob
import os

import pytest

import __spark_entry__ as contract
from benchmarks.compare import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")

FAST = [
    "store_at_event", "store_at_event_by_date", "normalise_documents", "map_codes", "stage_lookup",
    "keep_latest_event", "brand_fill", "unpivot_costs", "calendar_orders", "customer_keys", "feed_commissions",
]


@pytest.fixture(scope="module")
def twin():
    import duckdb

    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        view = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_query_has_a_twin():
    from benchmarks.queries import QUERIES

    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, twin, name):
    line = compare(spark, SF, name, contract.queries()[name], contract.oracle_sql()[name], twin)
    assert line.startswith("ok"), line


def test_results_do_not_depend_on_shuffle_partitions(spark, twin):
    for partitions in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        for name in ("store_at_event", "feed_commissions"):
            line = compare(spark, SF, name, contract.queries()[name], contract.oracle_sql()[name], twin)
            assert line.startswith("ok"), line


def test_lineitem_is_not_shuffled_before_the_group(spark):
    """Flagship: only what was grouped leaves a task; the scan reads three columns."""
    df = contract.entry(spark)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert plan.count("Exchange hashpartitioning(id_loja") == 1
