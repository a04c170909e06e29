"""Acceptance checks, match rates and counts.

Each check is one aggregate over one table. It can be evaluated over a table, or be observed while the table
is written, in which case the report costs no job of its own.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlot.functions.scalars import UNKNOWN, col
from starlot.sources.sinks import Saved

# Thresholds and words of the acceptance criteria.
MAX_UNKNOWN_BRAND = 0.05
MIN_COMMISSION = 0.90
RETURNED, UNKNOWN_BRAND = "devolvido", "desconhecida"
CALENDAR_FROM, CALENDAR_TO = "2022-01-01", "2027-12-31"
CALENDAR_COLUMNS = ["trimestre", "semestre", "dia_semana", "dias_uteis_mes"]


def share(predicate: Column) -> Column:
    """Share of rows for which ``predicate`` holds; a null counts as not."""
    return F.avg(F.coalesce(predicate, F.lit(False)).cast("int"))


class Check(NamedTuple):
    """A value over a table, whether it passes, and the limit that is reported with it."""

    name: str
    value: Column
    passed: Column
    threshold: float


def _brand() -> Check:
    active = ~col("situacao").eqNullSafe(RETURNED)
    unknown = F.avg(F.when(active, F.coalesce(col("marca") == UNKNOWN_BRAND, F.lit(False)).cast("int")))
    return Check("unknown_brand", unknown, unknown < MAX_UNKNOWN_BRAND, MAX_UNKNOWN_BRAND)


def _commission() -> Check:
    covered = share(col("comissao").isNotNull())
    return Check("commission_coverage", covered, covered >= MIN_COMMISSION, MIN_COMMISSION)


def _calendar_range(start: str = CALENDAR_FROM, end: str = CALENDAR_TO) -> Check:
    """Both ends as expected and, between them, no day missing."""
    day = col("data").cast("date")
    first, last = F.min(day), F.max(day)
    ends = (first == F.lit(start).cast("date")) & (last == F.lit(end).cast("date"))
    # A calendar has some thousand days, so they may stand in one set.
    missing = F.datediff(last, first) + 1 - F.size(F.collect_set(day))
    return Check("calendar_range", missing, ends & (missing == 0), 0)


def _calendar_nulls() -> Check:
    nulls = reduce(lambda a, b: a + b, [F.count_if(col(n).isNull()) for n in CALENDAR_COLUMNS])
    return Check("calendar_nulls", nulls, nulls == 0, 0)


def _cost_channels() -> Check:
    orphans = F.count_if(col("id_canal") == UNKNOWN)
    return Check("costs_without_channel", orphans, orphans == 0, 0)


def _evaluated(df: DataFrame, check: Check) -> DataFrame:
    """One row from one aggregate; an empty table gives a null value and does not pass."""
    return df.agg(check.value.cast("double").alias("value"), check.passed.alias("__ok")).select(
        F.lit(check.name).alias("check"), F.coalesce("__ok", F.lit(False)).alias("passed"), "value",
        F.lit(float(check.threshold)).alias("threshold"),
    )


def brand_check(vehicles: DataFrame) -> DataFrame:
    return _evaluated(vehicles, _brand())


def commission_check(sales: DataFrame) -> DataFrame:
    return _evaluated(sales, _commission())


def calendar_range_check(calendar: DataFrame, start: str = CALENDAR_FROM, end: str = CALENDAR_TO) -> DataFrame:
    return _evaluated(calendar, _calendar_range(start, end))


def calendar_null_check(calendar: DataFrame) -> DataFrame:
    return _evaluated(calendar, _calendar_nulls())


def cost_channel_check(costs: DataFrame) -> DataFrame:
    return _evaluated(costs, _cost_channels())


def sales_rows_check(sales: DataFrame, raw_sales: DataFrame | int) -> DataFrame:
    """Rows gained or lost between the raw sales and the fact; both are faults."""
    if isinstance(raw_sales, int):
        change = F.count(F.lit(1)) - F.lit(raw_sales)
        return _evaluated(sales, Check("sales_rows_kept", change, change == 0, 0))
    sides = sales.agg(F.count(F.lit(1)).alias("n")).unionByName(
        raw_sales.agg((-F.count(F.lit(1))).alias("n"))
    )
    return _evaluated(sides, Check("sales_rows_kept", F.sum("n"), F.sum("n") == 0, 0))


def quality_report(
    tables: dict[str, DataFrame], raw_sales: DataFrame | int | None = None,
    calendar_range: tuple[str, str] = (CALENDAR_FROM, CALENDAR_TO),
) -> DataFrame:
    """``(check, passed, value, threshold)`` for the checks whose tables are present."""
    checks = []
    if "dim_veiculos" in tables:
        checks.append(brand_check(tables["dim_veiculos"]))
    if "fato_vendas" in tables:
        if "comissao" in tables["fato_vendas"].columns:
            checks.append(commission_check(tables["fato_vendas"]))
        if raw_sales is not None:
            checks.append(sales_rows_check(tables["fato_vendas"], raw_sales))
    if "dim_data" in tables:
        checks.append(calendar_range_check(tables["dim_data"], *calendar_range))
        checks.append(calendar_null_check(tables["dim_data"]))
    if "fato_custos_canal" in tables:
        checks.append(cost_channel_check(tables["fato_custos_canal"]))
    if not checks:
        raise ValueError("no table to check")
    return reduce(lambda a, b: a.unionByName(b), checks)


# --- the same, observed while tables are written -----------------------------

OBSERVED = {
    "dim_veiculos": (_brand,), "fato_vendas": (_commission,), "dim_data": (_calendar_range, _calendar_nulls),
    "fato_custos_canal": (_cost_channels,),
}
RATED = ("fato_leads", "fato_vendas", "fato_agendamentos")


def observed_columns(table: str) -> list[Column]:
    """The aggregates to observe while ``table`` is written."""
    found = []
    for check in (make() for make in OBSERVED.get(table, ())):
        found += [check.value.cast("double").alias(check.name), check.passed.alias(f"{check.name} ok")]
    if table in RATED:
        found += [share(col("id_vendedor") == UNKNOWN).alias("unknown_seller"), share(col("id_loja") == UNKNOWN).alias("unknown_store")]
    return found


def observed_report(spark: SparkSession, saved: Mapping[str, Saved], raw_sales: int | None = None) -> DataFrame:
    """``quality_report`` from what was observed of the tables in ``saved``; no table is read."""
    rows = []
    for table in ("dim_veiculos", "fato_vendas", "dim_data", "fato_custos_canal"):
        if table not in saved:
            continue
        seen = saved[table].metrics
        for check in (make() for make in OBSERVED[table]):
            rows.append((check.name, bool(seen[f"{check.name} ok"]), seen[check.name], float(check.threshold)))
        if table == "fato_vendas" and raw_sales is not None:
            change = saved[table].rows - raw_sales
            rows.append(("sales_rows_kept", change == 0, float(change), 0.0))
    return spark.createDataFrame(rows, "check string, passed boolean, value double, threshold double")


def observed_rates(spark: SparkSession, saved: Mapping[str, Saved]) -> DataFrame:
    """``match_rates`` from what was observed."""
    rows = [(t, saved[t].metrics["unknown_seller"], saved[t].metrics["unknown_store"]) for t in RATED if t in saved]
    return spark.createDataFrame(rows, "table_name string, unknown_seller double, unknown_store double")


def match_rates(tables: dict[str, DataFrame]) -> DataFrame:
    """Share of rows with an unknown seller or store, one aggregate per fact."""
    rows = [
        df.agg(
            share(col("id_vendedor") == UNKNOWN).alias("unknown_seller"),
            share(col("id_loja") == UNKNOWN).alias("unknown_store"),
        ).select(F.lit(name).alias("table_name"), "unknown_seller", "unknown_store")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)
