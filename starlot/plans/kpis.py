"""Channel cost KPIs per channel and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlot.functions.scalars import UNKNOWN, col, month_of_date_key

MONEY = "decimal(18,2)"


def _monthly_costs(costs: DataFrame) -> DataFrame:
    known = costs.filter(col("id_canal") != UNKNOWN)
    return known.groupBy("id_canal", month_of_date_key(col("id_data")).alias("ano_mes")).agg(
        F.sum(col("custo").cast(MONEY)).alias("total")
    )


def _cost_per(costs: DataFrame, leads: DataFrame, counted: Column, n: str, ratio: str) -> DataFrame:
    """Both facts are aggregated before they meet, so no cost is counted per lead.

    What is joined has one row per channel and month.
    """
    monthly = leads.groupBy("id_canal", month_of_date_key(col("id_data")).alias("ano_mes")).agg(
        F.count_if(counted).alias(n)
    )
    joined = _monthly_costs(costs).join(monthly, ["id_canal", "ano_mes"], "left")
    total = col("total").cast("double")
    return joined.select(
        "id_canal", "ano_mes", total.alias("custo"), F.coalesce(col(n), F.lit(0)).alias(n),
        F.try_divide(total, col(n).cast("double")).alias(ratio),
    )


def cost_per_lead(costs: DataFrame, leads: DataFrame) -> DataFrame:
    """Months without leads keep their cost and have a null ratio."""
    return _cost_per(costs, leads, F.lit(True), "leads", "custo_por_lead")


def cost_per_sale(costs: DataFrame, leads: DataFrame) -> DataFrame:
    """As ``cost_per_lead``, per converted lead."""
    return _cost_per(costs, leads, col("convertido_flag") == 1, "vendas", "custo_por_venda")


def total_cost(costs: DataFrame) -> DataFrame:
    totals = costs.groupBy("id_canal").agg(F.sum(col("custo").cast(MONEY)).alias("total"))
    return totals.select("id_canal", col("total").cast("double").alias("custo"))
