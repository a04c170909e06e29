"""Date spine and calendar attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlot.functions import scalars as S

# The range of the published calendar.
CALENDAR_START = "2022-01-01"
CALENDAR_END = "2027-12-31"


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day, both ends included."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("a"), F.lit(end).cast("date").alias("b"))
    days = bounds.select(F.explode(F.sequence("a", "b")).alias("day"))
    return days.select(F.col("day").cast("timestamp_ntz").alias("data"))


def with_calendar(days: DataFrame, day: str = "data") -> DataFrame:
    """Calendar attributes of a day column; row-wise, so nothing is shuffled."""
    when = S.col(day)
    weekday = F.weekday(when)
    return days.select(
        "*",
        S.date_key(when).alias("id_data"),
        F.year(when).alias("ano"),
        F.month(when).alias("mes"),
        S.month_key(when).alias("ano_mes"),
        S.month_name(F.month(when)).alias("nome_mes"),
        F.date_format(when, "yyyy-MM").alias("ano_mes_desc"),
        F.quarter(when).alias("trimestre"),
        S.half_year(when).alias("semestre"),
        weekday.alias("num_dia_semana"),
        S.weekday_name(weekday).alias("dia_semana"),
        F.when(weekday >= 5, 1).otherwise(0).alias("fim_de_semana"),
        S.business_days_in_month(when).alias("dias_uteis_mes"),
    )
