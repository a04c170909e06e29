"""Dimensions of the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starlot.functions.scalars import UNKNOWN, col
from starlot.functions.text import normalise_text
from starlot.operators.calendar import CALENDAR_END, CALENDAR_START, date_spine, with_calendar
from starlot.operators.keys import dense_keys, first_appearance, one_after_another, surrogate_keys
from starlot.operators.lookup import unknown_member
from starlot.operators.temporal import months_of_periods

# Names of the unknown members.
UNKNOWN_SELLER, UNKNOWN_STORE = "desconhecido", "desconhecida"


def channel_dim(
    leads: DataFrame, sale_channels: DataFrame, lead_order: list[str] | None = None,
    sale_order: list[str] | None = None,
) -> DataFrame:
    """``(canal, id_canal)`` of all channels of leads, then of sales, by first appearance.

    Each source is scanned once and reduced to its distinct channels.
    """
    members = one_after_another(
        first_appearance(leads.dropna(subset=["canal"]), ["canal"], lead_order or []),
        first_appearance(sale_channels.dropna(subset=["canal"]), ["canal"], sale_order or []),
    )
    return dense_keys(members, "id_canal", ["canal"], kind="int").select("canal", "id_canal")


def calendar_dim(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    return with_calendar(date_spine(spark, start, end))


def seller_dim(users: DataFrame) -> DataFrame:
    return unknown_member(users, id_vendedor=UNKNOWN, nome=UNKNOWN_SELLER)


def store_dim(history: DataFrame) -> DataFrame:
    return unknown_member(history.select("id_loja", "loja").distinct(), id_loja=UNKNOWN, loja=UNKNOWN_STORE)


def vehicle_dim(vehicles: DataFrame) -> DataFrame:
    texts = {name: normalise_text(col(name)) for name in ("marca", "modelo", "cor", "tipo", "situacao")}
    return vehicles.withColumns(texts).select(
        "id_veiculo", "marca", "modelo", "ano", "cor", "tipo", "placa", "situacao"
    )


def stage_dim(leads: DataFrame, order: list[str] | None = None) -> DataFrame:
    """``(estagio, id_estagio)``; a missing stage is a member of its own."""
    return surrogate_keys(leads, "estagio", "id_estagio", order, "int")


def seller_month_dim(history: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Store per seller and month, first period in order; for audits, not a bridge table."""
    months = months_of_periods(history, "id_vendedor", "id_loja", order=order)
    return months.select("id_vendedor", "id_loja", "ano_mes")
