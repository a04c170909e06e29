"""Facts of the star.  Every source row comes back exactly once."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlot.functions import scalars as S
from starlot.functions.scalars import col
from starlot.functions.text import normalise_text
from starlot.operators.columns import conform_to
from starlot.operators.dedup import keep_first
from starlot.operators.lookup import (
    Side, apply_code_map, as_side, left_lookup, lookup_key, unmatched,
)
from starlot.operators.temporal import PeriodSide, period_side, value_at
from starlot.sources.contracts import COMMISSION_COLUMNS
from starlot.sources.feeds import arrival, number
from starlot.plans.schemas import FACT_APPOINTMENTS, FACT_LEADS, FACT_SALES


# A sale is told by its number, and looked up by its code, and by its plate and day.
SALE_KEY, PLATE = "_sale", "_plate"
LOOKED_UP = ("id_venda", PLATE, "id_data")
# What a sale takes from its code's attributes and from financing.
OF_CODE = {n: n for n in ("id_canal", "id_veiculo", *COMMISSION_COLUMNS)}
OF_PLATE = {n: n for n in ("valor_financiado", "tipo_retorno", "financeira")}
# Amounts of the export itself, kept beside those that are found.
OWN = "_own_"


class Sellers(NamedTuple):
    """Sides that resolve who sold and for which store; sized once for all facts."""

    code_map: Side
    names: Side
    periods: PeriodSide
    by_date: bool


def seller_sides(
    sellers: DataFrame, history: DataFrame, code_map: Side, by_date: bool = False
) -> Sellers:
    """An empty name is nobody; of two sellers with one name the lowest id stays."""
    named = sellers.select("nome", "id_vendedor").filter("nome <> ''")
    names = as_side(keep_first(named, ["nome"], ["id_vendedor"]))
    return Sellers(code_map, names, period_side(history, "id_vendedor", "id_loja", by_date=by_date), by_date)


def with_seller_and_store(df: DataFrame, name: str, at: str, sellers: Sellers) -> DataFrame:
    """Add ``id_vendedor`` and the ``id_loja`` the seller belonged to at the event's time.

    ``name`` is normalised and mapped first; unknown sellers and stores get -1.
    """
    coded = apply_code_map(df, name, sellers.code_map)
    known = lookup_key(coded, sellers.names, {name: "nome"}, "id_vendedor", "id_vendedor")
    return value_at(known, sellers.periods, "id_vendedor", at, "id_loja", sellers.by_date)


def with_channel(df: DataFrame, channels: DataFrame | Side) -> DataFrame:
    return lookup_key(df, channels, {"canal": "canal"}, "id_canal", "id_canal")


def leads_fact(
    leads: DataFrame, channels: DataFrame | Side, stages: DataFrame | Side, sellers: Sellers,
    appointments: DataFrame | None = None, links: DataFrame | None = None,
    appointment_order: list[str] | None = None,
) -> DataFrame:
    """One row per lead; ``id_sdr`` is the seller of its first appointment, null without one."""
    fact = with_channel(with_seller_and_store(leads, "atendente", "data_criacao", sellers), channels)
    if "estagio" in fact.columns:
        fact = left_lookup(fact, stages, {"estagio": "estagio"}, {"id_estagio": "id_estagio"}, null_safe=True)
    if appointments is not None:
        order = appointment_order or arrival(appointments)
        if not order:
            raise ValueError("appointments need their order to tell which came first")
        owners = appointments.select("id", *dict.fromkeys(["id_vendedor", *order])).dropna(subset=["id"])
        owner = keep_first(owners, ["id"], order).select("id", col("id_vendedor").alias("id_sdr"))
        fact = left_lookup(fact, owner, {"id": "id"}, {"id_sdr": "id_sdr"})
    if links is not None:
        fact = left_lookup(fact, links, {"id": "id"}, {"link_post": "__link"})
        own = [col("link_post")] if "link_post" in fact.columns else []
        fact = fact.withColumn("link_post", F.coalesce(col("__link"), *own))
    return conform_to(fact, FACT_LEADS)


def sale_attributes(
    sale_channels: DataFrame, vehicles: DataFrame, commissions: DataFrame
) -> DataFrame:
    """What is known per sale code: channel, vehicle and commission in one row.

    The three tables are stacked and grouped, so the sales meet them in one join
    instead of three.  Each has one row per code, hence ``max`` picks its only value.
    """
    codes = [
        sale_channels.select(col("codigo").alias("code"), "canal"),
        vehicles.select(col("id_veiculo").alias("code"), "id_veiculo"),
        commissions.select(col("id_venda").alias("code"), *COMMISSION_COLUMNS),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), codes).dropna(subset=["code"])
    values = [name for name in stacked.columns if name != "code"]
    return stacked.groupBy("code").agg(*[F.max(name).alias(name) for name in values])


def with_sale_key(sales: DataFrame) -> DataFrame:
    """Add the plate by which financing is found, null where blank, and the sale's number.

    The number tells a row by its place, so it holds from when the sales are written.
    """
    plate = F.nullif(normalise_text(col("placa")), F.lit("")) if "placa" in sales.columns else F.lit(None).cast("string")
    return sales.withColumn(PLATE, plate).withColumn(SALE_KEY, F.monotonically_increasing_id())


class SaleSides(NamedTuple):
    """What sales are looked up in; ``blank`` is the channel of a sale whose code is not known."""

    attributes: Side
    financing: Side
    sellers: Sellers
    blank: int


def sale_sides(attributes: DataFrame, channels: DataFrame | Side, financing: DataFrame | Side, sellers: Sellers) -> SaleSides:
    """Sides of the sales with their sizes; the channel is found once per code, not per sale."""
    named = with_channel(attributes.withColumn("canal", normalise_text(col("canal"))), channels).drop("canal")
    none = attributes.sparkSession.createDataFrame([("",)], "canal string")
    return SaleSides(as_side(named), as_side(financing), sellers, with_channel(none, channels).first()["id_canal"])


def _answers(asking: DataFrame, side: Side, on: dict[str, str], take: dict[str, str]) -> DataFrame:
    """What ``side`` has for the sales, by their number; sales without an answer are left out."""
    known = side._replace(df=side.df.withColumn("__known", F.lit(True)))
    found = left_lookup(asking.select(SALE_KEY, *[col(n) for n in on]), known, on, {**take, "__known": "__known"})
    return found.where("__known").drop("__known", *on)


def _with_answers(sales: DataFrame, answers: DataFrame) -> DataFrame:
    names = [n for n in answers.columns if n != SALE_KEY]
    right = answers.select(col(SALE_KEY).alias("__number"), *[col(n).alias(f"__{n}") for n in names])
    met = sales.join(right, col(SALE_KEY) == col("__number"), "left")
    return met.select(*[col(n) for n in sales.columns if n not in names], *[col(f"__{n}").alias(n) for n in names])


def looked_up(sales: DataFrame, sides: SaleSides) -> DataFrame:
    """Add channel, vehicle, commission, financing, seller and store to sales that were written with their number.

    Small sides are broadcast.  If one side is large the sales move to it; if several are, each gets the number and what is
    asked for, no more, and all answers meet the sales in one place.  Numbers are unique, so no key is hot there.
    """
    sellers = sides.sellers
    placed = sellers.code_map.small and sellers.names.small and sellers.periods.small
    apart = [sides.attributes.small, sides.financing.small, placed].count(False) > 1
    found = sales
    for side, on, take in (
        (sides.attributes, {"id_venda": "code"}, OF_CODE), (sides.financing, {PLATE: "placa", "id_data": "id_data"}, OF_PLATE),
    ):
        if apart and not side.small:
            found = _with_answers(found, _answers(sales, side, on, take))
        else:
            found = left_lookup(found, side, on, take)
    if apart and not placed:
        asked = with_seller_and_store(sales.select(SALE_KEY, "nome_vendedor", "data_venda"), "nome_vendedor", "data_venda", sellers)
        found = _with_answers(found, asked.select(SALE_KEY, "id_vendedor", "id_loja"))
    else:
        found = with_seller_and_store(found, "nome_vendedor", "data_venda", sellers)
    return found.withColumn("id_canal", F.coalesce(col("id_canal"), F.lit(sides.blank)))


def sale_details(sales: DataFrame, sides: SaleSides) -> DataFrame:
    """All that is found for each sale, by its number, with what it is looked up by."""
    return looked_up(sales.select(SALE_KEY, *[col(n) for n in (*LOOKED_UP, "nome_vendedor", "data_venda")]), sides).drop("nome_vendedor", "data_venda")


def sales_found(sales: DataFrame, sides: SaleSides) -> DataFrame:
    """One row per sale with channel, seller, store, vehicle, commission and financing."""
    own = [n for n in COMMISSION_COLUMNS if n in sales.columns]
    kept = sales.withColumns({f"{OWN}{n}": number(sales, n) for n in own})
    return conform_to(_or_own(looked_up(kept, sides), own), FACT_SALES)


def _or_own(found: DataFrame, own: list[str]) -> DataFrame:
    """An amount the export already carries stays where the commission table has none."""
    return found.withColumns({n: F.coalesce(col(n), col(f"{OWN}{n}")) for n in own})


def sales_fact(sales: DataFrame, details: DataFrame | Side, sellers: Sellers) -> DataFrame:
    """``sales_found`` from details that were written: where both lie in the same buckets of the sale's number, no sale moves.

    The join compares what a sale is looked up by as well, as details may be those of other sales.
    """
    side = as_side(details)
    right = side.df.select(*[col(n).alias(f"__{n}") for n in side.df.columns])
    # Written so that it adds no join key: the tables lie by the number alone.
    alike = [F.coalesce(col(n) == col(f"__{n}"), col(n).isNull() & col(f"__{n}").isNull()) for n in LOOKED_UP]
    same = reduce(lambda a, b: a & b, [F.when(x, 1).otherwise(0) > 0 for x in alike])
    found = sales.join(F.broadcast(right) if side.small else right, (col(SALE_KEY) == col(f"__{SALE_KEY}")) & same, "left")
    own = {n: number(sales, n).alias(f"{OWN}{n}") for n in COMMISSION_COLUMNS if n in sales.columns}
    taken = [n for n in side.df.columns if n not in (SALE_KEY, *LOOKED_UP)]
    fact = found.select(*[col(n) for n in sales.columns if n not in taken], *own.values(), *[col(f"__{n}").alias(n) for n in taken])
    if "id_loja" not in taken:
        fact = with_seller_and_store(fact, "nome_vendedor", "data_venda", sellers)
    return conform_to(_or_own(fact, list(own)), FACT_SALES)


def appointments_seen(rows: DataFrame, channels: DataFrame | Side, sellers: Sellers) -> DataFrame:
    """Appointments with seller, store and channel, still with the order in which they came."""
    seen = with_seller_and_store(rows, "responsavel_agendamento", "criacao_agendamento", sellers)
    return with_channel(seen, channels)


def appointments_fact(rows: DataFrame, channels: DataFrame | Side, sellers: Sellers) -> DataFrame:
    return conform_to(appointments_seen(rows, channels, sellers), FACT_APPOINTMENTS)


def _dated_targets(targets: DataFrame) -> DataFrame:
    return targets.withColumns(
        {"data_meta": S.month_start(col("ano_mes")), "id_data": (col("ano_mes") * 100 + 1).cast("int")}
    )


def seller_targets_fact(targets: DataFrame, seller_months: DataFrame | Side) -> DataFrame:
    """Monthly seller targets with the store of that month; no store stays null."""
    dated = _dated_targets(targets)
    found = left_lookup(
        dated, seller_months, {"id_vendedor": "id_vendedor", "ano_mes": "ano_mes"}, {"id_loja": "id_loja"}
    )
    return found.select("id_vendedor", "ano_mes", "data_meta", "id_data", "id_loja", "meta_qtd")


def store_targets_fact(targets: DataFrame) -> DataFrame:
    return _dated_targets(targets).select("id_loja", "ano_mes", "data_meta", "id_data", "meta_qtd")


def channel_costs_fact(costs: DataFrame, channels: DataFrame | Side) -> DataFrame:
    return with_channel(costs, _normalised(channels)).select("id_canal", "id_data", "custo")


def unmatched_channels(costs: DataFrame, channels: DataFrame) -> DataFrame:
    """Cost channels without a member in the channel dimension."""
    return unmatched(costs, _normalised(channels), {"canal": "canal"})


def _normalised(channels: DataFrame | Side) -> DataFrame:
    """Members by normalised name; the lowest key where two names fall together."""
    members = channels.df if isinstance(channels, Side) else channels
    clean = members.select(normalise_text(col("canal")).alias("canal"), "id_canal")
    return clean.groupBy("canal").agg(F.min("id_canal").alias("id_canal"))
