"""Conformed feeds: raw exports cleaned, coded and keyed, one function per source.

Inputs have normalised, renamed headers as ``scan`` delivers them.  Where several
rows compete, ``_file`` and ``_row`` (if present) tell which came first.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlot.functions import scalars as S
from starlot.functions.scalars import col
from starlot.functions.text import normalise_headers, normalise_text
from starlot.operators.columns import conform_to, first_with_prefix
from starlot.operators.dedup import keep_first, keep_latest
from starlot.operators.lookup import Side, apply_code_map, code_map_side, map_conflicts
from starlot.operators.overlay import fill_by_priority, overlay
from starlot.operators.reshape import months_to_rows
from starlot.sources.contracts import COMMISSION_COLUMNS, COMMISSIONS, FINANCING, require_columns
from starlot.sources.scan import BLOCK, FILE, ROW

# Words of the exports and literals of the tables.
WON, LOST, YES = "ganho", "perdido", "sim"
UNKNOWN_BRAND = "desconhecida"
# Rows of a source's first set stand before those of its corrections.
SET = "_set"
VEHICLE_COLUMNS = ["codigo", "modelo", "ano", "cor", "tipo", "placa", "situacao"]


def arrival(df: DataFrame, *extra: str) -> list[str]:
    """Order columns of ``df`` that it has: set, file, block and row, then the named ones."""
    return [name for name in (SET, FILE, BLOCK, ROW, *extra) if name in df.columns]


def when(df: DataFrame, name: str, formats: tuple[str, ...]) -> Column:
    """A date column; text is read by the given formats, unreadable text is null."""
    is_text = df.schema[name].dataType.simpleString() == "string"
    return S.lenient_timestamp(col(name), *(formats if is_text else ()))


def whole(df: DataFrame, name: str, kind: str = "bigint") -> Column:
    """A whole-number column; only text, as from CSV files, is parsed."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return col(name)
    return number(df, name, kind)


def number(df: DataFrame, name: str, kind: str = "double") -> Column:
    """A number column by the rules of ``lenient_number``; what is a number already is not written out to be read again."""
    held = df.schema[name].dataType
    if isinstance(held, (T.IntegralType, T.DecimalType)) and kind == "double":
        return col(name).cast(kind)
    if isinstance(held, T.DoubleType) and kind == "double":
        return S.finite(col(name))
    return S.lenient_number(col(name), kind)


# The code maps with their columns: what an export says, and what it is to be called.
CODE_MAPS = {
    "channel_map": ("canal_origem", "canal_padrao"), "seller_map": ("nome_origem", "nome_padrao"),
    "financier_map": ("financeira_origem", "financeira_padrao"),
}


def conflicts(raw: Mapping[str, DataFrame]) -> DataFrame:
    """``(map_name, origin, kept, map_rows, targets)``: where a code map contradicts itself, for all maps there are."""
    found = [
        map_conflicts(require_columns(raw[name], name), *columns).select(F.lit(name).alias("map_name"), "*")
        for name, columns in CODE_MAPS.items() if name in raw
    ]
    return reduce(lambda a, b: a.unionByName(b), found)


def channel_map(mapping: DataFrame, strict: bool = False) -> Side:
    return code_map_side(require_columns(mapping, "channel_map"), *CODE_MAPS["channel_map"], strict)


def seller_map(mapping: DataFrame, strict: bool = False) -> Side:
    return code_map_side(require_columns(mapping, "seller_map"), *CODE_MAPS["seller_map"], strict)


def financier_map(mapping: DataFrame, strict: bool = False) -> Side:
    return code_map_side(require_columns(mapping, "financier_map"), *CODE_MAPS["financier_map"], strict)


def conform_leads(
    raw: DataFrame, channels: Side, corrections: DataFrame | None = None, formats: tuple[str, ...] = ()
) -> DataFrame:
    leads = raw.withColumn(SET, F.lit(0))
    if corrections is not None:
        leads = overlay(leads, corrections.withColumn(SET, F.lit(1)), "id")
    leads = require_columns(leads, "leads")
    created, touched = when(leads, "data_criacao", formats), when(leads, "ultima_integracao", formats)
    dated = {"id": whole(leads, "id"), "data_criacao": created, "ultima_integracao": touched}
    keyed = leads.withColumns(dated).withColumns(
        {
            "convertido_flag": S.equals_flag(col("conversao"), WON),
            "perdido_flag": S.equals_flag(col("conversao"), LOST),
            "id_data": S.date_key(col("data_criacao")),
            "id_data_ultima_integracao": S.date_key(col("ultima_integracao")),
        }
    )
    return apply_code_map(keyed, "canal", channels)


def conform_sales(raw: DataFrame, formats: tuple[str, ...] = ()) -> DataFrame:
    sales = require_columns(raw, "sales")
    typed = {"id_venda": whole(sales, "id_venda"), "data_venda": when(sales, "data_venda", formats)}
    return sales.withColumns(typed).withColumns(
        {"id_data": S.date_key(col("data_venda")), "ano_mes": S.month_key(col("data_venda"))}
    )


def conform_sale_channels(raw: DataFrame, channels: Side, order: list[str] | None = None) -> DataFrame:
    """One channel per sale code: the first in file order, which is the oldest file's; its place stays."""
    raw = require_columns(raw, "sale_channels")
    order = arrival(raw) if order is None else order
    rows = raw.select("codigo", "canal", *[col(n) for n in order]).dropna(subset=["codigo", "canal"])
    rows = rows.withColumn("codigo", col("codigo").cast("bigint"))
    return apply_code_map(keep_first(rows, ["codigo"], order), "canal", channels)


def conform_appointments(raw: DataFrame, channels: Side, formats: tuple[str, ...] = ()) -> DataFrame:
    rows = require_columns(raw, "appointments")
    made, due = when(rows, "criacao_agendamento", formats), when(rows, "agendado_para", formats)
    dated = {"id": whole(rows, "id"), "criacao_agendamento": made, "agendado_para": due}
    keyed = rows.withColumns(dated).withColumns(
        {
            "id_data_agendamento": S.date_key(col("criacao_agendamento")),
            "id_data_visita": S.date_key(col("agendado_para")),
            "flag_agendamento": S.equals_flag(col("flag_agendamento"), YES),
            "flag_visita": S.equals_flag(col("flag_visita"), YES),
        }
    )
    return apply_code_map(keyed, "canal", channels)


def stock_brands(raw: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Brand per vehicle code in current stock: the first row that has both."""
    rows = require_columns(raw, "stock_brands")
    order = arrival(rows) if order is None else order
    rows = rows.select(number(rows, "codigo", "bigint").alias("codigo"), "marca", *order)
    return keep_first(rows.dropna(subset=["codigo", "marca"]), ["codigo"], order).select("codigo", "marca")


def sale_brands(raw: DataFrame, order: list[str] | None = None, formats: tuple[str, ...] = ()) -> DataFrame:
    """Brand per vehicle code at its latest sale; undated sales come last.

    The date is the first column whose name starts with ``dt``.
    """
    rows = require_columns(raw, "sale_brands")
    order = arrival(rows) if order is None else order
    dated = first_with_prefix(rows, "dt")
    sold = when(rows, dated, formats) if dated else F.lit(None).cast("timestamp_ntz")
    # Most sales name no brand, so that is asked before codes are read.
    rows = rows.where(col("marca").isNotNull()).select(
        number(rows, "codigo", "bigint").alias("codigo"), "marca", sold.alias("__sold"), *order
    )
    latest = keep_latest(rows.dropna(subset=["codigo"]), ["codigo"], ["__sold", *order])
    return latest.select("codigo", "marca")


def conform_vehicles(
    raw: DataFrame, in_stock: DataFrame | None = None, at_sale: DataFrame | None = None
) -> DataFrame:
    """Distinct vehicles with their brand: stock first, then latest sale, then unknown."""
    base = require_columns(raw, "vehicles").select(*VEHICLE_COLUMNS).distinct()
    typed = {"codigo": col("codigo").cast("bigint"), "ano": whole(base, "ano", "int")}
    base = base.withColumns(typed).withColumn("id_veiculo", col("codigo"))
    sources = [(brands, "codigo", "marca") for brands in (in_stock, at_sale) if brands is not None]
    return fill_by_priority(base, "codigo", "marca", sources, UNKNOWN_BRAND)


def conform_commissions(raw: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Commission values per sale code: the first row with a readable code."""
    rows = require_columns(raw, "commissions")
    order = arrival(rows) if order is None else order
    rows = rows.select(
        number(rows, "codigo", "bigint").alias("id_venda"),
        *[number(rows, name).alias(name) for name in COMMISSION_COLUMNS],
        *[col(n) for n in order],
    ).dropna(subset=["id_venda"])
    return conform_to(keep_first(rows, ["id_venda"], order), COMMISSIONS)


def conform_financing(
    raw: DataFrame, financiers: Side, order: list[str] | None = None, formats: tuple[str, ...] = ()
) -> DataFrame:
    """Financing per normalised plate and date key, first row kept; blank plates never match a sale."""
    rows = require_columns(raw, "financing")
    order = arrival(rows) if order is None else order
    rows = rows.select(
        normalise_text(col("placa")).alias("placa"),
        S.date_key(when(rows, "data_venda", formats)).alias("id_data"),
        number(rows, "valor_financiado").alias("valor_financiado"),
        number(rows, "tipo_retorno", "bigint").alias("tipo_retorno"),
        "financeira", *[col(n) for n in order],
    ).filter("placa <> '' and id_data is not null")
    first = keep_first(rows, ["placa", "id_data"], order).drop(*order)
    return conform_to(apply_code_map(first, "financeira", financiers), FINANCING)


def conform_channel_costs(raw: DataFrame, channels: Side | None = None) -> DataFrame:
    """Long costs from the month matrix; a code map is applied only when given."""
    long = months_to_rows(raw, "Canal", "custo")
    costs = long.select(normalise_text(col("Canal")).alias("canal"), "id_data", "custo")
    return costs if channels is None else apply_code_map(costs, "canal", channels)


def conform_users(raw: DataFrame) -> DataFrame:
    users = require_columns(raw, "users")
    return users.withColumns({"id_vendedor": col("id_vendedor").cast("bigint"), "nome": normalise_text(col("nome"))})


def conform_history(raw: DataFrame, formats: tuple[str, ...] = ()) -> DataFrame:
    """Seller assignments; an unreadable date is an error here, not a null."""
    rows = require_columns(raw, "history")

    def strict(name: str) -> Column:
        if rows.schema[name].dataType.simpleString() == "string" and formats:
            tries = [F.try_to_timestamp(col(name), F.lit(f)) for f in formats[:-1]]
            return F.coalesce(*tries, F.to_timestamp(col(name), formats[-1])).cast("timestamp_ntz")
        return col(name).cast("timestamp_ntz")

    return rows.withColumns(
        {
            "id_vendedor": col("id_vendedor").cast("bigint"),
            "id_loja": col("id_loja").cast("bigint"),
            "data_inicio": strict("data_inicio"),
            "data_fim": strict("data_fim"),
        }
    )


def conform_targets(raw: DataFrame, source: str) -> DataFrame:
    rows = require_columns(raw, source)
    keys = {name: col(name).cast("bigint") for name in ("id_vendedor", "id_loja") if name in rows.columns}
    return rows.withColumns(
        keys | {"ano_mes": col("ano_mes").cast("int"), "meta_qtd": whole(rows, "meta_qtd").cast("bigint")}
    )


def conform_links(raw: DataFrame) -> DataFrame:
    """One link per lead; the source does not promise it, so the first in file order stays."""
    rows = require_columns(normalise_headers(raw), "lead_links")
    order = arrival(rows)
    rows = rows.select(whole(rows, "id").alias("id"), "link_post", *order)
    return keep_first(rows, ["id"], order).select("id", "link_post")
