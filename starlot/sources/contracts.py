"""Column contracts and landing names of the source feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starlot.operators.columns import layout

# Columns each source must have, names as they are after header
# normalisation (and after the renames below).
REQUIRED = {
    "leads": [
        "id", "cliente", "canal", "atendente", "conversao", "motivo", "data_criacao", "ultima_integracao",
    ],
    "sales": ["id_venda", "data_venda", "nome_vendedor", "valor_venda", "valor_compra"],
    "sale_channels": ["codigo", "canal"],
    "appointments": [
        "id", "responsavel_agendamento", "canal", "criacao_agendamento", "agendado_para",
        "flag_agendamento", "flag_visita",
    ],
    "vehicles": ["codigo", "modelo", "ano", "cor", "tipo", "placa", "situacao"],
    "stock_brands": ["codigo", "marca"],
    "sale_brands": ["codigo", "marca"],
    "commissions": ["codigo", "comissao", "impostos", "lucro", "retorno"],
    "financing": ["data_venda", "placa", "valor_financiado", "tipo_retorno", "financeira"],
    "users": ["id_vendedor", "nome"],
    "history": ["id_vendedor", "id_loja", "loja", "data_inicio", "data_fim"],
    "seller_targets": ["id_vendedor", "ano_mes", "meta_qtd"],
    "store_targets": ["id_loja", "ano_mes", "meta_qtd"],
    "channel_map": ["canal_origem", "canal_padrao"],
    "seller_map": ["nome_origem", "nome_padrao"],
    "financier_map": ["financeira_origem", "financeira_padrao"],
    "lead_links": ["id", "link_post"],
}

# Renames from the exports' headers.
RENAMES = {
    "sales": {
        "codigo": "id_venda",
        "dt._venda": "data_venda",
        "vendedor": "nome_vendedor",
        "venda": "valor_venda",
        "compra": "valor_compra",
        "lancamentos": "custos",
        "desconto_venda": "desconto",
    },
    "financing": {
        "dt._venda": "data_venda",
        "placa/chassi": "placa",
        "financiado": "valor_financiado",
        "tp._ret.": "tipo_retorno",
    },
    "users": {"id_usuario": "id_vendedor", "nome_usuario": "nome"},
}

# File stems of the exports; a star stands for the year.
LANDING_STEMS = {
    "leads": "Leads",
    "lead_corrections": "Acertos_leads",
    "lead_links": "Leads_link",
    "sales": "Vendas_[0-9]*",
    "sale_channels": "dados_canais_*",
    "appointments": "controleagendamentos",
    "vehicles": "gerencial_estoque",
    "stock_brands": "gerencial_estoque_marca",
    "sale_brands": "Vendas_Marca_*",
    "commissions": "Vendas_comissao_*",
    "financing": "Vendas_retorno_*",
    "channel_costs": "custos_plataforma",
    "users": "usuarios",
    "history": "hist_vendedor_loja",
    "seller_targets": "meta_vendedor",
    "store_targets": "meta_loja",
    "channel_map": "de_para_canais",
    "seller_map": "de_para_vendedores",
    "financier_map": "de_para_financeira",
}

# Sources a run can do without.
OPTIONAL = {
    "lead_corrections", "lead_links", "stock_brands", "sale_brands", "commissions", "financing",
}

COMMISSION_COLUMNS = ["comissao", "impostos", "lucro", "retorno"]
COMMISSIONS = layout(
    "id_venda bigint, comissao double, impostos double, lucro double, retorno double"
)
FINANCING = layout(
    "placa string, id_data int, valor_financiado double, tipo_retorno bigint, financeira string"
)


def require_columns(df: DataFrame, source: str, required: list[str] | None = None) -> DataFrame:
    """``df`` itself, or an error that names the missing columns in order."""
    missing = sorted(set(required if required is not None else REQUIRED[source]) - set(df.columns))
    if missing:
        raise ValueError(f"{source}: required columns missing: {missing}")
    return df
