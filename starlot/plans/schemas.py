"""Schemas of the published tables and their load order."""

from __future__ import annotations

from starlot.operators.columns import layout

# Fact layouts.
FACT_LEADS = layout(
    "id bigint, id_vendedor bigint, id_loja bigint, id_canal int, id_estagio int, id_data int, "
    "id_data_ultima_integracao int, convertido_flag int, perdido_flag int, motivo string, "
    "link_post string, id_sdr bigint"
)
FACT_SALES = layout(
    "id_venda bigint, id_veiculo bigint, id_vendedor bigint, id_loja bigint, id_canal int, id_data int, "
    "ano_mes int, placa string, modelo string, cliente string, valor_venda double, valor_compra double, "
    "custos double, situacao string, data_compra timestamp_ntz, desconto double, comissao double, "
    "impostos double, lucro double, retorno double, valor_financiado double, tipo_retorno bigint, "
    "financeira string"
)
FACT_APPOINTMENTS = layout(
    "id bigint, id_vendedor bigint, id_loja bigint, id_canal int, id_data_agendamento int, "
    "id_data_visita int, flag_agendamento int, flag_visita int, campanha string, status string, "
    "motivo string, id_venda bigint"
)

# The published tables, dimensions first.
TABLES = [
    "dim_canal",
    "dim_data",
    "dim_vendedores",
    "dim_lojas",
    "dim_veiculos",
    "dim_estagio",
    "dim_vendedor_periodo",
    "fato_leads",
    "fato_vendas",
    "fato_agendamentos",
    "fato_meta_vendedor",
    "fato_meta_loja",
    "fato_custos_canal",
]
