"""The registered queries as SQL for an independent engine.

``CTE`` holds the roles of ``roles.py`` and the conformed tables; ``_with`` adds
those a query needs, in order of dependence.
"""

from __future__ import annotations

import re

from benchmarks.roles import CHANNEL_MAP, FINANCIER_MAP, PLACES


def clean(text: str) -> str:
    """The text normalisation rule over an SQL expression."""
    return (
        f"trim(regexp_replace(regexp_replace(strip_accents(lower(trim(coalesce({text}, '')))), "
        "'[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g'))"
    )


def date_key(at: str) -> str:
    return f"CAST(year({at}) * 10000 + month({at}) * 100 + day({at}) AS INTEGER)"


def month_key(at: str) -> str:
    return f"CAST(year({at}) * 100 + month({at}) AS INTEGER)"


def money(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def rows(values: list[tuple[str, str]]) -> str:
    return ", ".join("(" + ", ".join("'" + v + "'" for v in pair) + ")" for pair in values)


def supplier_name(key: str) -> str:
    return f"'  SUPPLIER#' || lpad(CAST({key} AS VARCHAR), 9, '0') || ' '"


def periods_at(events: str, key: str, at: str, whole_days: bool = False) -> str:
    """Distinct (key, at) of ``events`` with the covering period of latest start."""
    moment = f"date_trunc('day', {at})" if whole_days else at
    since, until = ("date_trunc('day', data_inicio)", "date_trunc('day', fim)") if whole_days else ("data_inicio", "fim")
    return f"""SELECT k, t, id_loja FROM (
        SELECT e.k, e.t, h.id_loja,
               row_number() OVER (PARTITION BY e.k, e.t ORDER BY h.s DESC, h.u DESC, h.id_loja DESC) AS rn
        FROM (SELECT DISTINCT {key} AS k, {moment} AS t FROM {events}) e
        JOIN (SELECT id_vendedor, id_loja, {since} AS s, {until} AS u
              FROM (SELECT *, coalesce(data_fim, TIMESTAMP '2099-12-31') AS fim FROM history)) h
          ON h.id_vendedor = e.k AND e.t >= h.s AND e.t <= h.u) WHERE rn = 1"""


def seller_and_store(source: str, name: str, at: str) -> str:
    """Rows of ``source`` with ``id_vendedor`` and ``id_loja``."""
    return f"""SELECT w.* EXCLUDE (nome_limpo, nome_codigo), coalesce(p.id_loja, -1) AS id_loja
    FROM (
        SELECT c.*, coalesce(d.id_vendedor, -1) AS id_vendedor
        FROM (SELECT s.*, coalesce(m.padrao, s.nome_limpo) AS nome_codigo
              FROM (SELECT *, {clean(name)} AS nome_limpo FROM {source}) s
              LEFT JOIN seller_codes m ON m.origem = s.nome_limpo) c
        LEFT JOIN (SELECT nome, min(id_vendedor) AS id_vendedor FROM sellers WHERE nome <> '' GROUP BY nome) d
          ON d.nome = c.nome_codigo
    ) w LEFT JOIN {source}_places p ON p.k = w.id_vendedor AND p.t = w.{at}"""


def seller_places(source: str, name: str, at: str) -> str:
    """Stores of all (seller, time) pairs in ``source``; sellers are found by name first."""
    return periods_at(
        f"""(SELECT d.id_vendedor AS who, s.{at} AS moment FROM (SELECT *, {clean(name)} AS nome_limpo FROM {source}) s
             LEFT JOIN seller_codes m ON m.origem = s.nome_limpo
             JOIN sellers d ON d.nome = coalesce(m.padrao, s.nome_limpo) AND d.nome <> '')""",
        "who", "moment",
    )


_HISTORY_SPANS = [
    (0, "1995-01-01", "1997-06-30"), (100, "1996-03-01", "1996-04-15"), (25, "1997-04-01", "1999-12-31"),
    (50, "2000-07-01", "2024-01-05"), (75, "2024-01-03", None),
]


def _history() -> str:
    def moment(day: str | None) -> str:
        if day is None:
            return "CAST(NULL AS TIMESTAMP)"
        return f"CAST(DATE '{day}' + CAST(s_nationkey AS INTEGER) AS TIMESTAMP)"

    parts = [
        f"SELECT CASE WHEN s_acctbal < 9000 THEN s_suppkey ELSE -10 - s_suppkey END AS id_vendedor, "
        f"{9 - i} AS place, CAST(s_nationkey + {shift} AS BIGINT) AS id_loja, "
        f"'Loja ' || CAST(s_nationkey + {shift} AS VARCHAR) AS loja, "
        f"{moment(a)} AS data_inicio, {moment(b)} AS data_fim FROM supplier"
        for i, (shift, a, b) in enumerate(_HISTORY_SPANS)
    ]
    return " UNION ALL ".join(parts)


_ORDER_CHANNEL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Click' WHEN '2-HIGH' THEN 'VIEW'
    WHEN '3-MEDIUM' THEN ' Promo ' WHEN '4-NOT SPECIFIED' THEN 'Econômico' WHEN '5-LOW' THEN 'TV  aberta' END"""


def mapped(channel: str) -> str:
    """A channel text normalised and passed through the code map, as a scalar subquery."""
    return f"coalesce((SELECT padrao FROM channel_codes WHERE origem = {clean(channel)}), {clean(channel)})"


_LINE_FILE, _LINE_ROW = "strftime(l_shipdate, '%Y')", "(l_orderkey * 10 + l_linenumber)"

CTE = {
    "channel_codes": f"""SELECT {clean('o')} AS origem, min({clean('p')}) AS padrao
        FROM (VALUES {rows(CHANNEL_MAP)}) v(o, p) GROUP BY 1""",
    "financier_codes": f"""SELECT {clean('o')} AS origem, min({clean('p')}) AS padrao
        FROM (VALUES {rows(FINANCIER_MAP)}) v(o, p) GROUP BY 1""",
    "seller_codes": f"""SELECT {clean("'Vendedor ' || CAST(s_suppkey AS VARCHAR)")} AS origem,
        min({clean('s_name')}) AS padrao FROM supplier GROUP BY 1""",
    "history": _history(),
    "sellers": f"""SELECT s_suppkey AS id_vendedor, CASE WHEN s_acctbal >= 0 THEN {clean('s_name')} ELSE '' END AS nome FROM supplier
        UNION ALL SELECT -1, 'desconhecido'""",
    "sales": f"""SELECT l_partkey AS id_venda, l_shipdate AS data_venda,
        CASE WHEN l_linestatus = 'F' THEN 'Vendedor ' || CAST(l_suppkey AS VARCHAR)
             ELSE {supplier_name('l_suppkey')} END AS nome_vendedor,
        l_extendedprice AS valor_venda, l_extendedprice * (1 - l_discount) AS valor_compra, l_tax AS custos,
        l_discount AS desconto, 'PLT-' || CAST(l_partkey AS VARCHAR) AS placa,
        'M ' || CAST(l_linenumber AS VARCHAR) AS modelo, CAST(l_orderkey AS VARCHAR) AS cliente,
        l_returnflag AS situacao, l_shipdate - INTERVAL 30 DAY AS data_compra,
        {date_key('l_shipdate')} AS id_data, {month_key('l_shipdate')} AS ano_mes FROM lineitem""",
    "sale_channels": f"SELECT p_partkey AS codigo, {mapped('p_type')} AS canal FROM part WHERE p_size > 5",
    "leads": f"""SELECT event_id AS id, CAST(user_id AS VARCHAR) AS cliente,
        CASE WHEN value > 40 THEN 'correcao' ELSE {mapped("' ' || upper(event_type)")} END AS canal,
        {supplier_name('user_id')} AS atendente,
        CASE event_type WHEN 'purchase' THEN 'Ganho' WHEN 'error' THEN 'PERDIDO' WHEN 'click' THEN 'ganho '
             ELSE 'Aberto' END AS conversao,
        props AS motivo, ts AS data_criacao, ts + INTERVAL 2 DAY AS ultima_integracao,
        CASE WHEN event_type <> 'signup' THEN 'Etapa ' || event_type END AS estagio,
        CAST(event_type = 'purchase' AS INTEGER) AS convertido_flag,
        CAST(event_type = 'error' AS INTEGER) AS perdido_flag,
        {date_key('ts')} AS id_data, {date_key('ts + INTERVAL 2 DAY')} AS id_data_ultima_integracao,
        CASE WHEN value > 40 THEN {2 * PLACES} ELSE {PLACES} END - event_id AS place FROM events""",
    "appointments": f"""SELECT CASE WHEN event_type IN ('purchase', 'signup') THEN event_id END AS id, p AS place,
        CASE WHEN p = 0 THEN 'vendedor ' || CAST(user_id AS VARCHAR) ELSE 'ninguem' END AS responsavel_agendamento,
        {mapped('event_type')} AS canal, ts AS criacao_agendamento, ts + INTERVAL 3 DAY AS agendado_para,
        {date_key('ts')} AS id_data_agendamento, {date_key('ts + INTERVAL 3 DAY')} AS id_data_visita,
        CAST(value > 10 AS INTEGER) AS flag_agendamento, CAST(value > 20 AS INTEGER) AS flag_visita,
        props AS status FROM events, (VALUES (0), (1)) v(p)""",
    "stock_brands": "SELECT p_partkey AS codigo, p_brand AS marca FROM part WHERE p_size <= 25",
    "sale_brands": f"""SELECT codigo, marca FROM (
        SELECT l_partkey AS codigo, 'Marca ' || l_returnflag AS marca,
               row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, {_LINE_FILE} DESC,
                                  {_LINE_ROW} DESC, l_returnflag DESC) AS rn
        FROM lineitem WHERE l_quantity >= 49) WHERE rn = 1""",
    "vehicles": """SELECT p_partkey AS codigo, p_name AS modelo, p_size + 2000 AS ano,
        upper(p_type[1]) || lower(p_type[2:]) AS cor, p_type AS tipo,
        'PLT-' || CAST(p_partkey AS VARCHAR) AS placa,
        CASE WHEN p_size > 45 THEN 'Devolvido' ELSE 'Estoque' END AS situacao,
        p_partkey AS id_veiculo, coalesce(b.marca, s.marca, 'desconhecida') AS marca
        FROM part LEFT JOIN stock_brands b ON b.codigo = p_partkey
        LEFT JOIN sale_brands s ON s.codigo = p_partkey""",
    "commissions": f"""SELECT id_venda, comissao, impostos, lucro, retorno FROM (
        SELECT l_partkey AS id_venda, CASE WHEN l_linestatus = 'F' THEN l_quantity END AS comissao,
               l_tax AS impostos, l_discount AS lucro, CAST(l_linenumber AS DOUBLE) AS retorno,
               row_number() OVER (PARTITION BY l_partkey ORDER BY {_LINE_FILE}, {_LINE_ROW},
                   CASE WHEN l_linestatus = 'F' THEN l_quantity END NULLS FIRST,
                   l_tax, l_discount, l_linenumber) AS rn
        FROM lineitem WHERE l_returnflag = 'R') WHERE rn = 1""",
    "financing": f"""SELECT placa, id_data, valor_financiado, tipo_retorno,
               coalesce((SELECT padrao FROM financier_codes WHERE origem = lower(l_linestatus)), lower(l_linestatus))
               AS financeira FROM (
        SELECT 'plt' || CAST(l_partkey AS VARCHAR) AS placa, {date_key('l_shipdate')} AS id_data,
               l_extendedprice AS valor_financiado, CAST(l_linenumber AS BIGINT) AS tipo_retorno, l_linestatus,
               row_number() OVER (PARTITION BY l_partkey, {date_key('l_shipdate')} ORDER BY {_LINE_FILE},
                   {_LINE_ROW}, l_extendedprice, l_linenumber, l_linestatus) AS rn
        FROM lineitem WHERE l_returnflag = 'A') WHERE rn = 1""",
    "costs_wide": f"""SELECT {_ORDER_CHANNEL} AS canal_bruto,
        {date_key("date_trunc('month', o_orderdate)")} AS id_data, {money('o_totalprice')} AS custo
        FROM orders GROUP BY 1, 2""",
    "costs": f"SELECT {clean('canal_bruto')} AS canal, id_data, custo FROM costs_wide",
    "mapped_costs": f"SELECT {mapped('canal_bruto')} AS canal, id_data, custo FROM costs_wide",
    "dim_canal": """SELECT canal, CAST(row_number() OVER (ORDER BY min(source), min(place)
            FILTER (WHERE source = first_source), canal) AS INTEGER) AS id_canal
        FROM (SELECT *, min(source) OVER (PARTITION BY canal) AS first_source FROM (
            SELECT canal, 0 AS source, place FROM leads
            UNION ALL SELECT canal, 1, -codigo FROM sale_channels))
        GROUP BY canal""",
    "dim_estagio": """SELECT estagio, CAST(row_number() OVER (ORDER BY min(place)) AS INTEGER) AS id_estagio
        FROM leads GROUP BY estagio""",
    "month_rows": """SELECT id_vendedor, id_loja, ano_mes,
               row_number() OVER (PARTITION BY id_vendedor, ano_mes ORDER BY data_inicio, id_loja) AS by_start,
               row_number() OVER (PARTITION BY id_vendedor, ano_mes ORDER BY place) AS by_place
        FROM (SELECT id_vendedor, id_loja, data_inicio, place, CAST(year(m) * 100 + month(m) AS INTEGER) AS ano_mes
              FROM (SELECT *, unnest(generate_series(date_trunc('month', data_inicio),
                    date_trunc('month', coalesce(data_fim, TIMESTAMP '2099-12-31')), INTERVAL 1 MONTH)) AS m
                    FROM history))""",
    "seller_months": """SELECT id_vendedor, id_loja, ano_mes FROM month_rows WHERE by_start = 1""",
    "seller_periods": """SELECT id_vendedor, id_loja, ano_mes FROM month_rows WHERE by_place = 1""",
    "sales_places": seller_places("sales", "nome_vendedor", "data_venda"),
    "leads_places": seller_places("leads", "atendente", "data_criacao"),
    "appointments_places": seller_places("appointments", "responsavel_agendamento", "criacao_agendamento"),
    "fato_agendamentos": f"""SELECT f.id, f.id_vendedor, f.id_loja, coalesce(c.id_canal, -1) AS id_canal,
        id_data_agendamento, id_data_visita, flag_agendamento, flag_visita, CAST(NULL AS VARCHAR) AS campanha,
        status, CAST(NULL AS VARCHAR) AS motivo, CAST(NULL AS BIGINT) AS id_venda
        FROM ({seller_and_store('appointments', 'responsavel_agendamento', 'criacao_agendamento')}) f
        LEFT JOIN dim_canal c ON c.canal = f.canal""",
    "fato_leads": f"""SELECT f.id, f.id_vendedor, f.id_loja, coalesce(c.id_canal, -1) AS id_canal,
        e.id_estagio, f.id_data, f.id_data_ultima_integracao, f.convertido_flag, f.perdido_flag, f.motivo,
        CASE WHEN v.event_type = 'view' THEN 'post/' || CAST(f.id AS VARCHAR) END AS link_post,
        a.id_vendedor AS id_sdr
        FROM ({seller_and_store('leads', 'atendente', 'data_criacao')}) f
        LEFT JOIN dim_canal c ON c.canal = f.canal
        LEFT JOIN dim_estagio e ON e.estagio IS NOT DISTINCT FROM f.estagio
        LEFT JOIN (SELECT event_id AS id, coalesce(d.id_vendedor, -1) AS id_vendedor FROM events
                   LEFT JOIN seller_codes m ON m.origem = {clean("'vendedor ' || CAST(user_id AS VARCHAR)")}
                   LEFT JOIN (SELECT nome, min(id_vendedor) AS id_vendedor FROM sellers WHERE nome <> '' GROUP BY nome) d
                     ON d.nome = coalesce(m.padrao, {clean("'vendedor ' || CAST(user_id AS VARCHAR)")})
                   WHERE event_type IN ('purchase', 'signup')) a ON a.id = f.id
        LEFT JOIN events v ON v.event_id = f.id""",
    "fato_vendas": f"""SELECT f.id_venda, p.p_partkey AS id_veiculo, f.id_vendedor, f.id_loja,
        coalesce(c.id_canal, -1) AS id_canal, f.id_data, f.ano_mes, f.placa, f.modelo, f.cliente, f.valor_venda,
        f.valor_compra, f.custos, f.situacao, f.data_compra, f.desconto, m.comissao, m.impostos, m.lucro, m.retorno,
        r.valor_financiado, r.tipo_retorno, r.financeira
        FROM ({seller_and_store('sales', 'nome_vendedor', 'data_venda')}) f
        LEFT JOIN sale_channels k ON k.codigo = f.id_venda
        LEFT JOIN dim_canal c ON c.canal = coalesce(k.canal, '')
        LEFT JOIN part p ON p.p_partkey = f.id_venda
        LEFT JOIN commissions m ON m.id_venda = f.id_venda
        LEFT JOIN financing r ON r.placa = {clean('f.placa')} AND r.id_data = f.id_data""",
    "fato_custos_canal": """SELECT coalesce(c.id_canal, -1) AS id_canal, f.id_data, f.custo
        FROM costs f LEFT JOIN dim_canal c ON c.canal = f.canal""",
    "kpi_costs": """SELECT coalesce(c.id_canal, -1) AS id_canal, f.id_data // 100 AS ano_mes, f.custo
        FROM mapped_costs f LEFT JOIN dim_canal c ON c.canal = f.canal""",
    "kpi_leads": f"""SELECT coalesce(c.id_canal, -1) AS id_canal, {month_key('o_orderdate')} AS ano_mes,
        o_orderstatus = 'F' AS won
        FROM (SELECT *, {mapped(_ORDER_CHANNEL)} AS canal FROM orders) o LEFT JOIN dim_canal c ON c.canal = o.canal""",
    "dim_veiculos": f"""SELECT id_veiculo, {clean('marca')} AS marca, {clean('modelo')} AS modelo, ano,
        {clean('cor')} AS cor, {clean('tipo')} AS tipo, placa, {clean('situacao')} AS situacao FROM vehicles""",
}


def _needs(sql: str, seen: dict[str, None]) -> None:
    for name, body in CTE.items():
        if name not in seen and re.search(rf"\b{name}\b(?!\s*\()", sql):
            seen[name] = None
            _needs(body, seen)


def _with(sql: str) -> str:
    seen: dict[str, None] = {}
    _needs(sql, seen)
    used = [name for name in CTE if name in seen]
    if not used:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({CTE[name]})" for name in used) + "\n" + sql


def _kpi(counted: str, n: str, ratio: str) -> str:
    return f"""SELECT c.id_canal, c.ano_mes, CAST(c.total AS DOUBLE) AS custo, coalesce(l.n, 0) AS {n},
        CAST(c.total AS DOUBLE) / nullif(CAST(l.n AS DOUBLE), 0) AS {ratio}
        FROM (SELECT id_canal, ano_mes, sum(CAST(custo AS DECIMAL(18,2))) AS total FROM kpi_costs
              WHERE id_canal <> -1 GROUP BY 1, 2) c
        LEFT JOIN (SELECT id_canal, ano_mes, count(*) FILTER (WHERE {counted}) AS n FROM kpi_leads GROUP BY 1, 2) l
          ON l.id_canal = c.id_canal AND l.ano_mes = c.ano_mes"""


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
_MONTHS = "['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro','Novembro','Dezembro']"
_DAYS = "['Segunda','Terça','Quarta','Quinta','Sexta','Sábado','Domingo']"


def _count(name: str, source: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"


def _rate(name: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, avg(CAST(id_vendedor = -1 AS INTEGER)) AS unknown_seller, "
        f"avg(CAST(id_loja = -1 AS INTEGER)) AS unknown_store FROM {name}"
    )


_SQL = {
    "store_at_event": f"""SELECT coalesce(p.id_loja, -1) AS id_loja, count(*) AS lines,
        {money('l_extendedprice')} AS revenue, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
        FROM lineitem l LEFT JOIN ({periods_at('lineitem', 'l_suppkey', 'l_shipdate')}) p
          ON p.k = l.l_suppkey AND p.t = l.l_shipdate GROUP BY 1""",
    "store_at_event_by_date": f"""SELECT event_id, coalesce(p.id_loja, -1) AS store_exact,
        coalesce(q.id_loja, -1) AS store_by_date FROM events e
        LEFT JOIN ({periods_at('events', 'user_id', 'ts')}) p ON p.k = e.user_id AND p.t = e.ts
        LEFT JOIN ({periods_at('events', 'user_id', 'ts', True)}) q
          ON q.k = e.user_id AND q.t = date_trunc('day', e.ts)""",
    "normalise_documents": f"SELECT doc_id, {clean('text')} AS clean FROM documents",
    "map_codes": f"SELECT o_orderkey, {mapped(_ORDER_CHANNEL)} AS canal FROM orders",
    "seller_lookup": f"""SELECT coalesce(d.id_vendedor, -1) AS id_vendedor, count(*) AS lines,
        {money('valor_venda')} AS total FROM (SELECT *, {clean('nome_vendedor')} AS limpo FROM sales) s
        LEFT JOIN seller_codes m ON m.origem = s.limpo
        LEFT JOIN sellers d ON d.nome = coalesce(m.padrao, s.limpo) GROUP BY 1""",
    "stage_lookup": """SELECT l.id, CAST(e.n AS BIGINT) AS id_estagio FROM leads l
        JOIN (SELECT estagio, row_number() OVER (ORDER BY min(id)) AS n FROM leads GROUP BY estagio) e
          ON e.estagio IS NOT DISTINCT FROM l.estagio""",
    "corrections_overlay": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'C' ELSE o_orderstatus END
        AS o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
        FROM orders""",
    "keep_first_event": """SELECT user_id, event_type, ts, event_id, value FROM (SELECT *, row_number() OVER
        (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
    "keep_latest_event": """SELECT user_id, seen, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seen DESC NULLS LAST, event_id DESC) AS rn
        FROM (SELECT *, CASE WHEN event_type <> 'purchase' THEN ts END AS seen FROM events)) WHERE rn = 1""",
    "brand_fill": "SELECT p_partkey AS codigo, p_type, marca FROM part JOIN vehicles ON codigo = p_partkey",
    "unpivot_costs": 'SELECT canal_bruto AS "Canal", id_data, custo FROM costs_wide',
    "expand_months": "SELECT * FROM seller_months",
    "calendar_orders": f"""SELECT d AS data, {date_key('d')} AS id_data, CAST(year(d) AS INTEGER) AS ano,
        CAST(month(d) AS INTEGER) AS mes, {month_key('d')} AS ano_mes, {_MONTHS}[month(d)] AS nome_mes,
        strftime(d, '%Y-%m') AS ano_mes_desc, CAST(quarter(d) AS INTEGER) AS trimestre,
        CASE WHEN month(d) > 6 THEN 2 ELSE 1 END AS semestre, CAST(isodow(d) - 1 AS INTEGER) AS num_dia_semana,
        {_DAYS}[isodow(d)] AS dia_semana, CASE WHEN isodow(d) > 5 THEN 1 ELSE 0 END AS fim_de_semana,
        CAST((SELECT count(*) FROM generate_series(date_trunc('month', d), last_day(d)::TIMESTAMP, INTERVAL 1 DAY) g(x)
              WHERE isodow(x) < 6) AS INTEGER) AS dias_uteis_mes, o.orders, o.total
        FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders),
              INTERVAL 1 DAY)) AS d) days
        LEFT JOIN (SELECT o_orderdate, count(*) AS orders, {money('o_totalprice')} AS total FROM orders GROUP BY 1) o
          ON o.o_orderdate = d""",
    "channel_keys": """SELECT canal, row_number() OVER (ORDER BY source, place) AS id_canal FROM (
        SELECT event_type AS canal, 0 AS source, min(event_id) AS place FROM events GROUP BY 1
        UNION ALL SELECT o_orderpriority, 1, min(o_orderkey) FROM orders GROUP BY 1)""",
    "customer_keys": """SELECT o_custkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey)
        AS id_cliente FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
        AS rn FROM orders) WHERE rn = 1""",
    "flags_and_date_keys": f"""SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS convertido_flag,
        0 AS perdido_flag, {date_key('o_orderdate')} AS id_data, {month_key('o_orderdate')} AS ano_mes,
        {month_key('o_orderdate')} AS ano_mes_da_chave, date_trunc('month', o_orderdate) AS data_meta,
        CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
        CASE WHEN month(o_orderdate) > 6 THEN 2 ELSE 1 END AS semestre FROM orders""",
    "lenient_casts": f"""SELECT event_id, TRY_CAST(t AS BIGINT) AS k, TRY_CAST(t AS DOUBLE) AS k_double,
        CASE WHEN event_type <> 'view' THEN {date_key('ts')} END AS id_data
        FROM (SELECT *, json_extract_string(props, '$.k') || CASE WHEN event_type = 'error' THEN 'x' ELSE '' END AS t
              FROM events)""",
    "unknown_store": """SELECT s.id_loja, s.loja, s.n_regionkey, c.suppliers FROM (
        SELECT CAST(n_nationkey AS BIGINT) AS id_loja, n_name AS loja, n_regionkey FROM nation
        UNION ALL SELECT -1, 'desconhecida', NULL) s
        LEFT JOIN (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1) c ON c.s_nationkey = s.id_loja""",
    "tolerant_projection": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "yearly_files": """SELECT o_orderkey AS id_venda, o_orderdate AS data_venda, o_totalprice AS valor_venda,
        CASE WHEN year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) THEN 'nova' END AS situacao
        FROM orders""",
    "csv_source": "SELECT * FROM customer",
    "feed_leads": "SELECT * EXCLUDE (place) FROM leads",
    "feed_sales": "SELECT * FROM sales",
    "feed_appointments": "SELECT * EXCLUDE (place) FROM appointments",
    "feed_users": "SELECT id_vendedor, nome FROM sellers WHERE id_vendedor <> -1",
    "feed_channel_costs": "SELECT canal, id_data, custo FROM mapped_costs",
    "feed_sale_channels": "SELECT codigo, canal FROM sale_channels",
    "feed_commissions": "SELECT * FROM commissions",
    "feed_financing": "SELECT * FROM financing",
    "feed_vehicles": "SELECT * FROM vehicles",
    "dim_canal": "SELECT * FROM dim_canal",
    "dim_vendedores": "SELECT * FROM sellers",
    "dim_lojas": "SELECT DISTINCT id_loja, loja FROM history UNION ALL SELECT -1, 'desconhecida'",
    "dim_veiculos": "SELECT * FROM dim_veiculos",
    "dim_estagio": "SELECT * FROM dim_estagio",
    "dim_vendedor_periodo": "SELECT * FROM seller_periods",
    "fato_agendamentos": "SELECT * FROM fato_agendamentos",
    "fato_leads": "SELECT * FROM fato_leads",
    "csv_landing": "SELECT * FROM fato_leads",
    "fato_vendas": "SELECT * FROM fato_vendas",
    "fato_meta_vendedor": f"""SELECT t.id_vendedor, t.ano_mes, make_date(t.ano_mes // 100, t.ano_mes % 100, 1)::TIMESTAMP
        AS data_meta, t.ano_mes * 100 + 1 AS id_data, m.id_loja, t.meta_qtd
        FROM (SELECT l_suppkey AS id_vendedor, {month_key('l_shipdate')} AS ano_mes, count(*) AS meta_qtd
              FROM lineitem GROUP BY 1, 2) t
        LEFT JOIN seller_periods m ON m.id_vendedor = t.id_vendedor AND m.ano_mes = t.ano_mes""",
    "fato_meta_loja": f"""SELECT id_loja, ano_mes, make_date(ano_mes // 100, ano_mes % 100, 1)::TIMESTAMP AS data_meta,
        ano_mes * 100 + 1 AS id_data, meta_qtd
        FROM (SELECT CAST(s_nationkey AS BIGINT) AS id_loja, {month_key('l_shipdate')} AS ano_mes, count(*) AS meta_qtd
              FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2)""",
    "fato_custos_canal": "SELECT * FROM fato_custos_canal",
    "cost_per_lead": _kpi("true", "leads", "custo_por_lead"),
    "cost_per_sale": _kpi("won", "vendas", "custo_por_venda"),
    "total_cost": f"SELECT id_canal, {money('custo')} AS custo FROM kpi_costs GROUP BY 1",
    "quality_report": """
        SELECT 'unknown_brand' AS "check", v < 0.05 AS passed, v AS value, CAST(0.05 AS DOUBLE) AS threshold
        FROM (SELECT avg(CAST(marca = 'desconhecida' AS INTEGER)) AS v FROM dim_veiculos WHERE situacao <> 'devolvido')
        UNION ALL SELECT 'commission_coverage', v >= 0.90, v, 0.90
        FROM (SELECT avg(CAST(comissao IS NOT NULL AS INTEGER)) AS v FROM fato_vendas)
        UNION ALL SELECT 'sales_rows_kept', a = b, CAST(a - b AS DOUBLE), 0
        FROM (SELECT (SELECT count(*) FROM fato_vendas) AS a, (SELECT count(*) FROM lineitem) AS b)
        UNION ALL SELECT 'calendar_range', true, 0, 0 UNION ALL SELECT 'calendar_nulls', true, 0, 0
        UNION ALL SELECT 'costs_without_channel', n = 0, CAST(n AS DOUBLE), 0
        FROM (SELECT count(*) FILTER (WHERE id_canal = -1) AS n FROM fato_custos_canal)""",
    "match_rates": " UNION ALL ".join(_rate(n) for n in ("fato_leads", "fato_vendas", "fato_agendamentos")),
    "unmatched_channels": """SELECT DISTINCT canal FROM costs
        WHERE canal NOT IN (SELECT canal FROM dim_canal)""",
    "row_counts": " UNION ALL ".join(_count(n, n) for n in TABLES),
    "publish_reconcile": """SELECT 'fato_vendas' AS table_name, count(*) AS expected_rows, count(*) AS saved_rows,
        true AS same_content, true AS matches FROM lineitem
        UNION ALL SELECT 'fato_agendamentos', count(*), count(*), true, true FROM appointments""",
    "full_star": " UNION ALL ".join(
        [
            _count("dim_canal", "dim_canal"),
            _count("dim_data", "generate_series(DATE '2022-01-01', DATE '2027-12-31', INTERVAL 1 DAY)"),
            _count("dim_vendedores", "sellers"),
            _count("dim_lojas", "(SELECT DISTINCT id_loja, loja FROM history UNION ALL SELECT -1, '')"),
            _count("dim_veiculos", "vehicles"),
            _count("dim_estagio", "dim_estagio"),
            _count("dim_vendedor_periodo", "seller_periods"),
            _count("fato_leads", "events"),
            _count("fato_vendas", "lineitem"),
            _count("fato_agendamentos", "appointments"),
            _count("fato_meta_vendedor", "(SELECT DISTINCT l_suppkey, strftime(l_shipdate, '%Y%m') FROM lineitem)"),
            _count("fato_meta_loja", """(SELECT DISTINCT s_nationkey, strftime(l_shipdate, '%Y%m')
                FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)"""),
            _count("fato_custos_canal", "costs_wide"),
        ]
    ),
}


_SQL["map_conflicts"] = f"""
    SELECT map_name, origin, min(target) AS kept, CAST(count(*) AS BIGINT) AS map_rows, count(DISTINCT target) AS targets
    FROM (SELECT 'seller_map' AS map_name, {clean("' Nação ' || CAST(s_nationkey AS VARCHAR)")} AS origin, {clean('s_name')} AS target FROM supplier
          UNION ALL SELECT 'channel_map', {clean('o')}, {clean('p')} FROM (VALUES {rows(CHANNEL_MAP)}) v(o, p)
          UNION ALL SELECT 'financier_map', {clean('o')}, {clean('p')} FROM (VALUES {rows(FINANCIER_MAP)}) v(o, p))
    GROUP BY 1, 2 HAVING count(DISTINCT target) > 1"""
_SQL["store_at_event_by_nodes"] = _SQL["store_at_event"]
_SQL["fato_vendas_bucketed"] = _SQL["fato_vendas"]


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in _SQL.items()}
