"""Registered queries: every operator over whole given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchmarks import roles
from benchmarks.oracle import TABLES
from benchmarks.roles import table
from starlot.functions import scalars as S
from starlot.functions.text import normalise_text
from starlot.operators.calendar import date_spine, with_calendar
from starlot.operators.columns import keep_present
from starlot.operators.dedup import keep_first, keep_latest
from starlot.operators.keys import surrogate_keys
from starlot.operators.lookup import Side, apply_code_map, as_side, left_lookup, lookup_key, unknown_member
from starlot.operators.overlay import fill_by_priority, overlay
from starlot.operators.reshape import months_to_rows
from starlot.operators.temporal import months_of_periods, period_side, value_at
from starlot.plans import dims, facts, kpis, quality
from starlot.plans.refresh import ELECT, Tables, buckets_of_sales, full_refresh, prepare, publish
from starlot.plans.schemas import TABLES as GOLD
from starlot.session import releasing_shuffles, shared_folder
from starlot.sources import feeds
from starlot.sources.contracts import LANDING_STEMS
from starlot.sources.scan import read_file, read_landing, read_yearly

MONEY = "decimal(18,2)"


def money(column: str):
    return F.sum(F.col(column).cast(MONEY)).cast("double")


# --- operators ---------------------------------------------------------------


def store_at_event(spark, d, small: bool | None = None) -> DataFrame:
    """Revenue per store, the store being the supplier's at shipping time."""
    history = period_side(roles.history(spark, d), "id_vendedor", "id_loja", small=small)
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice")
    placed = value_at(lines, history, "l_suppkey", "l_shipdate", "id_loja")
    return placed.groupBy("id_loja").agg(
        F.count(F.lit(1)).alias("lines"), money("l_extendedprice").alias("revenue"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
    )


def store_at_event_by_nodes(spark, d) -> DataFrame:
    """The same in the form for histories of any size."""
    return store_at_event(spark, d, small=False)


def store_at_event_by_date(spark, d) -> DataFrame:
    """Both readings of a period's last day, per event."""
    history, events = roles.history(spark, d), table(spark, d, "events")
    exact = value_at(
        events.select("event_id", "user_id", "ts"), period_side(history, "id_vendedor", "id_loja"),
        "user_id", "ts", "store_exact",
    )
    whole = period_side(history, "id_vendedor", "id_loja", by_date=True)
    return value_at(exact, whole, "user_id", "ts", "store_by_date", by_date=True).select(
        "event_id", "store_exact", "store_by_date"
    )


def normalise_documents(spark, d) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", normalise_text(F.col("text")).alias("clean"))


def map_codes(spark, d) -> DataFrame:
    channels = feeds.channel_map(roles.channel_map(spark))
    orders = table(spark, d, "orders").select("o_orderkey", roles.order_channel().alias("canal"))
    return apply_code_map(orders, "canal", channels)


def map_conflicts(spark, d) -> DataFrame:
    """Contradictions of the code maps, the seller map being one that sends each nation to all its suppliers."""
    by_nation = table(spark, d, "supplier").select(
        F.concat(F.lit(" Nação "), F.col("s_nationkey").cast("string")).alias("nome_origem"), F.col("s_name").alias("nome_padrao")
    )
    return feeds.conflicts({**roles.all_feeds(spark, d), "seller_map": by_nation})


def seller_lookup(spark, d) -> DataFrame:
    """Messy seller names to ids; unknown sellers fall on the appended member."""
    sellers = dims.seller_dim(feeds.conform_users(roles.users(spark, d)))
    names = as_side(sellers.select("nome", "id_vendedor").filter("nome <> ''"))
    lines = roles.sales(spark, d).select("nome_vendedor", "valor_venda")
    coded = apply_code_map(lines, "nome_vendedor", feeds.seller_map(roles.seller_map(spark, d)))
    known = lookup_key(coded, names, {"nome_vendedor": "nome"}, "id_vendedor", "id_vendedor")
    return known.groupBy("id_vendedor").agg(F.count(F.lit(1)).alias("lines"), money("valor_venda").alias("total"))


def stage_lookup(spark, d) -> DataFrame:
    leads = roles.leads(spark, d).select("id", "estagio")
    stages = surrogate_keys(leads, "estagio", "id_estagio", ["id"])
    return left_lookup(leads, stages, {"estagio": "estagio"}, {"id_estagio": "id_estagio"}, null_safe=True).select(
        "id", "id_estagio"
    )


def corrections_overlay(spark, d) -> DataFrame:
    """Pending orders are replaced by corrected ones."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    corrected = orders.filter("o_orderstatus = 'P'").select(
        "o_orderkey", F.lit("C").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice")
    )
    return overlay(orders, corrected, "o_orderkey")


def keep_first_event(spark, d) -> DataFrame:
    events = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return keep_first(events, ["user_id", "event_type"], ["ts", "event_id"])


def keep_latest_event(spark, d) -> DataFrame:
    """Latest dated event per user; purchases are undated here and so come last."""
    events = table(spark, d, "events").select(
        "user_id", F.when(F.col("event_type") != "purchase", F.col("ts")).alias("seen"), "event_id", "value"
    )
    return keep_latest(events, ["user_id"], ["seen", "event_id"])


def brand_fill(spark, d) -> DataFrame:
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("codigo"), "p_type")
    return fill_by_priority(
        parts, "codigo", "marca",
        [
            (feeds.stock_brands(roles.stock_brands(spark, d)), "codigo", "marca"),
            (feeds.sale_brands(roles.sale_brands(spark, d)), "codigo", "marca"),
        ],
        feeds.UNKNOWN_BRAND,
    )


def unpivot_costs(spark, d) -> DataFrame:
    return months_to_rows(roles.channel_costs(spark, d), "Canal", "custo")


def expand_months(spark, d) -> DataFrame:
    return months_of_periods(roles.history(spark, d), "id_vendedor", "id_loja")


def calendar_orders(spark, d) -> DataFrame:
    """Orders by calendar day, for every day between the first and the last order."""
    orders = table(spark, d, "orders").select("o_orderdate", "o_totalprice")
    ends = orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    days = with_calendar(date_spine(spark, str(ends["a"].date()), str(ends["b"].date())))
    daily = orders.groupBy(S.date_key(F.col("o_orderdate")).alias("id_data")).agg(
        F.count(F.lit(1)).alias("orders"), money("o_totalprice").alias("total")
    )
    return left_lookup(days, daily, {"id_data": "id_data"}, {"orders": "orders", "total": "total"})


def channel_keys(spark, d) -> DataFrame:
    """One key per event type and order priority, by first appearance."""
    events = table(spark, d, "events").select(
        F.col("event_type").alias("canal"), F.lit(0).alias("source"), F.col("event_id").alias("place")
    )
    orders = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("canal"), F.lit(1).alias("source"), F.col("o_orderkey").alias("place")
    )
    return surrogate_keys(events.unionByName(orders), "canal", "id_canal", ["source", "place"])


def customer_keys(spark, d) -> DataFrame:
    """A key space that grows with the data: customers by their first order."""
    orders = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return surrogate_keys(orders, "o_custkey", "id_cliente", ["o_orderdate", "o_orderkey"])


def flags_and_date_keys(spark, d) -> DataFrame:
    at = F.col("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey",
        S.equals_flag(F.col("o_orderstatus"), "f").alias("convertido_flag"),
        S.equals_flag(F.concat("o_orderstatus", F.lit(" ")), "p").alias("perdido_flag"),
        S.date_key(at).alias("id_data"), S.month_key(at).alias("ano_mes"),
        S.month_of_date_key(S.date_key(at)).alias("ano_mes_da_chave"),
        S.month_start(S.month_key(at)).alias("data_meta"),
        F.quarter(at).alias("trimestre"), S.half_year(at).alias("semestre"),
    )


def lenient_casts(spark, d) -> DataFrame:
    """Numbers and dates from texts, some of which are neither."""
    number = F.get_json_object("props", "$.k")
    mixed = F.when(F.col("event_type") == "error", F.concat(number, F.lit("x"))).otherwise(number)
    day = F.date_format("ts", "dd/MM/yyyy")
    text_day = F.when(F.col("event_type") == "view", F.lit("31/02/2024")).otherwise(day)
    return table(spark, d, "events").select(
        "event_id", S.lenient_number(mixed, "bigint").alias("k"), S.lenient_number(mixed).alias("k_double"),
        S.date_key(S.lenient_timestamp(text_day, "dd/MM/yyyy")).alias("id_data"),
    )


def unknown_store(spark, d) -> DataFrame:
    """Nations as stores plus the unknown member, with their suppliers counted."""
    nations = table(spark, d, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("id_loja"), F.col("n_name").alias("loja"), "n_regionkey"
    )
    stores = unknown_member(nations, id_loja=-1, loja="desconhecida")
    counts = table(spark, d, "supplier").groupBy(F.col("s_nationkey").cast("bigint").alias("n")).agg(
        F.count(F.lit(1)).alias("suppliers")
    )
    return left_lookup(stores, counts, {"id_loja": "n"}, {"suppliers": "suppliers"})


def tolerant_projection(spark, d) -> DataFrame:
    wanted = ["c_custkey", "c_name", "c_telefone", "c_acctbal"]
    return keep_present(table(spark, d, "customer"), wanted)


def yearly_files(spark, d) -> DataFrame:
    """Orders written as one file set per year with differing headers, read back as one table."""
    folder = shared_folder(spark, "yearly")
    orders = table(spark, d, "orders")
    year = F.year("o_orderdate")
    ends = orders.agg(F.min(year).alias("a"), F.max(year).alias("b")).first()
    for y in range(ends["a"], ends["b"] + 1):
        one = orders.filter(year == y).select(
            F.col("o_orderkey").alias("Código"), F.col("o_orderdate").alias("Dt. Venda"),
            F.col("o_totalprice").alias(" Venda " if y == ends["a"] else "VENDA"),
        )
        if y == ends["b"]:
            one = one.withColumn("Situação", F.lit("nova"))
        one.write.parquet(f"{folder}/Vendas_{y}.parquet")
    read = read_yearly(
        spark, f"{folder}/Vendas_*.parquet", "sales", required=["id_venda", "data_venda", "valor_venda"]
    )
    return read.select("id_venda", "data_venda", "valor_venda", "situacao")


def csv_source(spark, d) -> DataFrame:
    """Customers through a CSV landing file with a declared schema."""
    path = shared_folder(spark, "csv")
    table(spark, d, "customer").write.option("header", "true").csv(path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return read_file(spark, path, "csv", schema)


# --- the star ----------------------------------------------------------------


def refreshed(spark, d) -> tuple[Tables, Tables]:
    """Silver and gold tables of the given feeds; a query writes only what it asks for."""
    return prepare(spark, roles.all_feeds(spark, d), shared_folder(spark, "refresh"))


def silver(spark, d, name: str) -> DataFrame:
    df = refreshed(spark, d)[0][name]
    return df.drop(*feeds.arrival(df), facts.SALE_KEY, facts.PLATE)


def gold(name: str):
    def query(spark, d) -> DataFrame:
        return refreshed(spark, d)[1][name]

    query.__name__ = name
    return query


def fato_vendas_bucketed(spark, d) -> DataFrame:
    """The sales fact from sales and details that lie in the same buckets: as for sales beyond any broadcast."""
    raw = roles.all_feeds(spark, d)
    silver, star = prepare(spark, raw, shared_folder(spark, "refresh"), sale_buckets=buckets_of_sales(raw, least=8))
    sellers = facts.seller_sides(star["dim_vendedores"], silver["hist_vendedor_loja"], feeds.seller_map(roles.seller_map(spark, d)))
    return facts.sales_fact(silver["vendas"], Side(star["_vendas"], False), sellers)


def feed_leads(spark, d):
    return silver(spark, d, "leads")


def feed_sales(spark, d):
    return silver(spark, d, "vendas")


def feed_appointments(spark, d):
    return silver(spark, d, "agendamentos")


def feed_users(spark, d):
    return silver(spark, d, "usuarios")


def feed_channel_costs(spark, d):
    return feeds.conform_channel_costs(roles.channel_costs(spark, d), feeds.channel_map(roles.channel_map(spark)))


def feed_sale_channels(spark, d):
    return silver(spark, d, "canais")


def feed_commissions(spark, d):
    return silver(spark, d, "comissoes")


def feed_financing(spark, d):
    return silver(spark, d, "retorno")


def feed_vehicles(spark, d):
    return silver(spark, d, "veiculos")


def _kpi_sides(spark, d) -> tuple[DataFrame, DataFrame]:
    """Costs with mapped channels, and the orders as leads, both on the refresh's channels."""
    channels = as_side(refreshed(spark, d)[1]["dim_canal"], stored=True)
    leads = feeds.conform_leads(roles.order_leads(spark, d), feeds.channel_map(roles.channel_map(spark)))
    return facts.channel_costs_fact(feed_channel_costs(spark, d), channels), facts.with_channel(leads, channels)


def cost_per_lead(spark, d):
    return kpis.cost_per_lead(*_kpi_sides(spark, d))


def cost_per_sale(spark, d):
    return kpis.cost_per_sale(*_kpi_sides(spark, d))


def total_cost(spark, d):
    return kpis.total_cost(_kpi_sides(spark, d)[0])


# --- quality and publish -----------------------------------------------------


def quality_report(spark, d):
    """All checks on the star of the given tables, observed while these are written; the calendar spans the orders."""
    conformed, star = refreshed(spark, d)
    orders = table(spark, d, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    span = str(orders["a"].date()), str(orders["b"].date())
    star.fetch("fato_vendas", "dim_veiculos", "fato_custos_canal")
    calendar = quality.quality_report({"dim_data": dims.calendar_dim(spark, *span)}, calendar_range=span)
    return quality.observed_report(spark, star.saved, conformed.counts["vendas"]).unionByName(calendar)


def match_rates(spark, d):
    star = refreshed(spark, d)[1]
    star.fetch(*quality.RATED)
    return quality.observed_rates(spark, star.saved)


def unmatched_channels(spark, d):
    conformed, star = refreshed(spark, d)
    return facts.unmatched_channels(conformed["custos_canal"], star["dim_canal"])


def row_counts(spark, d):
    return quality.row_counts({name: table(spark, d, name) for name in TABLES})


def publish_reconcile(spark, d):
    """Facts of a run, rows and content compared with what was seen when they were written, then published as views."""
    folder, run = shared_folder(spark, "refresh"), uuid.uuid4().hex
    star = prepare(spark, roles.all_feeds(spark, d), folder, run=run)[1]
    published = ("fato_vendas", "fato_agendamentos")
    star.fetch(*published)
    return publish(spark, f"gold_{run}", f"{folder}/gold", run, {name: star.saved[name] for name in published})


def full_star(spark, d):
    """The whole refresh over all feeds; rows of each of the thirteen tables."""
    run = full_refresh(spark, roles.all_feeds(spark, d), shared_folder(spark, "star"))
    return quality.row_counts(run.tables)


def csv_landing(spark, d):
    """Leads of a refresh whose exports are CSV files, gzipped, with dates as dd/MM/yyyy text, rows in file order; nobody names the format."""
    folder, form = shared_folder(spark, "landing"), "dd/MM/yyyy HH:mm:ss.SSSSSS"
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    exact = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    for source, df in roles.all_feeds(spark, d).items():
        order = feeds.arrival(df)
        stem = LANDING_STEMS[source].replace("[0-9]*", "2024").replace("*", "2024")
        rows = (df.orderBy(*order) if order else df).drop(*order)
        with releasing_shuffles(spark):
            rows.write.options(header="true", timestampNTZFormat=form, **exact, **packed).csv(f"{folder}/{stem}.csv")
    raw = read_landing(spark, folder, "csv", **exact)
    return prepare(spark, raw, shared_folder(spark, "refresh"), formats=ELECT)[1]["fato_leads"]


QUERIES = {
    f.__name__: f
    for f in (
        store_at_event, store_at_event_by_nodes, store_at_event_by_date, normalise_documents, map_codes, map_conflicts, seller_lookup, stage_lookup,
        corrections_overlay, keep_first_event, keep_latest_event, brand_fill, unpivot_costs, expand_months,
        calendar_orders, channel_keys, customer_keys, flags_and_date_keys, lenient_casts, unknown_store,
        tolerant_projection, yearly_files, csv_source, feed_leads, feed_sales, feed_appointments, feed_users,
        feed_channel_costs, feed_sale_channels, feed_commissions, feed_financing, feed_vehicles,
        *[gold(name) for name in GOLD if name != "dim_data"], fato_vendas_bucketed, cost_per_lead, cost_per_sale, total_cost, quality_report, match_rates,
        unmatched_channels, row_counts, publish_reconcile, csv_landing, full_star,
    )
}
