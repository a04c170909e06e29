"""The given tables in the roles of the source feeds.

Every function reads whole tables and returns a frame as ``starlot.sources.scan``
delivers it: headers normalised and renamed, ``_file``/``_row`` as arrival order.
``oracle.py`` holds the same derivations in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHANNEL_MAP = [
    ("ECONOMY", "Econômico"), ("PROMO", "Promoção"), ("view", "Visualização"), ("Tv  Aberta", "TV"),
]
# Rows that stand in reverse order of their key are placed at this minus the key.
PLACES = 1_000_000_000_000
FINANCIER_MAP = [("F", "Banco Ação"), ("Ó", "Outro")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def channel_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CHANNEL_MAP, "canal_origem string, canal_padrao string")


def financier_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FINANCIER_MAP, "financeira_origem string, financeira_padrao string")


def _supplier_name(key: Column) -> Column:
    return F.concat(F.lit("  SUPPLIER#"), F.lpad(key.cast("string"), 9, "0"), F.lit(" "))


def _midnight(day: str, shift: Column) -> Column:
    return F.date_add(F.lit(day).cast("date"), shift).cast("timestamp_ntz")


def users(spark, d) -> DataFrame:
    """Suppliers in debt have no name here, so their sales fall to the unknown seller."""
    return table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id_vendedor"), F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("nome")
    )


def history(spark, d) -> DataFrame:
    """Five assignments per supplier: a nested one, overlaps, a gap and an open end; the latest stand first.

    Rich suppliers' assignments are kept under an id that no seller has.
    """
    nation = F.col("s_nationkey")
    spans = [
        (0, "1995-01-01", "1997-06-30"),
        (100, "1996-03-01", "1996-04-15"),
        (25, "1997-04-01", "1999-12-31"),
        (50, "2000-07-01", "2024-01-05"),
        (75, "2024-01-03", None),
    ]
    rows = [
        F.struct(
            (nation + offset).cast("bigint").alias("id_loja"),
            _midnight(start, nation).alias("data_inicio"),
            (_midnight(end, nation) if end else F.lit(None).cast("timestamp_ntz")).alias("data_fim"),
            (F.col("s_suppkey") * 10 + (9 - i)).alias("_row"),
        )
        for i, (offset, start, end) in enumerate(spans)
    ]
    seller = F.when(F.col("s_acctbal") < 9000, F.col("s_suppkey")).otherwise(-10 - F.col("s_suppkey"))
    unfolded = table(spark, d, "supplier").select(seller.alias("id_vendedor"), F.inline(F.array(*rows)))
    return unfolded.select(
        "id_vendedor", "id_loja", F.concat(F.lit("Loja "), F.col("id_loja").cast("string")).alias("loja"),
        "data_inicio", "data_fim", F.lit("hist").alias("_file"), "_row",
    )


def seller_map(spark, d) -> DataFrame:
    return table(spark, d, "supplier").select(
        F.concat(F.lit("Vendedor "), F.col("s_suppkey").cast("string")).alias("nome_origem"),
        F.col("s_name").alias("nome_padrao"),
    )


def sales(spark, d) -> DataFrame:
    key = F.col("l_suppkey")
    return table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("id_venda"),
        F.col("l_shipdate").alias("data_venda"),
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("Vendedor "), key.cast("string")))
        .otherwise(_supplier_name(key)).alias("nome_vendedor"),
        F.col("l_extendedprice").alias("valor_venda"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("valor_compra"),
        F.col("l_tax").alias("custos"),
        F.col("l_discount").alias("desconto"),
        F.concat(F.lit("PLT-"), F.col("l_partkey").cast("string")).alias("placa"),
        F.concat(F.lit("M "), F.col("l_linenumber").cast("string")).alias("modelo"),
        F.col("l_orderkey").cast("string").alias("cliente"),
        F.col("l_returnflag").alias("situacao"),
        (F.col("l_shipdate") - F.expr("interval 30 days")).alias("data_compra"),
    )


def sale_channels(spark, d) -> DataFrame:
    """Sale channel by code, twice per code so that the first file must win; high codes stand first.

    Small parts have no channel.
    """
    part = table(spark, d, "part")
    row = (F.lit(PLACES) - F.col("p_partkey")).alias("_row")
    old = part.select(
        F.col("p_partkey").alias("codigo"), F.when(F.col("p_size") > 5, F.col("p_type")).alias("canal"),
        F.lit("dados_canais_2022").alias("_file"), row,
    )
    new = part.select(
        F.col("p_partkey").alias("codigo"), F.when(F.col("p_size") > 5, F.col("p_brand")).alias("canal"),
        F.lit("dados_canais_2023").alias("_file"), row,
    )
    return old.unionByName(new)


def leads(spark, d) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, d, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("cliente"),
        F.concat(F.lit(" "), F.upper(kind)).alias("canal"),
        _supplier_name(F.col("user_id")).alias("atendente"),
        F.when(kind == "purchase", "Ganho").when(kind == "error", "PERDIDO").when(kind == "click", "ganho ")
        .otherwise("Aberto").alias("conversao"),
        F.col("props").alias("motivo"),
        F.col("ts").alias("data_criacao"),
        (F.col("ts") + F.expr("interval 2 days")).alias("ultima_integracao"),
        F.when(kind != "signup", F.concat(F.lit("Etapa "), kind)).alias("estagio"),
        F.lit("leads").alias("_file"), (F.lit(PLACES) - F.col("event_id")).alias("_row"),
    )


def lead_corrections(spark, d) -> DataFrame:
    """Leads of high value, moved to another channel."""
    wrong = table(spark, d, "events").filter("value > 40").select(F.col("event_id").alias("id"))
    return leads(spark, d).join(wrong, "id", "left_semi").withColumn("canal", F.lit("Correção"))


def lead_links(spark, d) -> DataFrame:
    """Two links a lead, the one to use first."""
    rows = table(spark, d, "events").filter("event_type = 'view'")
    return union_all([
        rows.select(
            F.col("event_id").alias("id"), F.concat(F.lit(start), F.col("event_id").cast("string")).alias("link_post"),
            F.lit("links").alias("_file"), (F.col("event_id") * 2 + place).alias("_row"),
        )
        for place, start in enumerate(("post/", "ad/"))
    ])


def appointments(spark, d) -> DataFrame:
    """Two appointments an event, the second by somebody unknown; only some belong to a lead."""
    return union_all([_appointments(table(spark, d, "events"), place) for place in (0, 1)])


def _appointments(rows: DataFrame, place: int) -> DataFrame:
    name = F.concat(F.lit("vendedor "), F.col("user_id").cast("string")) if place == 0 else F.lit("ninguem")
    return rows.select(
        F.when(F.col("event_type").isin("purchase", "signup"), F.col("event_id")).alias("id"),
        name.alias("responsavel_agendamento"),
        F.lit("agenda").alias("_file"), (F.col("event_id") * 2 + place).alias("_row"),
        F.col("event_type").alias("canal"),
        F.col("ts").alias("criacao_agendamento"),
        (F.col("ts") + F.expr("interval 3 days")).alias("agendado_para"),
        F.when(F.col("value") > 10, "Sim").otherwise("Não").alias("flag_agendamento"),
        F.when(F.col("value") > 20, "SIM").otherwise(F.lit(None)).alias("flag_visita"),
        F.col("props").alias("status"),
    )


def vehicles(spark, d) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("codigo"),
        F.col("p_name").alias("modelo"),
        (F.col("p_size") + 2000).alias("ano"),
        F.initcap("p_type").alias("cor"),
        F.col("p_type").alias("tipo"),
        F.concat(F.lit("PLT-"), F.col("p_partkey").cast("string")).alias("placa"),
        F.when(F.col("p_size") > 45, "Devolvido").otherwise("Estoque").alias("situacao"),
    )


def stock_brands(spark, d) -> DataFrame:
    """Two brands a code, the one to use first; large parts have none."""
    rows = table(spark, d, "part")
    return union_all([
        rows.select(
            F.concat(F.col("p_partkey").cast("string"), F.lit(".0")).alias("codigo"),
            F.when(F.col("p_size") <= 25, brand).alias("marca"),
            F.lit("estoque").alias("_file"), (F.col("p_partkey") * 2 + place).alias("_row"),
        )
        for place, brand in enumerate((F.col("p_brand"), F.lit("A marca")))
    ])


def _line_order() -> list[Column]:
    return [
        F.date_format("l_shipdate", "yyyy").alias("_file"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_row"),
    ]


def sale_brands(spark, d) -> DataFrame:
    """A brand is noted only on the largest sales."""
    return table(spark, d, "lineitem").select(
        F.col("l_partkey").cast("string").alias("codigo"),
        F.when(F.col("l_quantity") >= 49, F.concat(F.lit("Marca "), F.col("l_returnflag"))).alias("marca"),
        F.col("l_shipdate").alias("dt._venda"),
        *_line_order(),
    )


def commissions(spark, d) -> DataFrame:
    """Commission texts; codes and amounts are numbers, or look like some (``7F``, ``nan``) and are none."""
    key, flag = F.col("l_partkey").cast("string"), F.col("l_returnflag")
    code = F.when(flag == "R", F.concat(F.lit(" "), key, F.lit(".0 "))).when(flag == "A", F.concat(key, F.lit("F")))
    amount = F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("string"))
    return table(spark, d, "lineitem").select(
        code.otherwise(F.concat(key, F.lit("D"))).alias("codigo"),
        amount.when(F.col("l_linenumber") == 1, "nan").when(F.col("l_linenumber") == 2, "Infinity").otherwise("n/d").alias("comissao"),
        F.col("l_tax").alias("impostos"), F.col("l_discount").alias("lucro"),
        F.col("l_linenumber").alias("retorno"),
        *_line_order(),
    )


def financing(spark, d) -> DataFrame:
    """Lines that were not returned are financed under a plate without a letter or digit."""
    plate = F.concat(F.lit("plt-"), F.col("l_partkey").cast("string"))
    return table(spark, d, "lineitem").select(
        F.col("l_shipdate").alias("data_venda"),
        F.when(F.col("l_returnflag") == "A", plate).otherwise(" - ").alias("placa"),
        F.col("l_extendedprice").alias("valor_financiado"),
        F.col("l_linenumber").cast("string").alias("tipo_retorno"),
        F.col("l_linestatus").alias("financeira"),
        *_line_order(),
    )


def seller_targets(spark, d) -> DataFrame:
    month = F.date_format("l_shipdate", "yyyyMM").cast("int")
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("id_vendedor"), month.alias("ano_mes")).agg(
        F.count(F.lit(1)).alias("meta_qtd")
    )


def store_targets(spark, d) -> DataFrame:
    month = F.date_format("l_shipdate", "yyyyMM").cast("int")
    joined = table(spark, d, "lineitem").join(
        table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    return joined.groupBy(F.col("s_nationkey").cast("bigint").alias("id_loja"), month.alias("ano_mes")).agg(
        F.count(F.lit(1)).alias("meta_qtd")
    )


def order_channel() -> Column:
    names = {
        "1-URGENT": "Click", "2-HIGH": "VIEW", "3-MEDIUM": " Promo ", "4-NOT SPECIFIED": "Econômico",
        "5-LOW": "TV  aberta",
    }
    pairs = [F.when(F.col("o_orderpriority") == k, v) for k, v in names.items()]
    return F.coalesce(*pairs)


def channel_costs(spark, d) -> DataFrame:
    """Cost matrix: one row per channel, one column per month of the orders, headed dd/MM/yyyy."""
    orders = table(spark, d, "orders").select(
        order_channel().alias("Canal"),
        F.date_format(F.trunc("o_orderdate", "MM"), "dd/MM/yyyy").alias("month"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("cost"),
        F.col("o_orderdate").alias("at"),
    )
    ends = orders.agg(F.min("at").alias("a"), F.max("at").alias("b")).first()
    months = [
        f"01/{m % 12 + 1:02d}/{m // 12}"
        for m in range(ends["a"].year * 12 + ends["a"].month - 1, ends["b"].year * 12 + ends["b"].month)
    ]
    # Two-step pivot: sums per channel and month first, then one column per month.
    sums = orders.groupBy("Canal", "month").agg(F.sum("cost").cast("double").alias("cost"))
    return sums.groupBy("Canal").agg(*[F.max(F.when(F.col("month") == m, F.col("cost"))).alias(m) for m in months])


def order_leads(spark, d) -> DataFrame:
    """Orders as leads over many months, for the KPIs."""
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("cliente"),
        order_channel().alias("canal"), F.lit("").alias("atendente"),
        F.when(F.col("o_orderstatus") == "F", "GANHO").otherwise(F.col("o_orderstatus")).alias("conversao"),
        F.col("o_orderpriority").alias("motivo"), F.col("o_orderdate").alias("data_criacao"),
        F.col("o_orderdate").alias("ultima_integracao"),
    )


class Feeds(Mapping):
    """All feeds by name; a feed is derived when it is first asked for, as ``channel_costs`` runs a job."""

    OF_TABLES = (
        users, history, seller_map, sales, sale_channels, leads, lead_corrections, lead_links, appointments, vehicles,
        stock_brands, sale_brands, commissions, financing, seller_targets, store_targets, channel_costs,
    )

    def __init__(self, spark: SparkSession, d: str):
        self._makers = {f.__name__: partial(f, spark, d) for f in self.OF_TABLES}
        self._makers |= {f.__name__: partial(f, spark) for f in (channel_map, financier_map)}
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def all_feeds(spark: SparkSession, d: str) -> Feeds:
    return Feeds(spark, d)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
