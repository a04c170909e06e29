import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starlot.operators.lookup import Side, as_side
from starlot.plans import dims, facts, kpis, quality, refresh
from starlot.plans.refresh import full_refresh, prepare, publish_tables
from starlot.plans.schemas import TABLES
from starlot.sources import feeds
from starlot.sources.contracts import COMMISSIONS, require_columns
from starlot.sources.scan import list_files, read_landing, read_optional, read_saved, read_yearly
from starlot.sources.sinks import reconcile, refresh_table, save_counted


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def at(text):
    return datetime.fromisoformat(text)


def write(spark, folder, name, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    """A small landing folder with every source, headers as people write them."""
    f = str(tmp_path_factory.mktemp("landing"))
    write(spark, f, "usuarios", [(1, "João"), (2, "Maria")], "`Id_Usuario` int, `Nome_Usuario` string")
    write(
        spark, f, "hist_vendedor_loja",
        [(1, 10, "Loja A", at("2022-01-01"), at("2022-12-31")), (1, 20, "Loja B", at("2023-01-01"), None),
         (2, 10, "Loja A", at("2022-01-01"), None)],
        "id_vendedor int, id_loja int, loja string, data_inicio timestamp_ntz, data_fim timestamp_ntz",
    )
    write(spark, f, "meta_vendedor", [(1, 202301, 5), (9, 202301, 7)], "id_vendedor int, ano_mes int, meta_qtd int")
    write(spark, f, "meta_loja", [(10, 202301, 50)], "id_loja int, ano_mes int, meta_qtd int")
    write(spark, f, "de_para_canais", [("Face Book", "Meta"), ("Face  book ", "Meta")], "`Canal Origem` string, `Canal Padrão` string")
    write(spark, f, "de_para_vendedores", [("J. Silva", "João")], "nome_origem string, nome_padrao string")
    write(spark, f, "de_para_financeira", [("BV", "Banco V")], "financeira_origem string, financeira_padrao string")
    lead = "`Id` bigint, `Cliente` string, `Canal` string, `Atendente` string, `Conversão` string, `Motivo` string, `Data Criação` timestamp_ntz, `Última Integração` timestamp_ntz, `Estagio` string"
    write(
        spark, f, "Leads",
        [(1, "c1", "FACE BOOK", "J Silva", "Ganho", None, at("2023-01-05 10:00"), at("2023-01-06"), "novo"),
         (2, "c2", "Rádio", "ninguem", "perdido", "m", at("2022-06-01"), None, None),
         (3, "c3", None, "Maria", None, None, None, None, "novo")],
        lead,
    )
    write(spark, f, "Acertos_leads", [(2, "c2", "Meta", "Maria", "GANHO", "m", at("2022-06-01"), None, None)], lead)
    write(spark, f, "Leads_link", [(1, "post/1"), (1, "post/1b")], "`Id` bigint, `Link_post` string")
    for year, extra in ((2022, ""), (2023, ", `Comissão` double")):
        data = [(7, at(f"{year}-03-01"), "joao", 10.0, 8.0, 1.0, 0.5, "AB-1", "gol", "x", "ok", at(f"{year}-01-01"))]
        data += [(8, at(f"{year}-03-01"), None, 20.0, 8.0, 1.0, 0.5, None, "gol", "x", "ok", None)]
        if extra:
            data = [d + (99.0,) for d in data]
        write(
            spark, f, f"Vendas_{year}", data,
            "`Código` bigint, `Dt. Venda` timestamp_ntz, `Vendedor` string, `Venda` double, `Compra` double, "
            "`Lançamentos` double, `Desconto Venda` double, `Placa` string, `Modelo` string, `Cliente` string, "
            "`Situação` string, `Data Compra` timestamp_ntz" + extra,
        )
    write(spark, f, "dados_canais_2022", [(7, "Rádio"), (None, "x")], "codigo bigint, canal string")
    write(spark, f, "dados_canais_2023", [(7, "Meta"), (8, None)], "codigo bigint, canal string")
    write(
        spark, f, "controleagendamentos",
        [(1, "Maria", "face book", at("2023-01-05"), at("2023-01-09"), "Sim", "NÃO", 7)],
        "id bigint, `Responsavel Agendamento` string, canal string, `Criação Agendamento` timestamp_ntz, "
        "`Agendado Para` timestamp_ntz, `Flag Agendamento` string, `Flag Visita` string, `Id Venda` bigint",
    )
    write(
        spark, f, "gerencial_estoque",
        [(7, "Gol 1.0", 2010, "Azul", "Hatch", "AB1", "Estoque"), (9, "Uno", 2011, "Preto", "Hatch", "AB2", "Devolvido")],
        "codigo int, modelo string, ano int, cor string, tipo string, placa string, situacao string",
    )
    write(spark, f, "gerencial_estoque_marca", [("7.0", "VW"), ("x", "none")], "codigo string, marca string")
    write(spark, f, "Vendas_comissao_2022", [("7", "5.5", 1.0, 2.0, 3.0), (None, "1", 1.0, 1.0, 1.0)], "codigo string, `Comissão` string, impostos double, lucro double, retorno double")
    write(spark, f, "Vendas_comissao_2023", [("7", "9", 1.0, 2.0, 3.0)], "codigo string, `Comissão` string, impostos double, lucro double, retorno double")
    write(
        spark, f, "Vendas_retorno_2022", [(at("2022-03-01"), "ab 1", 100.0, "3", "bv"), (at("2022-03-01"), "", 1.0, "1", "bv")],
        "`Dt. Venda` timestamp_ntz, `Placa/Chassi` string, `Financiado` double, `Tp. Ret.` string, `Financeira` string",
    )
    write(spark, f, "custos_plataforma", [("Meta", 100.0, None), ("TV", None, 30.0)], "`Canal` string, `01/01/2023` double, `01/02/2023` double")
    return f


@pytest.fixture(scope="module")
def run(spark, landing, tmp_path_factory):
    return full_refresh(spark, read_landing(spark, landing), str(tmp_path_factory.mktemp("out")))


def test_refresh_builds_all_tables(run):
    assert list(run.tables) == TABLES
    assert run.counts == {
        "dim_canal": 3, "dim_data": 2191, "dim_vendedores": 3, "dim_lojas": 3, "dim_veiculos": 2, "dim_estagio": 2,
        "dim_vendedor_periodo": 2 * (2099 - 2022 + 1) * 12, "fato_leads": 3, "fato_vendas": 4,
        "fato_agendamentos": 1, "fato_meta_vendedor": 2, "fato_meta_loja": 1, "fato_custos_canal": 2,
    }


def test_dimensions(run):
    assert dict(rows(run.tables["dim_canal"])) == {"meta": 1, "": 2, "radio": 3}
    assert dict(rows(run.tables["dim_estagio"])) == {"novo": 1, None: 2}
    assert rows(run.tables["dim_veiculos"].select("id_veiculo", "marca", "modelo", "situacao")) == [
        (7, "vw", "gol 10", "estoque"), (9, "desconhecida", "uno", "devolvido"),
    ]


def test_leads_fact(run):
    got = rows(run.tables["fato_leads"].select(
        "id", "id_vendedor", "id_loja", "id_canal", "id_estagio", "id_data", "convertido_flag", "perdido_flag",
        "link_post", "id_sdr",
    ))
    assert got == [
        (1, 1, 20, 1, 1, 20230105, 1, 0, "post/1", 2),
        (2, 2, 10, 1, 2, 20220601, 1, 0, None, None),
        (3, 2, -1, 2, 1, None, 0, 0, None, None),
    ]


def test_sales_fact(run):
    got = rows(run.tables["fato_vendas"].select(
        "id_venda", "id_veiculo", "id_vendedor", "id_loja", "id_canal", "id_data", "placa", "comissao",
        "valor_financiado", "tipo_retorno", "financeira",
    ))
    assert got == sorted([
        (7, 7, 1, 10, 3, 20220301, "AB-1", 5.5, None, None, None),
        (7, 7, 1, 20, 3, 20230301, "AB-1", 5.5, None, None, None),
        (8, None, -1, -1, 2, 20220301, None, None, None, None, None),
        (8, None, -1, -1, 2, 20230301, None, 99.0, None, None, None),
    ], key=repr)


def test_other_facts(run):
    assert rows(run.tables["fato_agendamentos"].select("id", "id_vendedor", "id_loja", "id_canal", "flag_agendamento", "flag_visita", "campanha", "id_venda")) == [
        (1, 2, 10, 1, 1, 0, None, 7),
    ]
    assert rows(run.tables["fato_meta_vendedor"].select("id_vendedor", "id_data", "id_loja", "meta_qtd")) == [
        (1, 20230101, 20, 5), (9, 20230101, None, 7),
    ]
    assert rows(run.tables["fato_custos_canal"]) == [(-1, 20230201, 30.0), (1, 20230101, 100.0)]


def test_audit(run):
    report = {r["check"]: (r["passed"], r["value"]) for r in run.report.collect()}
    assert report == {
        "unknown_brand": (True, 0.0), "commission_coverage": (False, 0.75), "sales_rows_kept": (True, 0.0),
        "calendar_range": (True, 0.0), "calendar_nulls": (True, 0.0), "costs_without_channel": (False, 1.0),
        "saved_rows": (True, 0.0),
    }
    assert run.failures == 2 and not run.published
    assert rows(run.rates)[-1] == ("fato_vendas", 0.5, 0.5)


def test_csv_landing_gives_the_same_star(spark, landing, run, tmp_path):
    """The same exports as CSV text, dates and numbers included."""
    import os

    for name in os.listdir(landing):
        df = spark.read.parquet(f"{landing}/{name}")
        path = f"{tmp_path}/landing/{name.removesuffix('.parquet')}.csv"
        df.coalesce(1).write.option("header", "true").csv(path)
    again = full_refresh(spark, read_landing(spark, f"{tmp_path}/landing", "csv"), f"{tmp_path}/out")
    for name in TABLES:
        assert again.tables[name].schema == run.tables[name].schema, name
        if name not in ("dim_data", "dim_vendedor_periodo"):
            assert rows(again.tables[name]) == rows(run.tables[name]), name


def test_publish_and_block(spark, landing, tmp_path):
    raw = read_landing(spark, landing)
    blocked = full_refresh(spark, raw, str(tmp_path / "a"), database="gold", block_on_fail=True)
    assert not blocked.published and not spark.catalog.databaseExists("gold")
    done = full_refresh(spark, raw, str(tmp_path / "b"), database="gold")
    assert done.published and spark.table("gold.fato_vendas").count() == 4


def test_financing_needs_a_plate(spark):
    raw = spark.createDataFrame(
        [(at("2022-03-01"), "AB-1", 1.0, "1.0", "BV"), (at("2022-03-01"), "ab1", 2.0, "x", "bv"), (at("2022-03-01"), " - ", 3.0, "1", "bv")],
        "data_venda timestamp_ntz, placa string, valor_financiado double, tipo_retorno string, financeira string",
    ).withColumns({"_file": F.lit("f"), "_row": F.col("valor_financiado").cast("bigint")})
    codes = feeds.financier_map(spark.createDataFrame([("BV", "Banco V")], "financeira_origem string, financeira_padrao string"))
    assert rows(feeds.conform_financing(raw, codes)) == [("ab1", 20220301, 1.0, 1, "banco v")]


def test_maps_that_contradict_themselves(spark, run):
    pairs = [("Face Book", "Meta"), ("face  book", "META "), ("Rádio", "AM"), ("radio", "FM"), ("radio", "FM"), ("TV", "tv"), (None, "x")]
    codes = spark.createDataFrame(pairs, "canal_origem string, canal_padrao string")
    side = feeds.channel_map(codes)
    assert (side.dropped, side.conflicting) == (3, 1) and rows(side.df) == [("", "x"), ("face book", "meta"), ("radio", "am"), ("tv", "tv")]
    assert rows(feeds.conflicts({"channel_map": codes})) == [("channel_map", "radio", "am", 3, 2)]
    with pytest.raises(ValueError, match="radio"):
        feeds.channel_map(codes, strict=True)
    assert feeds.channel_map(codes.limit(0))[1:] == (True, 0, 0) and rows(run.conflicts) == []


def test_kpis(spark):
    costs = spark.createDataFrame([(1, 20230101, 100.0), (2, 20230101, 50.0), (-1, 20230101, 7.0)], "id_canal int, id_data int, custo double")
    leads = spark.createDataFrame([(1, 20230105, 1), (1, 20230120, 0), (1, 20230201, 1)], "id_canal int, id_data int, convertido_flag int")
    assert rows(kpis.cost_per_lead(costs, leads)) == [(1, 202301, 100.0, 2, 50.0), (2, 202301, 50.0, 0, None)]
    assert rows(kpis.cost_per_sale(costs, leads)) == [(1, 202301, 100.0, 1, 100.0), (2, 202301, 50.0, 0, None)]
    assert rows(kpis.total_cost(costs)) == [(-1, 7.0), (1, 100.0), (2, 50.0)]


def test_quality_edges(spark):
    empty = spark.createDataFrame([], "marca string, situacao string")
    assert rows(quality.brand_check(empty)) == [("unknown_brand", False, None, 0.05)]
    days = dims.calendar_dim(spark).filter("id_data <> 20230115")
    assert rows(quality.calendar_range_check(days)) == [("calendar_range", False, 1.0, 0.0)]
    doubled = spark.range(5).unionByName(spark.range(1))
    assert rows(quality.sales_rows_check(doubled, spark.range(5))) == [("sales_rows_kept", False, 1.0, 0.0)]
    assert rows(quality.sales_rows_check(spark.range(5), 5)) == [("sales_rows_kept", True, 0.0, 0.0)]
    assert rows(quality.row_counts({"a": doubled})) == [("a", 6)]


def test_contracts(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "codigo int")
    with pytest.raises(ValueError, match="marca"):
        require_columns(df, "stock_brands")
    with pytest.raises(FileNotFoundError, match="sales"):
        read_yearly(spark, f"{tmp_path}/Vendas_*.parquet", "sales")
    assert read_optional(spark, f"{tmp_path}/none*.parquet") is None
    assert read_optional(spark, f"{tmp_path}/none*.parquet", empty=COMMISSIONS).schema == COMMISSIONS
    with pytest.raises(FileNotFoundError, match="gold"):
        read_saved(spark, f"{tmp_path}/none", "gold")
    df.write.parquet(f"{tmp_path}/Vendas_2022.parquet")
    with pytest.raises(ValueError, match="Vendas_2022"):
        read_yearly(spark, f"{tmp_path}/Vendas_*.parquet", "sales")


def test_yearly_order_and_layouts(spark, tmp_path):
    for year in (2023, 2021, 2022):
        header = "`Código` bigint, Canal string" if year != 2022 else "codigo bigint, canal string, extra int"
        data = [(1, f"c{year}"), (year, "x")] if year != 2022 else [(1, "c2022", 5)]
        spark.createDataFrame(data, header).coalesce(1).write.parquet(f"{tmp_path}/dados_canais_{year}.parquet")
    names = [p.rsplit("/", 1)[1] for p in list_files(spark, f"{tmp_path}/dados_canais_*.parquet")]
    assert names == [f"dados_canais_{y}.parquet" for y in (2021, 2022, 2023)]
    read = read_yearly(spark, f"{tmp_path}/dados_canais_*.parquet", "sale_channels")
    assert read.count() == 5 and read.columns == ["codigo", "canal", "_file", "_block", "_row", "extra"]


def _jobs(spark, run):
    spark.sparkContext.setJobGroup("counted", "")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    out = run()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, jobs


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_yearly_jobs_do_not_grow_with_files(spark, tmp_path, fmt):
    import pyarrow as pa
    import pyarrow.parquet as pq

    def write_one(folder, k):
        extra = k % 7 == 3
        if fmt == "csv":
            (folder / f"Canais {k:04}.csv").write_text("Código,Canal" + (",extra" if extra else "") + f"\n{k},c{k}" + (",1" if extra else "") + "\n")
        else:
            cols = {"Código": pa.array([k], pa.int32() if k % 5 == 4 else pa.int64()), "Canal": [f"c{k}"], **({"extra": [1]} if extra else {})}
            pq.write_table(pa.table(cols), folder / f"Canais {k:04}.parquet")

    jobs = {}
    for n in (30, 300):
        folder = tmp_path / str(n)
        folder.mkdir()
        for k in range(n):
            write_one(folder, k)
        read, jobs[n] = _jobs(spark, lambda: read_yearly(spark, f"{folder}/Canais*.{fmt}", "sale_channels", fmt))
        got = read.selectExpr("cast(codigo as int) codigo", "canal", "cast(extra as int) extra", "_file").orderBy("codigo").collect()
        assert [(r.codigo, r.canal, r.extra) for r in got] == [(k, f"c{k}", 1 if k % 7 == 3 else None) for k in range(n)]
        assert all(f"{r.codigo:04}" in r["_file"] for r in got)
    # Listing of many paths is a job of Spark's own; each of the layouts asks for its schema once.
    assert jobs[300] <= jobs[30] + 6 and jobs[300] <= 20


def test_unreadable_heads_are_left_to_spark(spark, tmp_path):
    from starlot.sources import layouts

    for year, text in ((2021, 'codigo,"can\nal"\n'), (2022, "codigo,canal\n1,x\n"), (2023, ""), (2024, "\ncodigo,canal\n2,y\n")):
        (tmp_path / f"c_{year}.csv").write_text(text)
    found = [(f"{tmp_path}/c_{y}.csv",) * 2 for y in (2021, 2022, 2023, 2024)]
    assert [[p[-8:-4] for p in g] for g in layouts.group_files(spark, found, "csv", {})] == [["2021"], ["2022", "2024"], ["2023"]]
    assert len(layouts.group_files(spark, found, "csv", {"inferSchema": "true"})) == 4
    assert len(layouts.group_files(spark, [(p, "nostore://x/y") for p, _ in found], "csv", {})) == 4


def test_sinks(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "cast(id as string) as t", "if(id = 3, null, id / 7) as x")
    seen = save_counted(df, f"{tmp_path}/a", [F.max("id").alias("last")])
    assert seen.rows == 10 and seen.metrics == {"last": 9}
    assert seen.content == save_counted(df.repartition(3).orderBy(F.desc("id")), f"{tmp_path}/b").content
    assert save_counted(df.limit(0), f"{tmp_path}/none")[:2] == (0, "0" * 32)
    assert refresh_table(df, "default.sink_t").rows == 10
    assert refresh_table(df.limit(4), "default.sink_t").rows == 4
    assert spark.table("default.sink_t").count() == 4
    got = reconcile(spark, {"a": 10, "b": 3}, {"a": spark.read.parquet(f"{tmp_path}/a")})
    assert rows(got) == [("a", 10, 10, None, True), ("b", 3, None, None, False)]
    cell = df.withColumn("x", F.when(F.col("id") == 5, 0.25).otherwise(F.col("x")))
    pairs = df.unionByName(df.where("id < 2")), df.unionByName(df.where("id between 4 and 5"))  # equal rows cancel in an exclusive or
    tables = {"a": spark.read.parquet(f"{tmp_path}/a"), "cell": cell, "nulls": df.withColumn("t", F.lit(None).cast("string")), "pairs": pairs[1], "gone": None}
    expected = {n: seen for n in tables} | {"pairs": save_counted(pairs[0], f"{tmp_path}/c")}
    del tables["gone"]
    got = {r.table_name: (r.same_content, r.matches) for r in reconcile(spark, expected, tables).collect()}
    assert got == {"a": (True, True), "cell": (False, False), "nulls": (False, False), "pairs": (False, False), "gone": (None, False)}
    assert publish_tables(spark, {"sink_u": df}, "default").first().matches


def test_observed_checks_equal_those_over_the_tables(spark, run):
    raw = run.silver_counts["vendas"]
    assert rows(quality.observed_report(spark, run.saved, raw)) == rows(quality.quality_report(run.tables, raw))
    facts_ = {n: run.tables[n] for n in quality.RATED}
    assert rows(run.rates) == rows(quality.match_rates(facts_))
    empty = save_counted(run.tables["fato_vendas"].limit(0), run.tables["fato_vendas"].inputFiles()[0].rsplit("/", 1)[0] + "-none", quality.observed_columns("fato_vendas"))
    assert rows(quality.observed_report(spark, {"fato_vendas": empty})) == [("commission_coverage", False, None, 0.9)]


def test_bucketed_sales_move_no_row(spark, landing, run, tmp_path):
    raw = read_landing(spark, landing)
    silver, star = prepare(spark, raw, str(tmp_path), sale_buckets=4)
    sellers = facts.seller_sides(star["dim_vendedores"], silver["hist_vendedor_loja"], feeds.seller_map(raw["seller_map"]))
    details = star["_vendas"]
    assert silver.buckets == {"vendas": (4, facts.SALE_KEY)} and star.saved["_vendas"].rows == details.count() == 4
    fact = facts.sales_fact(silver["vendas"], Side(details, False), sellers)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fact._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Only sides that are broadcast, and periods on their way to that, are moved.
    sales = plan[plan.index("SortMergeJoin"):]
    assert sales.count("Bucketed: true") == 2 and "Exchange" not in sales.split("BroadcastExchange")[0]
    assert rows(fact) == rows(run.tables["fato_vendas"]) == rows(star["fato_vendas"])
    # The plain form joins once, too, and equal hashes alone are no match.
    other = details.withColumn("id_venda", F.col("id_venda") + 1)
    lost = facts.sales_fact(silver["vendas"], Side(other, False), sellers)
    assert lost.count() == 4 and lost.where("comissao = 5.5 or id_veiculo is not null").isEmpty()


def test_bucketed_sales_leave_no_copy_and_have_buckets_enough(spark, landing, run, tmp_path, monkeypatch):
    raw = read_landing(spark, landing)
    monkeypatch.setattr(refresh, "SALES_A_BUCKET", 1)
    number = refresh.buckets_of_sales(raw, least=3)
    assert number == run.counts["fato_vendas"] == 4 and refresh.buckets_of_sales(raw, least=9) == 9
    made = []
    monkeypatch.setattr(refresh, "shared_folder", lambda spark, purpose: made.append(f"{tmp_path}/{purpose}") or made[-1])
    star = prepare(spark, raw, f"{tmp_path}/star", sale_buckets=number)[1]
    assert rows(star["fato_vendas"]) == rows(run.tables["fato_vendas"])
    assert made == [f"{tmp_path}/numbered"] and not os.path.exists(made[0])


def test_sales_move_once_however_many_sides_are_large(spark, landing, run, tmp_path, small_limits):
    star = prepare(spark, read_landing(spark, landing), str(tmp_path))[1]
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in off.items():
        spark.conf.set(key, value)
    try:
        fact = star.builders["fato_vendas"]()
        nodes = [fact._jdf.queryExecution().executedPlan()]
        for node in nodes:
            nodes += [node.children().apply(i) for i in range(node.children().size())]
    finally:
        for key in off:
            spark.conf.unset(key)
    moved = [n.output().toString() for n in nodes if n.nodeName() == "Exchange"]
    # To the sides go numbers with what they are asked for.
    assert len(moved) > 6 and sum("valor_venda" in columns for columns in moved) == 1
    assert rows(fact) == rows(run.tables["fato_vendas"])


def test_builders_keep_every_row(spark):
    leads = spark.createDataFrame([(i % 3, "x", None) for i in range(20)], "id bigint, atendente string, data_criacao timestamp_ntz")
    leads = leads.withColumns({"canal": F.lit("q"), "estagio": F.lit(None).cast("string")})
    hist = spark.createDataFrame([(1, 5, "l", at("2022-01-01"), None)] * 3, "id_vendedor bigint, id_loja bigint, loja string, data_inicio timestamp_ntz, data_fim timestamp_ntz")
    users = spark.createDataFrame([(1, "x"), (2, "x")], "id_vendedor bigint, nome string")
    codes = feeds.seller_map(spark.createDataFrame([("x", "x"), ("X ", "x")], "nome_origem string, nome_padrao string"))
    channels = spark.createDataFrame([("q", 1)], "canal string, id_canal int")
    fact = facts.leads_fact(leads, as_side(channels), dims.stage_dim(leads), facts.seller_sides(users, hist, codes))
    assert fact.count() == 20
