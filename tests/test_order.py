"""What stands first in a file wins, also where it is not the smallest value."""

from datetime import datetime
from threading import Lock

import pytest
from pyspark.sql import functions as F

from starlot.functions.scalars import lenient_number
from starlot.operators.keys import surrogate_keys
from starlot.plans import refresh
from starlot.plans.refresh import PublishError, full_refresh, prepare, publish
from starlot.sources.scan import read_file, read_landing
from starlot.sources.sinks import current_run, run_path, run_view


def at(text):
    return datetime.fromisoformat(text)


SOURCES = {
    "usuarios": ([(5, "Ana"), (1, "Bia")], "id_usuario int, nome_usuario string"),
    "hist_vendedor_loja": (
        [(5, 20, "B", at("2023-01-01"), at("2023-01-20")), (5, 10, "A", at("2023-01-05"), at("2023-12-31"))],
        "id_vendedor int, id_loja int, loja string, data_inicio timestamp_ntz, data_fim timestamp_ntz",
    ),
    "meta_vendedor": ([(5, 202301, 5)], "id_vendedor int, ano_mes int, meta_qtd int"),
    "meta_loja": ([(10, 202301, 50)], "id_loja int, ano_mes int, meta_qtd int"),
    "de_para_canais": ([("x", "y")], "canal_origem string, canal_padrao string"),
    "de_para_vendedores": ([("x", "y")], "nome_origem string, nome_padrao string"),
    "de_para_financeira": ([("x", "y")], "financeira_origem string, financeira_padrao string"),
    "Leads": (
        [(9, "c", "beta", "Ana", "ganho", "m", at("2023-02-01"), None, "s3"), (1, "c", "zeta", "Ana", "ganho", "m", at("2023-02-01"), None, "s2"),
         (2, "c", "alfa", "Ana", "ganho", "m", at("2023-02-01"), None, "s1")],
        "id bigint, cliente string, canal string, atendente string, conversao string, motivo string, "
        "data_criacao timestamp_ntz, ultima_integracao timestamp_ntz, estagio string",
    ),
    "Acertos_leads": (
        [(9, "c", "aaaa", "Ana", "ganho", "m", at("2023-02-01"), None, "s0")],
        "id bigint, cliente string, canal string, atendente string, conversao string, motivo string, "
        "data_criacao timestamp_ntz, ultima_integracao timestamp_ntz, estagio string",
    ),
    "Leads_link": ([(1, "post"), (1, "ad")], "id bigint, link_post string"),
    "Vendas_2023": (
        [(7, at("2023-03-01"), "Ana", 10.0, 8.0, "AB1")],
        "codigo bigint, `dt. venda` timestamp_ntz, vendedor string, venda double, compra double, placa string",
    ),
    "dados_canais_2023": ([(8, "web"), (7, "tv"), (7, "ad")], "codigo bigint, canal string"),
    "controleagendamentos": (
        [(1, "Ana", "x", at("2023-01-05"), None, "sim", None), (1, "ninguem", "x", at("2023-01-05"), None, "sim", None)],
        "id bigint, responsavel_agendamento string, canal string, criacao_agendamento timestamp_ntz, "
        "agendado_para timestamp_ntz, flag_agendamento string, flag_visita string",
    ),
    "gerencial_estoque": (
        [(7, "Gol", 2010, "Azul", "Hatch", "AB1", "Estoque")],
        "codigo int, modelo string, ano int, cor string, tipo string, placa string, situacao string",
    ),
    "gerencial_estoque_marca": ([("7", "VW"), ("7", "Audi")], "codigo string, marca string"),
    "custos_plataforma": ([("tv", 100.0)], "`Canal` string, `01/01/2023` double"),
}
FORM = "dd/MM/yyyy HH:mm"
DATED = {name: (FORM,) for name in ("leads", "sales", "appointments", "history")}


def landed(spark, folder, fmt, **options):
    for name, (data, schema) in SOURCES.items():
        out = spark.createDataFrame(data, schema).coalesce(1).write
        out.format(fmt).options(**options).save(f"{folder}/{name}.{fmt}")
    return read_landing(spark, folder, fmt)


@pytest.fixture(scope="module", params=["parquet", "csv"])
def star(request, spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("order"))
    options = {"header": "true", "timestampNTZFormat": FORM} if request.param == "csv" else {}
    return prepare(spark, landed(spark, f"{folder}/in", request.param, **options), f"{folder}/out", formats=DATED)[1]


def test_first_rows_win(star):
    assert {r.canal: r.id_canal for r in star["dim_canal"].collect()} == {"zeta": 1, "alfa": 2, "aaaa": 3, "web": 4, "tv": 5}
    assert {r.estagio: r.id_estagio for r in star["dim_estagio"].collect()} == {"s2": 1, "s1": 2, "s0": 3}
    assert star["dim_veiculos"].first().marca == "vw"
    months = {r.ano_mes: r.id_loja for r in star["dim_vendedor_periodo"].collect()}
    assert months[202301] == 20 and months[202302] == 10
    lead = star["fato_leads"].where("id = 1").first()
    assert lead.id_sdr == 5 and lead.link_post == "post" and lead.id_data == 20230201


def test_unreadable_dates_are_an_error(spark, tmp_path):
    raw = landed(spark, str(tmp_path / "in"), "csv", header="true", timestampNTZFormat=FORM)
    with pytest.raises(ValueError, match="leads"):
        prepare(spark, raw, str(tmp_path / "out"))[0]["leads"]


def test_a_failed_publish_leaves_all_views_on_the_run_before(spark, tmp_path):
    raw, out = landed(spark, str(tmp_path / "in"), "parquet"), str(tmp_path / "out")
    assert current_run(spark, f"{out}/gold") is None
    first = full_refresh(spark, raw, out, database="order_gold", run="2025-01-31")
    assert first.published and first.silver_counts["leads"] == 3 and current_run(spark, f"{out}/gold") == "2025-01-31"
    view = {name: spark.table(f"order_gold.{name}") for name in first.tables}
    assert all(view[n].columns == first.tables[n].columns for n in view)
    before = {n: sorted(map(repr, v.collect())) for n, v in view.items()}

    raw["leads"] = raw["leads"].withColumn("conversao", F.lit("ganho"))
    second = full_refresh(spark, raw, out, run="007")
    # As many rows, one changed cell: told by content alone.
    leads = run_path(f"{out}/gold", "fato_leads", "007")
    changed = spark.createDataFrame(spark.read.parquet(leads).withColumn("convertido_flag", (F.col("id") % 2).cast("int")).collect(), first.tables["fato_leads"].schema)
    changed.write.mode("overwrite").parquet(leads)
    with pytest.raises(PublishError, match="fato_leads") as error:
        publish(spark, "order_gold", f"{out}/gold", "007", second.saved)
    assert error.value.tables == ["fato_leads"]
    missing = {**second.saved, "fato_vendas": second.saved["fato_vendas"]._replace(rows=99)}
    with pytest.raises(PublishError, match="fato_leads.*fato_vendas"):
        publish(spark, "order_gold", f"{out}/gold", "007", missing)
    assert current_run(spark, f"{out}/gold") == "2025-01-31"
    assert {n: sorted(map(repr, spark.table(f"order_gold.{n}").collect())) for n in view} == before

    third = full_refresh(spark, raw, out, database="order_gold", run="3")
    assert third.published and current_run(spark, f"{out}/gold") == "3"
    assert {r.convertido_flag for r in spark.table("order_gold.fato_leads").collect()} == {1}
    # The very views made by the first run read the third one, and only its files.
    plan = spark.table("order_gold.fato_leads")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and not run_view(spark, "order_gold.fato_leads", f"{out}/gold", "fato_leads", first.tables["fato_leads"].columns)
    assert {p.split("run=")[1].split("/")[0] for p in (r.f for r in spark.table("order_gold.fato_leads").select(F.input_file_name().alias("f")).collect())} == {"r-3"}


def test_a_run_is_taken_up_where_its_driver_died(spark, tmp_path, monkeypatch):
    raw, out = landed(spark, str(tmp_path / "in"), "parquet"), str(tmp_path / "out")
    built, save, lock = [], refresh.save_counted, Lock()

    def dies_after(limit):
        def counted(df, path, *more):
            with lock:
                if len(built) == limit:
                    raise KeyboardInterrupt
                built.append(path)
            return save(df, path, *more)

        monkeypatch.setattr(refresh, "save_counted", counted)

    dies_after(6)
    with pytest.raises(KeyboardInterrupt):
        full_refresh(spark, raw, out, run="x", resume=True)
    first, built[:] = list(built), []
    dies_after(None)
    again = full_refresh(spark, raw, out, run="x", resume=True)
    whole = full_refresh(spark, raw, str(tmp_path / "other"))
    assert len(first) == 6 and not set(first) & set(built) and again.saved == whole.saved
    n_tables = len(first) + sum(out in p for p in built)
    built[:] = []
    full_refresh(spark, raw, out, run="x", resume=True)
    assert built == []
    # Another input, or another setting: nothing that was noted counts.
    inputs = refresh.inputs_fingerprint(spark, raw, False, None)
    state = f"{out}/state/r-x"
    assert len(refresh.finished_tables(spark, state, inputs)) == n_tables
    spark.createDataFrame([(1, "x")], "id bigint, link_post string").write.parquet(f"{tmp_path}/more")
    other = {**raw, "lead_links": spark.read.parquet(f"{tmp_path}/more")}
    assert refresh.inputs_fingerprint(spark, raw, True, None) != inputs != refresh.inputs_fingerprint(spark, other, False, None)
    assert refresh.finished_tables(spark, state, refresh.inputs_fingerprint(spark, other, False, None)) == {}
    with pytest.raises(ValueError, match="named"):
        full_refresh(spark, raw, out, resume=True)


def test_csv_places_follow_the_file(spark, tmp_path):
    spark.range(20_000, 0, -1).coalesce(1).write.csv(str(tmp_path / "x.csv"), header=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_file(spark, str(tmp_path / "x.csv"), "csv", order=True).orderBy("_file", "_block", "_row").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [int(r.id) for r in rows] == list(range(20_000, 0, -1)) and len({r._block for r in rows}) > 1


def test_numbers(spark):
    texts = ["7", " 7 ", "7.0", "7.5", "7F", "7D", "nan", "NaN", "Infinity", "-inf", "1e3", "", None, "x", "+.5", "0x10", "99999999999999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(lenient_number(F.col("t")).alias("d"), lenient_number(F.col("t"), "bigint").alias("n")).collect()
    assert [r.d for r in got] == [7, 7, 7, 7.5, None, None, None, None, None, None, 1000, None, None, None, 0.5, None, 1e20]
    assert [r.n for r in got] == [7, 7, 7, None, None, None, None, None, None, None, 1000, None, None, None, None, None, None]
    assert spark.sql("SELECT double('nan') AS t").select(lenient_number(F.col("t")).alias("d")).first().d is None


def test_keys_beyond_the_bound(spark, small_limits):
    df = spark.range(5000).select((F.col("id") % 700).alias("v"), (-F.col("id")).alias("at"))
    got = {r.v: r.k for r in surrogate_keys(df, "v", "k", ["at"]).collect()}
    first = {}
    for i in range(4999, -1, -1):
        first.setdefault(i % 700, len(first) + 1)
    assert got == first
