"""The full refresh: conformed feeds, dimensions, facts, audit, publish.

Each table is computed once, written, and read back by what depends on it, so
no lineage is evaluated twice and a lost executor costs one table at most. A run that is
named can be taken up again after its driver has died: tables that it finished from the same inputs stay.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cache
from threading import RLock
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlot.functions.scalars import col
from starlot.operators.columns import conform_to
from starlot.operators.formats import source_formats
from starlot.operators.lookup import as_side
from starlot.plans import dims, facts
from starlot.plans.quality import observed_columns, observed_rates, observed_report
from starlot.plans.schemas import FACT_APPOINTMENTS, TABLES
from starlot.sources import feeds as clean
from starlot.sources.contracts import COMMISSIONS, FINANCING
from starlot.sources.scan import read_saved
from starlot.session import bucketed_table, materialise, release, setting, shared_folder
from starlot.sources.sinks import (
    RUN_PREFIX, Saved, content_columns, reconcile, refresh_table, run_path, run_view, save_counted, switch_run,
)


class Refresh(NamedTuple):
    tables: dict[str, DataFrame]
    counts: dict[str, int]
    report: DataFrame
    rates: DataFrame
    failures: int
    published: bool
    silver_counts: dict[str, int]
    saved: dict[str, Saved]
    run: str
    conflicts: DataFrame


# How sales are told apart; a run begun with another way is not taken up.
SALES_BY = "number"
AT_ONCE_SETTING = "starlot.refresh.atOnce"
AT_ONCE = 4


def once(make: Callable) -> Callable:
    """``make`` called once for each argument, also if several threads ask."""
    lock, known = RLock(), cache(make)

    def get(*args):
        with lock:
            return known(*args)

    return get


class Tables:
    """Tables by name; each is computed, written and read back when first asked for.

    ``place`` names the folder of a table. What was seen on writing (rows, content, metrics) is kept in
    ``saved``. With ``state``, a folder, that is also written down there with ``inputs``, a fingerprint; a table
    noted there with the same fingerprint is read back instead of built. ``buckets`` tells tables whose files are
    dealt by a key (see ``sinks.save_counted``); a restart reads those as plain files. ``scratch`` gets, from the builder of a
    table, the shared folder that only the writing of this table reads: it goes when the table is written.
    """

    def __init__(
        self, spark: SparkSession, place: Callable[[str], str], builders: dict[str, Callable[[], DataFrame]],
        state: str | None = None, inputs: str = "", buckets: Mapping[str, tuple[int, str]] | None = None,
        scratch: dict[str, str] | None = None,
    ):
        self.spark, self.place, self.builders, self.state, self.inputs = spark, place, builders, state, inputs
        self.buckets = buckets or {}
        self.scratch = {} if scratch is None else scratch
        self.saved: dict[str, Saved] = {}
        self._done: dict[str, DataFrame] = {}
        self._locks = {name: RLock() for name in builders}
        self._noted = finished_tables(spark, state, inputs) if state else {}

    @property
    def counts(self) -> dict[str, int]:
        return {name: seen.rows for name, seen in self.saved.items()}

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            return self._table(name)

    def fetch(self, *names: str) -> None:
        """Build several tables at a time: most are too small to fill a cluster by themselves.

        Each is still built once, by whoever asks for it first; tables depend on each other without a circle, so nobody waits for ever.
        """
        with ThreadPoolExecutor(setting(self.spark, AT_ONCE_SETTING, AT_ONCE)) as pool:
            for _ in pool.map(self.__getitem__, names):
                pass

    def _table(self, name: str) -> DataFrame:
        if name not in self._done:
            path = self.place(name)
            table = None
            if name in self._noted:
                self.saved[name] = self._noted[name]
            else:
                table = bucketed_table() if name in self.buckets else None
                self.saved[name] = save_counted(self.builders[name](), path, observed_columns(name), table, self.buckets.get(name))
                if name in self.scratch:
                    release(self.scratch.pop(name))
                if self.state:
                    _note(self.spark, self.state, name, self.saved[name], self.inputs)
            self._done[name] = self.spark.table(table) if table else read_saved(self.spark, path, name)
        return self._done[name]

    def __iter__(self):
        return iter(self.builders)


NOTES = "table_name string, row_count bigint, content string, metrics string, inputs string, at timestamp"


def _note(spark: SparkSession, state: str, name: str, seen: Saved, inputs: str) -> None:
    """One row in one new file, written after the table: a table without it is built anew."""
    row = spark.createDataFrame([(name, *seen[:2], json.dumps(seen.metrics), inputs)], NOTES.removesuffix(", at timestamp"))
    # A folder of its own, as tables are noted side by side and a writer clears what it finds half done in its folder.
    row.withColumn("at", F.current_timestamp()).coalesce(1).write.parquet(f"{state}/note-{name}-{uuid.uuid4().hex}")


def finished_tables(spark: SparkSession, state: str, inputs: str) -> dict[str, Saved]:
    """Tables noted in ``state`` as built last from the inputs of this fingerprint; a row a table."""
    try:
        notes = spark.read.schema(NOTES).option("recursiveFileLookup", "true").parquet(state)
    except AnalysisException:
        return {}
    last = notes.groupBy("table_name").agg(F.max_by(F.struct("row_count", "content", "metrics", "inputs"), "at").alias("note"))
    return {
        r["table_name"]: Saved(r["row_count"], r["content"], json.loads(r["metrics"]))
        for r in last.select("table_name", "note.*").filter(F.col("inputs") == inputs).collect()
    }


def inputs_fingerprint(spark: SparkSession, raw: Mapping[str, DataFrame], *settings: object) -> str:
    """Changes with the name, size or time of any file behind the feeds, with the rows of feeds that have none, and with ``settings``.

    Files are listed, not read.
    """
    parts = [SALES_BY, repr(settings)]
    files: dict[str, str] = {}
    for source in sorted(raw):
        found = raw[source].inputFiles()
        files |= {unquote(path): source for path in found}
        if not found:
            parts.append(f"{source}:{sorted(raw[source].agg(*content_columns(raw[source])).first().asDict().items())}")
    if files:
        listed = spark.read.format("binaryFile").load(sorted(files)).select("path", "length", "modificationTime")
        parts.append(repr(sorted(listed.agg(*content_columns(listed)).first().asDict().items())))
        parts.append(repr(sorted(files.values())))
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


# ``formats`` of a refresh that elects them from the values; and the dates of each source.
ELECT = "elect"
DATES = {
    "leads": ("data_criacao", "ultima_integracao"), "sales": ("data_venda",), "history": ("data_inicio", "data_fim"),
    "appointments": ("criacao_agendamento", "agendado_para"), "financing": ("data_venda",),
}
# Text dates without which a feed is of no use, by feed and column.
NEEDED_DATES = {"leads": "data_criacao", "sales": "data_venda", "appointments": "criacao_agendamento"}


def conform_feeds(
    spark: SparkSession, raw: Mapping[str, DataFrame], silver: str, formats: dict[str, tuple[str, ...]] | str | None = None,
    state: str | None = None, inputs: str = "", sale_buckets: int = 0,
) -> Tables:
    """The twelve conformed tables, written to ``silver`` as they are asked for.

    ``formats`` names, by source, the formats of dates that arrive as text, or is ``ELECT``: then they are found in one
    pass over a source's text dates (see ``operators.formats``) when it is first asked for. With ``sale_buckets`` sales lie in
    that many buckets of their key.
    """
    @once
    def dated(source: str) -> tuple[str, ...]:
        if formats != ELECT:
            return (formats or {}).get(source, ())
        dates = DATES.get(source) or tuple(n for n in raw[source].columns if n.startswith("dt"))
        found = source_formats(raw[source], dates)
        if source == "leads" and "lead_corrections" in raw:
            found = tuple(dict.fromkeys([*found, *source_formats(raw["lead_corrections"], dates)]))
        return found

    channels = once(lambda: clean.channel_map(raw["channel_map"]))

    def checked(source: str, df: DataFrame) -> DataFrame:
        name = NEEDED_DATES[source]
        text = name in raw[source].columns and raw[source].schema[name].dataType.simpleString() == "string"
        if text and df.where(col(name).isNotNull()).isEmpty() and not df.isEmpty():
            raise ValueError(f"{source}: no {name} is a date by the formats {dated(source)}")
        return df

    scratch: dict[str, str] = {}

    def numbered(sales: DataFrame) -> DataFrame:
        """Sales that are dealt by their number are written with it first, as a task done again may meet its rows in another order."""
        if not sale_buckets:
            return sales
        scratch["vendas"] = shared_folder(spark, "numbered")
        return materialise(sales, scratch["vendas"], compact=True)

    return Tables(spark, lambda name: f"{silver}/{name}", {
        "usuarios": lambda: clean.conform_users(raw["users"]),
        "hist_vendedor_loja": lambda: clean.conform_history(raw["history"], dated("history")),
        "meta_vendedor": lambda: clean.conform_targets(raw["seller_targets"], "seller_targets"),
        "meta_loja": lambda: clean.conform_targets(raw["store_targets"], "store_targets"),
        "leads": lambda: checked("leads", clean.conform_leads(raw["leads"], channels(), raw.get("lead_corrections"), dated("leads"))),
        "vendas": lambda: numbered(facts.with_sale_key(checked("sales", clean.conform_sales(raw["sales"], dated("sales"))))),
        "canais": lambda: clean.conform_sale_channels(raw["sale_channels"], channels()),
        "agendamentos": lambda: checked("appointments", clean.conform_appointments(raw["appointments"], channels(), dated("appointments"))),
        "veiculos": lambda: clean.conform_vehicles(
            raw["vehicles"],
            clean.stock_brands(raw["stock_brands"]) if "stock_brands" in raw else None,
            clean.sale_brands(raw["sale_brands"], formats=dated("sale_brands")) if "sale_brands" in raw else None,
        ),
        "comissoes": lambda: clean.conform_commissions(raw["commissions"])
        if "commissions" in raw else spark.createDataFrame([], COMMISSIONS),
        "retorno": lambda: clean.conform_financing(
            raw["financing"], clean.financier_map(raw["financier_map"]), formats=dated("financing")
        )
        if "financing" in raw else spark.createDataFrame([], FINANCING),
        "custos_canal": lambda: clean.conform_channel_costs(raw["channel_costs"]),
    }, state, inputs, {"vendas": (sale_buckets, facts.SALE_KEY)} if sale_buckets else None, scratch)


def build_star(
    silver: Tables | dict[str, DataFrame], seller_codes: DataFrame, gold: str, links: DataFrame | None = None,
    by_date: bool = False, run: str = "", state: str | None = None, inputs: str = "", sale_buckets: int = 0,
) -> Tables:
    """All thirteen tables, each written as ``run`` below ``gold`` when it is asked for, what it needs before it."""
    spark = seller_codes.sparkSession
    order = clean.arrival
    channels = once(lambda: as_side(star["dim_canal"], stored=True))
    sellers = once(lambda: facts.seller_sides(star["dim_vendedores"], silver["hist_vendedor_loja"], clean.seller_map(seller_codes), by_date))
    run = run or uuid.uuid4().hex

    def after(names: tuple[str, ...], build: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
        """``build`` with the silver tables behind it built side by side first."""
        def built() -> DataFrame:
            if isinstance(silver, Tables):
                silver.fetch(*names)
            return build()

        return built

    who = ("usuarios", "hist_vendedor_loja")
    sold = ("vendas", "comissoes", "retorno", "leads", "canais", "veiculos", *who)
    sale_sides = once(lambda: facts.sale_sides(
        facts.sale_attributes(silver["canais"], star["dim_veiculos"], silver["comissoes"]), channels(),
        as_side(silver["retorno"], stored=True), sellers(),
    ))
    star = Tables(spark, lambda name: run_path(gold, name, run), {
        "dim_canal": after(("leads", "canais"), lambda: dims.channel_dim(
            silver["leads"], silver["canais"], order(silver["leads"], "id"), order(silver["canais"], "codigo")
        )),
        "dim_data": lambda: dims.calendar_dim(spark),
        "dim_vendedores": lambda: dims.seller_dim(silver["usuarios"]),
        "dim_lojas": lambda: dims.store_dim(silver["hist_vendedor_loja"]),
        "dim_veiculos": lambda: dims.vehicle_dim(silver["veiculos"]),
        "dim_estagio": lambda: dims.stage_dim(silver["leads"], order(silver["leads"], "id")),
        "dim_vendedor_periodo": lambda: dims.seller_month_dim(
            silver["hist_vendedor_loja"], order(silver["hist_vendedor_loja"], "data_inicio")
        ),
        # Not published: appointments with their order, from which a lead takes its owner.
        "_agendamentos": after(
            ("agendamentos", "leads", "canais", *who), lambda: facts.appointments_seen(silver["agendamentos"], channels(), sellers())
        ),
        "fato_agendamentos": lambda: conform_to(star["_agendamentos"], FACT_APPOINTMENTS),
        "fato_leads": lambda: facts.leads_fact(
            silver["leads"], channels(), as_side(star["dim_estagio"], stored=True), sellers(), star["_agendamentos"],
            None if links is None else clean.conform_links(links), order(star["_agendamentos"], "id"),
        ),
        # Not published: what is found for each sale, where sales and that are to lie in the same buckets.
        "_vendas": after(sold, lambda: facts.sale_details(silver["vendas"], sale_sides())),
        "fato_vendas": after(sold, lambda: facts.sales_fact(silver["vendas"], as_side(star["_vendas"], stored=True), sellers())
        if sale_buckets else facts.sales_found(silver["vendas"], sale_sides())),
        "fato_meta_vendedor": lambda: facts.seller_targets_fact(
            silver["meta_vendedor"], as_side(star["dim_vendedor_periodo"], stored=True)
        ),
        "fato_meta_loja": lambda: facts.store_targets_fact(silver["meta_loja"]),
        "fato_custos_canal": after(
            ("custos_canal", "leads", "canais"), lambda: facts.channel_costs_fact(silver["custos_canal"], channels())
        ),
    }, state, inputs, {"_vendas": (sale_buckets, facts.SALE_KEY)} if sale_buckets else None)
    return star


def audit(
    spark: SparkSession, tables: dict[str, DataFrame], saved: dict[str, Saved], raw_sales: int
) -> tuple[DataFrame, int]:
    """The report and the number of failed checks, rows written against rows saved included.

    The checks were observed while the tables were written; only the rows saved are counted here.
    """
    counts = {name: seen.rows for name, seen in saved.items()}
    wrong = reconcile(spark, counts, tables).filter("not matches").count()
    full = observed_report(spark, saved, raw_sales).unionByName(spark.createDataFrame(
        [("saved_rows", wrong == 0, float(wrong), 0.0)], "check string, passed boolean, value double, threshold double"
    ))
    return full, full.filter("not passed").count()


class PublishError(RuntimeError):
    """Tables that do not hold what was written; readers still see the run before."""

    def __init__(self, tables: list[str]):
        super().__init__(f"published rows differ from saved rows in {tables}")
        self.tables = tables


def publish(
    spark: SparkSession, database: str, root: str, run: str, saved: dict[str, Saved]
) -> DataFrame:
    """Let the views of ``database`` read ``run``, all at once, after every cell of it was read back and checked.

    ``root`` holds the tables of all runs, ``saved`` what was seen when this one was written. If a table's rows or content
    differ, nothing is switched. The switch is one row in the manifest that all views look up; only views that
    are new, or were made for another place or layout, are made afterwards.
    """
    stored = {name: spark.read.parquet(run_path(root, name, run)) for name in saved}
    result = reconcile(spark, saved, stored)
    rows = result.collect()  # one row a table
    wrong = sorted(row["table_name"] for row in rows if not row["matches"])
    if wrong:
        raise PublishError(wrong)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    switch_run(spark, root, run)
    for name, df in stored.items():
        run_view(spark, f"{database}.{name}", root, name, df.columns)
    return spark.createDataFrame(rows, result.schema)


def publish_tables(spark: SparkSession, tables: dict[str, DataFrame], database: str) -> DataFrame:
    """Refresh catalog tables one after another, for readers that need tables; each is read back and checked."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    written = {name: refresh_table(df, f"{database}.{name}") for name, df in tables.items()}
    result = reconcile(spark, written, {name: spark.table(f"{database}.{name}") for name in tables})
    rows = result.collect()  # one row a table
    wrong = sorted(row["table_name"] for row in rows if not row["matches"])
    if wrong:
        raise PublishError(wrong)
    return spark.createDataFrame(rows, result.schema)


# A task sorts one bucket, of the sales and of what is found for them, in its memory.
SALES_A_BUCKET = 1_200_000


def buckets_of_sales(raw: Mapping[str, DataFrame], least: int) -> int:
    """``sale_buckets`` for these feeds: as many as their sales need, and ``least`` at least. Sales are counted, in Parquet by the footers alone."""
    return max(least, -(-raw["sales"].count() // SALES_A_BUCKET))


def prepare(
    spark: SparkSession, raw: Mapping[str, DataFrame], folder: str, by_date: bool = False,
    formats: dict[str, tuple[str, ...]] | str | None = None, run: str = "", resume: bool = False, sale_buckets: int = 0,
) -> tuple[Tables, Tables]:
    """Silver and gold tables under ``folder``, none of them written before it is asked for.

    With ``resume`` the named run takes up the tables that it has finished from these inputs.
    """
    folder, run = folder.rstrip("/"), run or uuid.uuid4().hex
    silver, state, inputs = f"{folder}/silver/{RUN_PREFIX}{run}", None, ""
    if resume:
        state, inputs = f"{folder}/state/{RUN_PREFIX}{run}", inputs_fingerprint(spark, raw, by_date, formats)
    conformed = conform_feeds(spark, raw, silver, formats, state, inputs, sale_buckets)
    links = raw.get("lead_links")
    return conformed, build_star(conformed, raw["seller_map"], f"{folder}/gold", links, by_date, run, state, inputs, sale_buckets)


def full_refresh(
    spark: SparkSession, raw: Mapping[str, DataFrame], folder: str, database: str | None = None,
    block_on_fail: bool = False, by_date: bool = False, formats: dict[str, tuple[str, ...]] | str | None = None,
    run: str = "", resume: bool = False, sale_buckets: int = 0,
) -> Refresh:
    """Raw feeds to audited tables under ``folder``; published when a database is named.

    ``block_on_fail`` keeps a run with failed checks from being published.  ``formats``
    names, by source, the formats of dates that arrive as text, or has them elected (``ELECT``).  All runs of a database share one ``folder``; ``run``
    names this one, and with ``resume`` a restart under the same name goes on where it ended.  Sales beyond any
    broadcast are best dealt in ``sale_buckets``, some hundred MB each: then the sales fact moves no row.
    """
    if resume and not run:
        raise ValueError("a run that can be resumed has to be named")
    run = run or uuid.uuid4().hex
    silver, star = prepare(spark, raw, folder, by_date, formats, run, resume, sale_buckets)
    silver.fetch(*silver)
    star.fetch(*TABLES)
    tables = {name: star[name] for name in TABLES}
    saved = {name: star.saved[name] for name in TABLES}
    # Conforming sales adds columns only, so the rows counted on writing are the raw ones.
    report, failures = audit(spark, tables, saved, silver.counts["vendas"])
    rates = observed_rates(spark, saved)
    published = database is not None and not (block_on_fail and failures)
    if published:
        publish(spark, database, f"{folder.rstrip('/')}/gold", run, saved)
    return Refresh(tables, {n: s.rows for n, s in saved.items()}, report, rates, failures, published, dict(silver.counts), saved, run, clean.conflicts(raw))
