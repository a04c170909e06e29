"""Writing tables: saves with observed rows, content and metrics; publishing runs; reconciliation."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starlot.functions.scalars import col
from starlot.session import releasing_shuffles, table_codec

# Published tables hold one folder per run, ``run=r-...``; the prefix keeps the value a text whatever the run is called.
RUN, RUN_PREFIX, MANIFEST = "run", "r-", "published"


class Saved(NamedTuple):
    """What was seen of a table while it was written."""

    rows: int
    content: str
    metrics: dict[str, object]


def content_columns(df: DataFrame) -> list[Column]:
    """Rows and an order-free checksum: the exclusive or of all rows' hashes, and the sum of their upper bits.

    Equal rows cancel in the first part and not in the second, which cannot overflow below 2**39 rows.
    """
    row = F.xxhash64(*[col(name) for name in df.columns])
    return [
        F.count(F.lit(1)).alias("__rows"), F.coalesce(F.bit_xor(row), F.lit(0).cast("bigint")).alias("__xor"),
        F.coalesce(F.sum(F.shiftrightunsigned(row, 40)), F.lit(0).cast("bigint")).alias("__sum"),
    ]


def _content(seen: Mapping[str, int]) -> str:
    return f"{seen['__xor'] & (2**64 - 1):016x}{seen['__sum']:016x}"


def save_counted(
    df: DataFrame, path: str, metrics: list[Column] | None = None, table: str | None = None, buckets: tuple[int, str] | None = None
) -> Saved:
    """Overwrite ``path``; rows, content and the named aggregates are observed while writing, without a second pass.

    With ``buckets``, a number and a key column, the files are dealt and sorted by the key, one file a bucket, and
    ``table`` names them in the catalog: tables so written with one number join on that key as they lie.
    """
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    counted = df.observe(seen, *content_columns(df), *(metrics or []))
    spark = df.sparkSession
    with releasing_shuffles(spark):
        if buckets is None:
            counted.write.mode("overwrite").option("compression", table_codec(spark)).parquet(path)
        else:
            number, key = buckets
            writer = counted.repartition(number, key).write.mode("overwrite").format("parquet").option("path", path)
            writer.option("compression", table_codec(spark)).bucketBy(number, key).sortBy(key).saveAsTable(table)
    got = seen.get
    return Saved(int(got["__rows"]), _content(got), {k: v for k, v in got.items() if not k.startswith("__")})


def refresh_table(df: DataFrame, table: str) -> Saved:
    """Full refresh of a catalog table: created if missing, else its rows are replaced.

    An existing table keeps its definition, so readers' grants and column order stay.
    Written with few checks of its own: audit first (see ``plans.refresh``).
    """
    spark = df.sparkSession
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    counted = df.observe(seen, *content_columns(df))
    if spark.catalog.tableExists(table):
        counted.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    else:
        counted.write.format("parquet").saveAsTable(table)
    return Saved(int(seen.get["__rows"]), _content(seen.get), {})


def run_path(root: str, name: str, run: str) -> str:
    """Folder of one table of one run; readers see it once the run is the published one."""
    return f"{root.rstrip('/')}/{name}/{RUN}={RUN_PREFIX}{run}"


def current_run(spark: SparkSession, root: str) -> str | None:
    """The run that readers of ``root`` see."""
    try:
        found = spark.read.parquet(f"{root.rstrip('/')}/{MANIFEST}").agg(F.max_by(RUN, "at")).first()[0]
    except AnalysisException:
        return None
    return found and found.removeprefix(RUN_PREFIX)


def switch_run(spark: SparkSession, root: str, run: str) -> None:
    """Let all views below ``root`` read ``run``: one row in one new file of the manifest, which is there or not.

    The file has a folder of its own, so that publishers do not meet; the latest row counts.
    """
    row = spark.range(1, numPartitions=1).select(F.lit(RUN_PREFIX + run).alias(RUN), F.current_timestamp().alias("at"))
    row.write.parquet(f"{root.rstrip('/')}/{MANIFEST}/entry=e-{uuid.uuid4().hex}")


def run_view(spark: SparkSession, view: str, root: str, name: str, columns: list[str]) -> bool:
    """A view of one table in the published run, whichever that is; false if it was there already.

    The run is looked up when a query is planned and prunes the table's folders to one, so a
    switch needs no change of any view.
    """
    root = root.rstrip("/")
    listed = ", ".join(f"`{c}`" for c in columns)
    text = f"SELECT {listed} FROM parquet.`{root}/{name}` WHERE {RUN} = (SELECT max_by({RUN}, at) FROM parquet.`{root}/{MANIFEST}`)"
    if spark.catalog.tableExists(view):
        known = spark.sql(f"DESCRIBE TABLE EXTENDED {view}").filter("col_name = 'View Text'").first()
        if known is not None and known["data_type"] == text:
            return False
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {text}")
    return True


def refresh_jdbc(df: DataFrame, url: str, table: str, **properties: str) -> None:
    """Full refresh of a database table; truncates in place so its definition stays."""
    df.write.mode("overwrite").option("truncate", "true").jdbc(url, table, properties=properties)


def reconcile(spark: SparkSession, expected: Mapping[str, int | Saved], saved: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, expected_rows, saved_rows, same_content, matches)``; a table not saved counts as null.

    Content is compared where it was observed on writing: every cell is read back then. Where only rows
    were counted, ``same_content`` is null and rows alone decide.
    """
    plan = spark.createDataFrame(
        [(n, s.rows, s.content) if isinstance(s, Saved) else (n, s, None) for n, s in expected.items()],
        "table_name string, expected_rows bigint, __content string",
    )
    read = None
    for name, df in saved.items():
        whole = isinstance(expected.get(name), Saved)
        columns = content_columns(df) if whole else [F.count(F.lit(1)).alias("__rows")]
        text = F.lower(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("__xor", "__sum")])) if whole else F.lit(None).cast("string")
        one = df.agg(*columns).select(F.lit(name).alias("table_name"), F.col("__rows").alias("saved_rows"), text.alias("__read"))
        read = one if read is None else read.unionByName(one)
    if read is None:
        read = spark.createDataFrame([], "table_name string, saved_rows bigint, __read string")
    same = F.when(F.col("__content").isNotNull() & F.col("saved_rows").isNotNull(), F.col("__content") == F.col("__read"))
    found = plan.join(F.broadcast(read), "table_name", "left").withColumn("same_content", same)
    matches = (F.col("expected_rows") == F.col("saved_rows")) & F.coalesce("same_content", F.lit(True))
    return found.withColumn("matches", F.coalesce(matches, F.lit(False))).drop("__content", "__read")
