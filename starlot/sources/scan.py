"""Reading landed exports: single files, yearly file sets, optional sources."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlot.functions.text import normalise_headers
from starlot.sources.contracts import LANDING_STEMS, OPTIONAL, RENAMES, REQUIRED, require_columns
from starlot.sources.layouts import group_files

FILE, BLOCK, ROW = "_file", "_block", "_row"
# Single files whose rows compete by their place.
ORDERED = {"leads", "lead_corrections", "lead_links", "appointments", "history", "stock_brands"}


def find_files(spark: SparkSession, pattern: str) -> list[tuple[str, str]]:
    """Files, or folders of part files, that match, in name order, each with its first file."""
    name = pattern.rstrip("/").rsplit("/", 1)[-1]
    match = re.sub(r"\\\*", "[^/]*", re.escape(name)).replace(r"\[", "[").replace(r"\]", "]").replace(r"\-", "-")
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern)
    except AnalysisException:
        return []
    # Only the path is asked for, so no file is read.
    named = found.select(F.regexp_extract("path", f"^(.*?/{match})(/.*)?$", 1).alias("name"), "path")
    return sorted((row["name"], row["leaf"]) for row in named.groupBy("name").agg(F.min("path").alias("leaf")).collect())


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files, or folders of part files, that match, in name order."""
    return [path for path, _ in find_files(spark, pattern)]


def read_file(
    spark: SparkSession, path: str | list[str], fmt: str = "parquet", schema: T.StructType | str | None = None,
    order: bool = False, **options: str,
) -> DataFrame:
    """One scan.  ``order`` adds where each row stands: path, block and place.

    Parquet numbers its rows.  In text files a row's place is the scan's own running
    number, which grows within a block of a file; it is taken right here, so it has to be
    written before any step reads the rows twice.
    """
    reader = spark.read.format(fmt).options(**({"header": "true"} | options if fmt == "csv" else options))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if not order:
        return df
    if fmt == "parquet":
        block, row = F.lit(0).cast("bigint"), F.col("_metadata.row_index")
    else:
        block, row = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    return df.select("*", F.col("_metadata.file_path").alias(FILE), block.alias(BLOCK), row.alias(ROW))


def read_yearly(
    spark: SparkSession, pattern: str, source: str, fmt: str = "parquet",
    rename: dict[str, str] | None = None, required: list[str] | None = None,
    found: list[tuple[str, str]] | None = None, **options: str,
) -> DataFrame:
    """All files of a yearly set as one table, with their order as ``_file``, ``_block`` and ``_row``.

    Headers are normalised and the contract is checked per layout.  Executors tell which
    files have the same columns; these go into one scan, and a union joins only the
    differing layouts, so neither jobs nor its width grow with the number of files.
    ``found`` is what ``find_files`` gave for the pattern, where the caller has it.
    """
    found = find_files(spark, pattern) if found is None else found
    if not found:
        raise FileNotFoundError(f"{source}: no file matches {pattern}")
    needed = REQUIRED.get(source, []) if required is None else required
    layouts: dict[str, list[str]] = {}
    for paths in group_files(spark, found, fmt, options):
        layouts.setdefault(read_file(spark, paths[0], fmt, **options).schema.json(), []).extend(paths)
    parts = []
    for layout, paths in layouts.items():
        schema = T.StructType.fromJson(json.loads(layout))
        part = normalise_headers(read_file(spark, paths, fmt, schema, order=True, **options))
        part = part.withColumnsRenamed(RENAMES.get(source, {}) if rename is None else rename)
        parts.append(require_columns(part, f"{source} ({paths[0]})", needed))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_optional(
    spark: SparkSession, pattern: str, fmt: str = "parquet", empty: T.StructType | None = None, **options: str
) -> DataFrame | None:
    """The source, or where no file exists an empty typed table (``None`` without a type)."""
    files = list_files(spark, pattern)
    if files:
        return read_file(spark, files, fmt, **options)
    return None if empty is None else spark.createDataFrame([], empty)


def read_landing(
    spark: SparkSession, folder: str, fmt: str = "parquet", stems: dict[str, str] | None = None, **options: str
) -> dict[str, DataFrame]:
    """All feeds of a landing folder by name; absent optional ones are left out."""
    feeds = {}
    for source, stem in {**LANDING_STEMS, **(stems or {})}.items():
        pattern = f"{folder.rstrip('/')}/{stem}.{fmt}"
        found = find_files(spark, pattern)
        if not found:
            if source in OPTIONAL:
                continue
            raise FileNotFoundError(f"{source}: no file matches {pattern}")
        if "*" in stem:
            feeds[source] = read_yearly(spark, pattern, source, fmt, found=found, **options)
        elif source == "channel_costs":
            feeds[source] = read_file(spark, pattern, fmt, **options)
        else:
            one = normalise_headers(read_file(spark, pattern, fmt, order=source in ORDERED, **options))
            feeds[source] = one.withColumnsRenamed(RENAMES.get(source, {}))
    return feeds


def read_saved(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Read a saved table back; a missing one is reported by its name."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"{source}: no table at {path}") from error
