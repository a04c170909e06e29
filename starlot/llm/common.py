"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Separators of words in the contracts: [\x20\x09-\x0D].
OTHER_SPACE = "\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def one_space(text: Column) -> Column:
    """Every separator of words becomes a blank."""
    return F.translate(text, OTHER_SPACE, " " * len(OTHER_SPACE))


def words(text: Column) -> Column:
    """Runs of characters outside [\\x20\\x09-\\x0D]; none for an empty text."""
    return F.filter(F.split(one_space(text), " ", -1), lambda w: w != "")


def windows(size: Column, width: int) -> Column:
    """Start positions (from 0) of all windows of ``width``; empty if there is no such window."""
    starts = F.sequence(F.lit(0), size - F.lit(width))
    return F.when(size >= F.lit(width), starts).otherwise(F.array().cast("array<int>"))


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """All columns of ``docs`` inside ``_row`` beside the given key columns, so that no name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[v.alias(k) for k, v in keys.items()])


def unpacked(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The columns packed above, with some replaced."""
    return df.select(*[replaced.get(c, F.col("_row").getField(c)).alias(c) for c in columns])


def sql_crc32(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of an ASCII text, bit by bit with the reflected polynomial (a fixed value)."""
    codes = f"list_transform(list_filter(string_split({text}, ''), lambda c: c <> ''), lambda c: CAST(ord(c) AS BIGINT))"
    bits = "list_reduce(list_concat([xor(a, b)], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda a, b: {bits}), 4294967295)"
