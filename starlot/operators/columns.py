"""Projections that tolerate absent columns, and columns found by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlot.functions.scalars import col


_KINDS = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def layout(columns: str) -> T.StructType:
    """A flat schema from ``"name type, name type"``; needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns and types of ``schema``; an absent column is a typed null."""
    have = set(df.columns)
    return df.select(
        *[
            (col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def keep_present(df: DataFrame, names: list[str]) -> DataFrame:
    """Those of ``names`` that exist, in that order."""
    have = set(df.columns)
    return df.select(*[col(n) for n in names if n in have])


def first_with_prefix(df: DataFrame, prefix: str) -> str | None:
    return next((name for name in df.columns if name.startswith(prefix)), None)
