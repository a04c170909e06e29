"""Left lookups that neither lose nor multiply rows.

A side is broadcast only after its rows and bytes were counted.  Beyond the
bound the lookup shuffles, in a shape whose skewed partitions (one hot key, all
null keys) adaptive execution can split (see ``left_lookup``).
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlot.functions.scalars import UNKNOWN, col, known_or
from starlot.functions.text import normalise_text
from starlot.session import materialise, setting, shared_folder

ROWS_SETTING = "starlot.broadcast.maxRows"
BYTES_SETTING = "starlot.broadcast.maxBytes"
MAX_ROWS = 1_000_000
MAX_BYTES = 64 * 1024 * 1024


class Side(NamedTuple):
    """The right side of a lookup, unique on its key, with its size verdict.

    ``dropped`` counts the rows that fell together with another of their key, ``conflicting`` the keys for
    which these rows differed; both are known for code maps.
    """

    df: DataFrame
    small: bool
    dropped: int = 0
    conflicting: int = 0


def row_bytes(schema: T.StructType) -> Column:
    """Estimated in-memory bytes of a row: 16 per field plus the length of texts."""
    size = F.lit(16 * len(schema.fields))
    for field in schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(col(field.name)), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType)):
            raise TypeError(f"no size bound for nested column {field.name}")
    return size


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of ``df`` from one distributed aggregate."""
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df.schema)).alias("b")).first()
    return found["n"], found["b"] or 0


def as_side(side: DataFrame | Side, stored: bool = False) -> Side:
    """``side`` with its size; pass the result on where several lookups share it.

    A side that is computed is written once, rows and bytes observed on the way, and
    read from there; ``stored`` tables are only counted.
    """
    if isinstance(side, Side):
        return side
    spark = side.sparkSession
    if stored:
        rows, size = measure(side)
    else:
        seen = Observation()
        totals = F.count(F.lit(1)).alias("n"), F.sum(row_bytes(side.schema)).alias("b")
        side = materialise(side.observe(seen, *totals), shared_folder(spark, "side"), compact=True)
        rows, size = seen.get["n"], seen.get["b"] or 0
    fits = rows <= setting(spark, ROWS_SETTING, MAX_ROWS) and size <= setting(spark, BYTES_SETTING, MAX_BYTES)
    return Side(side, fits)


def _same_types(facts: DataFrame, side: DataFrame, on: dict[str, str]) -> dict[str, str]:
    """Common key type per fact column; text never meets number silently."""
    kinds = {}
    for left, right in on.items():
        a, b = facts.schema[left].dataType, side.schema[right].dataType
        if a != b and not (isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType)):
            raise TypeError(f"lookup key {left} is {a.simpleString()}, {right} is {b.simpleString()}")
        kinds[left] = "bigint" if a != b else a.simpleString()
    return kinds


def left_lookup(
    facts: DataFrame,
    side: DataFrame | Side,
    on: dict[str, str],
    take: dict[str, str],
    null_safe: bool = False,
) -> DataFrame:
    """Add columns of ``side`` to ``facts``; unmatched rows get nulls.

    ``on`` pairs fact columns with side columns, ``take`` names the output of each
    side column (an existing fact column of that name is replaced).  ``side`` must
    be unique on its key.

    Small side: broadcast hash join, the facts do not move.  Large side: one shuffle
    join on the key and its hash.  The hash adds nothing to the match, but a join on
    both cannot reuse a partitioning by the key alone, such as that of a side just
    deduplicated.  So both inputs are plain shuffles, the only shape in which adaptive
    execution splits a partition that one hot key, or the null key, has filled.
    """
    if isinstance(side, DataFrame):
        side = as_side(side.select(*[col(name) for name in dict.fromkeys([*on.values(), *take])]))
    kinds = _same_types(facts, side.df, on)
    # Two copies, since join and output may use the same side column.
    joined_keys = [f"__key{i}" for i in range(len(on))]
    right = side.df.select(
        *[col(name).cast(kinds[left]).alias(key) for key, (left, name) in zip(joined_keys, on.items())],
        *[col(name).alias(f"__take{i}") for i, name in enumerate(take)],
    )
    if not null_safe:
        right = right.dropna(subset=joined_keys)
    left_keys = [col(left).cast(kinds[left]) for left in on]
    pairs = [
        a.eqNullSafe(col(b)) if null_safe else a == col(b) for a, b in zip(left_keys, joined_keys)
    ]
    condition = reduce(lambda a, b: a & b, pairs)

    if side.small:
        joined = facts.join(F.broadcast(right), condition, "left")
    else:
        same_hash = F.hash(*left_keys) == F.hash(*[col(key) for key in joined_keys])
        # Spark would still broadcast a side whose files are small; sorted rows take a small part of their memory there.
        joined = facts.join(right.hint("merge"), condition & same_hash, "left")

    outputs = list(take.values())
    return joined.select(
        *[col(name) for name in facts.columns if name not in outputs],
        *[col(f"__take{i}").alias(name) for i, name in enumerate(outputs)],
    )


def lookup_key(
    facts: DataFrame, side: DataFrame | Side, on: dict[str, str], key: str, out: str, null_safe: bool = False
) -> DataFrame:
    """``left_lookup`` of one surrogate key with the unknown member for no match."""
    kind = (side.df if isinstance(side, Side) else side).schema[key].dataType.simpleString()
    found = left_lookup(facts, side, on, {key: out}, null_safe)
    return found.withColumn(out, known_or(col(out), kind))


def code_map_side(mapping: DataFrame, origin: str, target: str, strict: bool = False) -> Side:
    """A code map with both columns normalised and one row per origin.

    The first target in alphabetical order stays where two origins normalise alike,
    so a map can never multiply facts; ``strict`` refuses such a map instead.
    """
    seen = Observation()
    grouped = _by_origin(mapping, origin, target).observe(
        seen, F.coalesce(F.sum(F.col("map_rows") - 1), F.lit(0).cast("bigint")).alias("dropped"), F.count_if(F.col("target") != F.col("last")).alias("conflicting")
    )
    side = as_side(grouped.select("origin", "target"))
    side = side._replace(dropped=seen.get["dropped"], conflicting=seen.get["conflicting"])
    if strict and side.conflicting:
        some = map_conflicts(mapping, origin, target).orderBy("origin").limit(5).collect()
        raise ValueError(f"several targets for {[row['origin'] for row in some]}")
    return side


def _by_origin(mapping: DataFrame, origin: str, target: str) -> DataFrame:
    """``(origin, target, last, map_rows)``: per normalised origin its first and last target and its number of rows."""
    clean = mapping.select(
        normalise_text(col(origin)).alias("origin"), normalise_text(col(target)).alias("target")
    )
    return clean.groupBy("origin").agg(F.min("target").alias("target"), F.max("target").alias("last"), F.count(F.lit(1)).alias("map_rows"))


def map_conflicts(mapping: DataFrame, origin: str, target: str) -> DataFrame:
    """``(origin, kept, map_rows, targets)`` of the origins whose rows name several targets, of which one is kept."""
    clean = mapping.select(normalise_text(col(origin)).alias("origin"), normalise_text(col(target)).alias("target"))
    # Counted by target first, so that an origin with very many rows is combined before it is gathered.
    each = clean.groupBy("origin", "target").agg(F.count(F.lit(1)).alias("n"))
    found = each.groupBy("origin").agg(F.min("target").alias("kept"), F.sum("n").alias("map_rows"), F.count(F.lit(1)).alias("targets"))
    return found.where("targets > 1")


def apply_code_map(facts: DataFrame, column: str, mapping: Side) -> DataFrame:
    """Normalise ``column`` and replace it by its mapped code where the map has one."""
    clean = facts.withColumn(column, normalise_text(col(column)))
    found = left_lookup(clean, mapping, {column: "origin"}, {"target": "__mapped"})
    mapped = found.withColumn(column, F.coalesce(F.col("__mapped"), col(column)))
    return mapped.select(*[col(name) for name in facts.columns])


def unmatched(facts: DataFrame, side: DataFrame, on: dict[str, str]) -> DataFrame:
    """Distinct fact keys, null excluded, that ``side`` does not hold."""
    keys = list(on)
    missing = facts.select(*[col(k) for k in keys]).dropna().distinct()
    right = side.select(*[col(s).alias(f"__key{i}") for i, s in enumerate(on.values())])
    condition = reduce(lambda a, b: a & b, [col(k) == col(f"__key{i}") for i, k in enumerate(keys)])
    return missing.join(right, condition, "left_anti")


def unknown_member(dim: DataFrame, **values: object) -> DataFrame:
    """Append one sentinel row; columns not named are null."""
    names = [name for name in dim.columns if name in values]
    schema = T.StructType([T.StructField(n, dim.schema[n].dataType) for n in names])
    row = dim.sparkSession.createDataFrame([tuple(values[n] for n in names)], schema)
    return dim.unionByName(row, allowMissingColumns=True)


__all__ = [
    "Side", "UNKNOWN", "apply_code_map", "as_side", "code_map_side", "left_lookup", "lookup_key",
    "map_conflicts", "measure", "unknown_member", "unmatched",
]
