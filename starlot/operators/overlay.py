"""Corrections that replace rows, and values filled from several sources by priority."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlot.functions.scalars import col
from starlot.operators.lookup import Side, as_side, left_lookup
from starlot.session import materialise, shared_folder


def overlay(base: DataFrame, corrections: DataFrame, key: str) -> DataFrame:
    """``base`` without the rows whose key was corrected, plus all corrections.

    Corrections with a null key are added and replace nothing.
    """
    corrections = materialise(corrections, shared_folder(corrections.sparkSession, "corrections"), compact=True)
    side = as_side(corrections.select(col(key).alias("__id")).dropna().distinct())
    # The written ids reach a shuffle join by a shuffle of their own, which leaves skewed
    # partitions of the base to be split.
    ids = F.broadcast(side.df) if side.small else side.df
    kept = base.join(ids, col(key) == F.col("__id"), "left_anti")
    return kept.unionByName(corrections, allowMissingColumns=True)


def fill_by_priority(
    base: DataFrame, key: str, out: str, sources: list[tuple[DataFrame | Side, str, str]], default: str
) -> DataFrame:
    """``out`` from the first source that has a value for the row's key, else ``default``.

    Each source is ``(frame unique on its key, key column, value column)``.
    """
    found = base
    for i, (source, source_key, value) in enumerate(sources):
        found = left_lookup(found, source, {key: source_key}, {value: f"__candidate{i}"})
    candidates = [F.col(f"__candidate{i}") for i in range(len(sources))]
    return found.select(
        *[col(name) for name in base.columns if name != out],
        F.coalesce(*candidates, F.lit(default)).alias(out),
    )
