"""One row per key.

Both forms are grouped aggregates, so every map task sends at most one row per
key: a key that holds a third of the table arrives as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlot.functions.scalars import col


def _winner(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    # Remaining columns break ties, which makes the result independent of partitioning.
    ranks = order + [name for name in rest if name not in order]
    best = df.groupBy(*[col(k) for k in keys]).agg(pick(F.struct(*[col(n) for n in ranks])).alias("__row"))
    wanted = [col(n) if n in keys else col("__row").getField(n).alias(n) for n in df.columns]
    return best.select(*wanted)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` per key; null keys form one group."""
    return _winner(df, keys, order, F.min)


def keep_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the largest ``order`` per key; a null date loses against any other."""
    return _winner(df, keys, order, F.max)
