"""Dense surrogate keys by first appearance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starlot.functions.scalars import col
from starlot.session import materialise, shared_folder


def first_appearance(df: DataFrame, values: list[str], order: list[str]) -> DataFrame:
    """Distinct members with the smallest ``__position`` at which each occurs."""
    position = F.struct(*[col(n) for n in order]) if order else F.struct(*[col(n) for n in values])
    return df.groupBy(*[col(v) for v in values]).agg(F.min(position).alias("__position"))


def one_after_another(*members: DataFrame) -> DataFrame:
    """Members of several sources as one: those of an earlier source come first, each by its place there."""
    kinds = [m.schema["__position"].dataType for m in members]
    parts = []
    for i, one in enumerate(members):
        places = [col("__position") if j == i else F.lit(None).cast(kind) for j, kind in enumerate(kinds)]
        position = F.struct(F.lit(i).alias("source"), *[p.alias(f"place{j}") for j, p in enumerate(places)])
        parts.append(one.withColumn("__position", position))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    values = [n for n in whole.columns if n != "__position"]
    return whole.groupBy(*[col(v) for v in values]).agg(F.min("__position").alias("__position"))


def dense_keys(members: DataFrame, out: str, tie: list[str], start: int = 1, kind: str = "bigint") -> DataFrame:
    """Number members ``start, start+1, ...`` by ``__position``, which is then dropped.

    Members are dealt out by ranges of their position, sorted, and written once with range and place in it;
    a key is the place plus the sizes of the ranges before, which one aggregate counts exactly.  There are as many ranges as the shuffle has
    partitions, so the work of a task does not grow with the number of members; few members are one range.
    """
    ranked = members.withColumn("__at", F.struct("__position", *[col(t) for t in tie]))
    placed = ranked.repartitionByRange("__at").sortWithinPartitions("__at").withColumn("__id", F.monotonically_increasing_id())
    # The id holds the partition above bit 33 and the row's place below.
    written = materialise(
        placed.withColumns({"__range": F.shiftright("__id", 33), "__place": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("__at", "__position", "__id"),
        shared_folder(members.sparkSession, "ranges"),
    )
    sizes = written.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    # One row a range here, so one small task and a small broadcast.
    before = sizes.select("__range", (F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).alias("__before"))
    key = F.col("__before") + F.col("__place") + F.lit(start)
    return written.join(F.broadcast(before), "__range").withColumn(out, key.cast(kind)).drop("__range", "__place", "__before")


def surrogate_keys(df: DataFrame, value: str, out: str, order: list[str] | None = None, kind: str = "bigint") -> DataFrame:
    """``(value, out)``: one dense key per distinct value, a null value included.

    Numbered by first appearance in ``order``, or alphabetically without one.
    """
    return dense_keys(first_appearance(df, [value], order or []), out, [value], kind=kind).select(col(value), col(out))
