"""Point-in-time lookup in validity periods, and expansion of periods to months."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlot.functions.scalars import UNKNOWN, col, known_or, month_key
from starlot.operators.dedup import keep_first
from starlot.operators.lookup import BYTES_SETTING, MAX_BYTES, MAX_ROWS, ROWS_SETTING
from starlot.session import materialise, setting, shared_folder

# Fixed value: the last day of a period without an end.
OPEN_END = "2099-12-31"

PERIODS_SETTING = "starlot.periods.maxPerKey"
MAX_PERIODS_PER_KEY = 512
HISTORY_ROWS_SETTING = "starlot.periods.maxRows"
MAX_HISTORY_ROWS = 250_000
SEGMENT_BYTES = 64
# Segments that one node of a large history's search tree holds: an event compares itself with these at most.
FANOUT_SETTING = "starlot.periods.fanout"
FANOUT = 512
# Parts over which events without a key, or of the unknown one, are dealt.
SPREAD = 256
TREE_LEVEL = 1 << 48
# Rows that a task makes of others, which are too few for their bytes to spread them.
PERIODS_PER_TASK, ASKS_PER_TASK, MONTHS_PER_TASK = 10_000, 500_000, 500_000
DAY_MICROSECONDS = 86_400_000_000
# Levels of the tree over time: a day has fewer than 2**37 microseconds; whole days cover 1,400 years before and after 1970.
CLOCK_LEVELS, DAY_LEVELS = 37, 20


def validity_periods(
    history: DataFrame, key: str, value: str, start: str, end: str, by_date: bool = False
) -> DataFrame:
    """``(key, since, until, value)`` with closed ends and open ends filled.

    ``by_date`` lets a period run to the close of its last day; otherwise an end
    stored as midnight excludes the rest of that day.
    """
    since = col(start).cast("timestamp_ntz")
    until = F.coalesce(col(end).cast("timestamp_ntz"), F.lit(OPEN_END).cast("timestamp_ntz"))
    if by_date:
        since = F.date_trunc("day", since).cast("timestamp_ntz")
        until = F.date_trunc("day", until).cast("timestamp_ntz")
    return history.select(
        col(key).cast("bigint").alias("key"), since.alias("since"), until.alias("until"),
        col(value).cast("bigint").alias("value"),
    ).filter("key is not null and since <= until")


def _ranked(periods: DataFrame) -> DataFrame:
    """Latest start wins, then latest end, then highest value."""
    return periods.withColumn("rank", F.struct("since", "until", "value"))


def disjoint_segments(periods: DataFrame) -> DataFrame:
    """``(key, since, before, value)`` without overlaps, for histories whose periods per key were counted.

    The covering piece of highest rank owns a moment.  Ownership can change only where a
    piece starts or just after one ends, so those moments bound the segments.  Gathers
    the pieces of a key in one row.
    """
    tick = F.expr("interval 1 microsecond")
    owner = lambda at: F.array_max(
        F.filter("spans", lambda s: (s["since"] <= at) & (s["until"] >= at))
    )
    gathered = _ranked(periods).groupBy("key").agg(F.collect_set(F.struct("rank", "since", "until")).alias("spans"))
    cuts = F.array_sort(
        F.array_distinct(
            F.concat(
                F.transform("spans", lambda s: s["since"]),
                F.transform("spans", lambda s: s["until"] + tick),
            )
        )
    )
    return (
        gathered.withColumn("cuts", cuts)
        .select("key", "spans", "cuts", F.posexplode("cuts").alias("i", "at"))
        .select(
            "key", F.col("at").alias("since"), F.get("cuts", F.col("i") + 1).alias("before"),
            owner(F.col("at")).alias("span"),
        )
        .filter("span is not null")
        .select("key", "since", "before", F.col("span.rank.value").alias("value"))
    )


def _clock(at: Column) -> tuple[Column, Column]:
    """Day (from a base long past) and microsecond of the day of a timestamp without zone."""
    day = F.unix_date(at.cast("date")) + F.lit(1 << (DAY_LEVELS - 1))
    second = F.date_part(F.lit("SECOND"), at)
    return day.cast("bigint"), ((F.hour(at) * 3600 + F.minute(at) * 60).cast("bigint") * 1_000_000 + (second * 1_000_000).cast("bigint"))


def _in_day(day: Column, level: Column, index: Column) -> Column:
    """Number of a node within a day: the day, then the node's place in a binary heap."""
    return day * F.lit(1 << (CLOCK_LEVELS + 1)) + F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(CLOCK_LEVELS) - level) + index


def _of_days(level: Column, index: Column) -> Column:
    """Number of a node over whole days: negative, so that it meets none within a day."""
    return -(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(DAY_LEVELS) - level) + index)


def _cover(lo: Column, hi: Column, levels: int, shift: int, number: Callable[[Column, Column], Column]) -> Column:
    """The fewest nodes of a binary tree that make up ``[lo, hi)``: two a level at most, ``(level, node)``."""
    one = F.lit(1).cast("bigint")

    def at(level: Column) -> Column:
        left = F.call_function("shiftright", lo + F.call_function("shiftleft", one, level) - 1, level)
        right = F.call_function("shiftright", hi, level)
        pick = lambda odd, index: F.when(
            (left < right) & (odd % 2 == 1), F.struct((level + shift).alias("level"), number(level, index).alias("node"))
        )
        return F.array(pick(left, left), pick(right, right - 1))

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), at))
    return F.filter(every, lambda x: x.isNotNull())


def interval_nodes(periods: DataFrame) -> DataFrame:
    """``(key, level, node, rank)``: for any history, the best period of each node of a binary tree over time.

    A period is cut into the O(log n) largest nodes that make it up: binary fractions of its first and
    last day, and powers of two of whole days between.  Of all periods that hold a node only the best
    can ever be asked for, so a node has one row, found by an aggregate that combines before it shuffles.
    """
    first, from_ = _clock(F.col("since"))
    last, upto = _clock(F.col("until"))
    whole = F.lit(DAY_MICROSECONDS).cast("bigint")
    cut = periods.select("*", first.alias("d0"), from_.alias("m0"), last.alias("d1"), (upto + 1).alias("m1"))
    d0, d1, m0, m1 = (F.col(n) for n in ("d0", "d1", "m0", "m1"))
    none = F.array().cast("array<struct<level:int,node:bigint>>")
    within = lambda day, lo, hi: _cover(lo, hi, CLOCK_LEVELS, 0, lambda level, index: _in_day(day, level, index))
    full = (d0 == d1) & (m0 == 0) & (m1 == whole)
    # A part that runs to midnight may as well run past it: no moment of that day is later.
    head = F.when(d0 == d1, m1).otherwise(F.lit(1 << CLOCK_LEVELS).cast("bigint"))
    nodes = F.concat(
        F.when(((d0 < d1) & (m0 > 0)) | ((d0 == d1) & ~full), within(d0, m0, head)).otherwise(none),
        F.when((d0 < d1) & (m1 < whole), within(d1, F.lit(0).cast("bigint"), m1)).otherwise(none),
        F.when((d0 < d1) | full, _cover(
            d0 + (m0 > 0).cast("bigint"), d1 + (m1 == whole).cast("bigint"), DAY_LEVELS, CLOCK_LEVELS, _of_days
        )).otherwise(none),
    )
    # No node is null; the outer form only keeps the optimizer from making the nodes once more, to see whether there are any.
    each = _ranked(cut.withColumn("nodes", nodes)).select("key", "rank", F.inline_outer("nodes"))
    return each.groupBy("key", "level", "node").agg(F.max("rank").alias("rank"))


def _asked(day: Column, clock: Column, level: int) -> Column:
    """The node of one level that holds a moment."""
    if level < CLOCK_LEVELS:
        return _in_day(day, F.lit(level), F.shiftright(clock, level))
    return _of_days(F.lit(level - CLOCK_LEVELS), F.shiftright(day, level - CLOCK_LEVELS))


def _sizes(periods: DataFrame) -> tuple[int, int]:
    """All periods, and those of the fullest key."""
    found = periods.groupBy("key").count().agg(F.sum("count").alias("n"), F.max("count").alias("most")).first()
    return found["n"] or 0, found["most"] or 0


def _fits_in_memory(periods: DataFrame, total: int, most: int) -> bool:
    """True if all periods, those of the fullest key, and their segments are within the bounds.

    A key with n periods has 2n cuts and so fewer than 2n segments, which bounds the
    broadcast without evaluating them.
    """
    spark = periods.sparkSession
    return (
        total <= setting(spark, HISTORY_ROWS_SETTING, MAX_HISTORY_ROWS)
        and most <= setting(spark, PERIODS_SETTING, MAX_PERIODS_PER_KEY)
        and 2 * total <= setting(spark, ROWS_SETTING, MAX_ROWS)
        and 2 * total * SEGMENT_BYTES <= setting(spark, BYTES_SETTING, MAX_BYTES)
    )


class PeriodSide(NamedTuple):
    """A history prepared for ``value_at``; ``depth`` is that of its search tree where it is not small."""

    df: DataFrame
    small: bool
    depth: int = 0


def period_side(
    history: DataFrame, key: str, value: str, start: str = "data_inicio", end: str = "data_fim",
    by_date: bool = False, small: bool | None = None,
) -> PeriodSide:
    """A history prepared for ``value_at``; the size check is done here, once, unless ``small`` tells.

    Small: broadcastable disjoint segments.  Otherwise a search tree over disjoint segments, written once; these
    are gathered key by key if no key is full, else found by the nodes of a tree over time.
    """
    periods = validity_periods(history, key, value, start, end, by_date)
    if small:
        return PeriodSide(disjoint_segments(periods), True)
    total, most = _sizes(periods)
    if small is None and _fits_in_memory(periods, total, most):
        return PeriodSide(disjoint_segments(periods), True)
    gathers = small is None and most <= setting(history.sparkSession, PERIODS_SETTING, MAX_PERIODS_PER_KEY)
    return _search_tree(disjoint_segments(periods) if gathers else segments_by_nodes(periods, total, most))


def segments_by_nodes(periods: DataFrame, total: int, most: int) -> DataFrame:
    """``disjoint_segments`` for any history: every moment at which an owner can change asks the nodes who owns it.

    ``total`` and ``most`` are the rows of the history and of its fullest key. Rows become many more here, so
    tasks are dealt by number, not by the bytes of the history.
    """
    spark = periods.sparkSession
    folder = shared_folder(spark, "nodes")
    together = ["key"] if most <= PERIODS_PER_TASK else ["key", "since", "until"]
    periods = periods.repartition(total // PERIODS_PER_TASK + 1, *together)
    nodes = materialise(interval_nodes(periods), f"{folder}/nodes")
    # At most one row a level, so some sixty.
    levels = sorted(row["level"] for row in nodes.select("level").distinct().collect())
    ends = F.explode(F.array(F.col("since"), F.col("until") + F.expr("interval 1 microsecond"))).alias("at")
    cuts = materialise(periods.select("key", ends).distinct(), f"{folder}/cuts")
    if not levels:
        return cuts.select("key", F.col("at").alias("since"), F.col("at").alias("before"), F.lit(None).cast("bigint").alias("value")).limit(0)
    answers = _answers(cuts.select(F.col("key").alias("who"), "at"), nodes, levels, 2 * total * len(levels) // ASKS_PER_TASK + 1)
    owned = cuts.join(answers, (F.col("key") == F.col("__key")) & (F.col("at") == F.col("__moment")), "left")
    # Ownership is told apart from a value that is null.
    next_cut = F.lead("at").over(Window.partitionBy("key").orderBy("at"))
    timed = owned.select("key", F.col("at").alias("since"), next_cut.alias("before"), F.col("__value").alias("value"), F.col("__key").isNotNull().alias("owned"))
    return timed.where("owned").drop("owned")


def _search_tree(segments: DataFrame) -> PeriodSide:
    """``(key, node, since, before, value, child)``: a key's segments in order, ``FANOUT`` to a node, the root being node 0.

    An entry of a leaf has a value, one above has the node below it.  Keys with few segments have a root only.
    """
    spark = segments.sparkSession
    fanout, folder = setting(spark, FANOUT_SETTING, FANOUT), shared_folder(spark, "tree")
    place = F.row_number().over(Window.partitionBy("key").orderBy("since")) - 1
    ranked = materialise(segments.withColumn("i", place.cast("bigint")), f"{folder}/ranked")
    sizes = ranked.where(F.col("i") >= fanout).groupBy("key").agg((F.max("i") + 1).alias("n"))
    most = sizes.agg(F.max("n")).first()[0] or 0
    depth = 1
    while fanout**depth < most:
        depth += 1
    none = F.lit(None).cast("bigint")
    if depth == 1:
        return PeriodSide(ranked.select("key", F.lit(0).cast("bigint").alias("node"), "since", "before", "value", none.alias("child")), False, 1)
    height = reduce(lambda h, level: h.when(F.col("n") > fanout**level, level + 1), range(depth - 1, 0, -1), F)
    sized = ranked.join(sizes.select(F.col("key").alias("s_key"), height.otherwise(1).alias("h")), F.col("key") == F.col("s_key"), "left")
    sized = sized.withColumn("h", F.coalesce("h", F.lit(1))).drop("s_key")
    levels = []
    for level in range(depth):
        step = fanout**level
        here = sized.where(F.col("h") > level)
        if level:
            here = here.groupBy("key", "h", F.floor(F.col("i") / step).alias("j")).agg(F.min("since").alias("since"), F.max("before").alias("before"))
            here = here.select("*", none.alias("value"), (F.lit(level * TREE_LEVEL) + F.col("j")).alias("child"))
        else:
            here = here.withColumnRenamed("i", "j").withColumn("child", none)
        node = F.when(F.col("h") == level + 1, F.lit(0)).otherwise(F.lit((level + 1) * TREE_LEVEL) + F.floor(F.col("j") / fanout))
        levels.append(here.select("key", node.cast("bigint").alias("node"), "since", "before", "value", "child"))
    return PeriodSide(materialise(reduce(DataFrame.unionByName, levels), f"{folder}/tree"), False, depth)


def value_at(
    events: DataFrame, side: PeriodSide, key: str, at: str, out: str, by_date: bool = False,
    default: int = UNKNOWN,
) -> DataFrame:
    """The value whose period covers each event's time; ``default`` where none does.

    Every event comes back exactly once.  Small history: one broadcast hash join against
    disjoint segments.  Large history: one shuffle join on the key for each level of the search tree, of which
    there is one unless a key has more than ``FANOUT`` segments; an event meets the entries of one node there, whose times
    do not overlap.  Events without a key, or of the unknown one, and those whose search has ended are dealt over
    ``SPREAD`` parts, so that no task gets them all; a hot key is left to adaptive execution.
    """
    moment = col(at).cast("timestamp_ntz")
    if by_date:
        moment = F.date_trunc("day", moment).cast("timestamp_ntz")
    timed = events.withColumn("__who", col(key).cast("bigint")).withColumn("__at", moment)
    names = [col(name) for name in events.columns if name != out]
    if side.small:
        found = side.df.select(
            F.col("key").alias("__key"), F.col("since").alias("__since"), F.col("before").alias("__before"), F.col("value").alias("__value"),
        )
        placed = timed.join(F.broadcast(found), (F.col("__who") == F.col("__key")) & _covers(), "left")
        return placed.select(*names, known_or(F.col("__value"), "bigint", default).alias(out))
    found = side.df.withColumn("__of", F.explode(F.when(F.col("key") == default, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))))
    found = found.select("__of", *[F.col(name).alias(f"__{name}") for name in ("key", "node", "since", "before", "value", "child")])
    placed = timed.withColumn("__found", F.lit(None).cast("bigint")).withColumn("__next", F.lit(0).cast("bigint"))
    plain = [col(n.name) for n in events.schema if not isinstance(n.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    for _ in range(side.depth):
        # Nothing to look for: a null that meets no entry, on a part by the rest of the row.
        lost = F.col("__who").isNull() | F.col("__at").isNull() | F.col("__next").isNull()
        own = placed.withColumn("__part", F.when(lost | (F.col("__who") == default), F.pmod(F.xxhash64(*plain), F.lit(SPREAD)).cast("int")).otherwise(0))
        same = (F.col("__who") == F.col("__key")) & (F.col("__part") == F.col("__of")) & (F.col("__next") == F.col("__node"))
        met = own.join(found, same & _covers(), "left")
        placed = met.select(*[col(n) for n in events.columns], "__who", "__at", F.coalesce("__found", "__value").alias("__found"), F.col("__child").alias("__next"))
    return placed.select(*names, known_or(F.col("__found"), "bigint", default).alias(out))


def _covers() -> Column:
    return (F.col("__at") >= F.col("__since")) & (F.col("__at") < F.col("__before"))


def _answers(asking: DataFrame, nodes: DataFrame, levels: list[int], tasks: int) -> DataFrame:
    """``(__key, __moment, __value)`` of the distinct ``(who, at)`` that a period covers, a node of each level being asked."""
    day, clock = _clock(F.col("at"))
    asks = asking.select("who", "at", day.alias("day"), clock.alias("clock"))
    asks = asks.select("who", "at", F.explode(F.array(*[_asked(F.col("day"), F.col("clock"), n) for n in levels])).alias("asked")).repartition(tasks, "who", "asked")
    nodes = nodes.select(F.col("key").alias("__key"), "node", "rank").repartition(tasks, "__key", "node")
    met = asks.join(nodes, (F.col("who") == F.col("__key")) & (F.col("asked") == F.col("node")))
    best = met.groupBy("who", "at").agg(F.max("rank").alias("best"))
    return best.select(F.col("who").alias("__key"), F.col("at").alias("__moment"), F.col("best.value").alias("__value"))


def months_of_periods(
    history: DataFrame, key: str, value: str, start: str = "data_inicio", end: str = "data_fim",
    order: list[str] | None = None,
) -> DataFrame:
    """One row per key and month a period touches; the first period by ``order`` owns it.

    Without ``order`` the earliest start comes first.  Of a key's periods over the same months only the first can own any;
    those are dealt by key, in tasks as many as the months need, and months are made and compared within a task.
    """
    since = col(start).cast("date")
    until = F.coalesce(col(end).cast("date"), F.lit(OPEN_END).cast("date"))
    ranks = [f"__rank{i}" for i in range(len(order or [start]))]
    touched = history.filter(since <= until).select(
        col(key), col(value), *[col(n).alias(rank) for rank, n in zip(ranks, order or [start])],
        F.trunc(since, "MM").alias("__first"), F.trunc(until, "MM").alias("__last"),
    )
    months = touched.agg(F.sum(F.months_between("__last", "__first") + 1)).first()[0] or 0
    spans = keep_first(touched, [key, "__first", "__last"], ranks).repartition(int(months) // MONTHS_PER_TASK + 1, col(key))
    spread = spans.withColumn("__month", F.explode(F.sequence("__first", "__last", F.expr("interval 1 month"))))
    monthly = spread.withColumn("ano_mes", month_key(F.col("__month"))).drop("__month", "__first", "__last")
    firsts = keep_first(monthly, [key, "ano_mes"], ranks)
    return firsts.select(col(key), col(value), "ano_mes")


__all__ = [
    "OPEN_END", "disjoint_segments", "interval_nodes", "months_of_periods", "period_side", "segments_by_nodes", "validity_periods", "value_at",
]
