"""Which format dates as text are in, elected by what the values themselves allow.

One aggregate over the columns counts, for every candidate, the values it reads and, for every two of them, the
values that both read but read differently. The candidate that reads the most is elected; if another reads
as many and not always the same, such as day before month and month before day where no day is above twelve, nothing
can tell and that is an error.

A candidate is tried only on texts of its shape, as every failed try costs an exception; other texts it cannot read.
"""

from __future__ import annotations

import re
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlot.functions.scalars import col, lenient_timestamp

# A time of day may follow, down to microseconds. The order tells between formats that always agree.
TIME = "[ HH:mm[:ss[.SSSSSS]]]"
CANDIDATES = tuple(day + TIME for day in ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd-MM-yyyy", "yyyy/MM/dd", "dd.MM.yyyy", "dd/MM/yy", "MM/dd/yy")) + ("yyyyMMdd",)


# What the parser needs at least for each part of a day; months and days out of range are no dates to it either.
PARTS = {"yyyy": r"[+-]?[0-9]{4,}", "yy": "[0-9]{2}", "MM": "(0[1-9]|1[0-2])", "dd": "(0[1-9]|[12][0-9]|3[01])"}


def shape(candidate: str) -> str | None:
    """A pattern of all texts that a format can read, or none if it has parts that are not known here."""
    day = candidate.removesuffix(TIME)
    pieces = re.split("(yyyy|yy|MM|dd)", day)
    if any(c.isalpha() or c in "'[]#{}" for piece in pieces if piece not in PARTS for c in piece):
        return None
    rest = "( .*)?" if candidate != day else ""
    return "(?s)^" + "".join(PARTS.get(piece) or re.escape(piece) for piece in pieces) + rest + r"\z"


def _read(name: str, candidate: str) -> Column:
    read, needed = lenient_timestamp(col(name), candidate), shape(candidate)
    return read if needed is None else F.when(F.trim(col(name)).rlike(needed), read)


class AmbiguousDates(ValueError):
    """Values that two formats read differently, with nothing to choose between them."""


def elect_formats(df: DataFrame, columns: list[str], candidates: tuple[str, ...] = CANDIDATES) -> dict[str, str | None]:
    """The elected format of each text column; none where no candidate reads a value."""
    if not columns:
        return {}
    counts = []
    # A projection of their own, so that each is read once for all the counts.
    each = df.select(*[_read(name, c).alias(f"__{i}_{a}") for i, name in enumerate(columns) for a, c in enumerate(candidates)])
    for i in range(len(columns)):
        read = [F.col(f"__{i}_{a}") for a in range(len(candidates))]
        counts += [F.count(r).alias(f"{i}:{a}") for a, r in enumerate(read)]
        counts += [F.count_if(read[a] != read[b]).alias(f"{i}:{a}:{b}") for a, b in combinations(range(len(candidates)), 2)]
    seen = each.agg(*counts).first()
    found: dict[str, str | None] = {}
    for i, name in enumerate(columns):
        reads = [seen[f"{i}:{a}"] for a in range(len(candidates))]
        best = max(reads)
        ties = [a for a, n in enumerate(reads) if n == best]
        for a, b in combinations(ties, 2):
            if best and seen[f"{i}:{a}:{b}"]:
                raise AmbiguousDates(f"{name}: {candidates[a]} and {candidates[b]} read all {best} dates, {seen[f'{i}:{a}:{b}']} of them differently")
        found[name] = candidates[ties[0]] if best else None
    return found


def text_columns(df: DataFrame, columns: tuple[str, ...]) -> list[str]:
    return [name for name in columns if name in df.columns and df.schema[name].dataType.simpleString() == "string"]


def source_formats(df: DataFrame, columns: tuple[str, ...], candidates: tuple[str, ...] = CANDIDATES) -> tuple[str, ...]:
    """The formats of all text dates of a source, for readers that try them in turn.

    Columns may be in different formats only where no value of one could be taken for the other's.
    """
    found = elect_formats(df, text_columns(df, columns), candidates)
    formats = tuple(dict.fromkeys(f for f in found.values() if f))
    if len(formats) > 1:
        for name, own in found.items():
            clashes = [f for f in formats if own and f != own]
            wrong = df.agg(*[F.count_if(lenient_timestamp(col(name), own) != lenient_timestamp(col(name), f)).alias(f) for f in clashes]).first() if clashes else []
            for other, n in zip(clashes, wrong):
                if n:
                    raise AmbiguousDates(f"{name} is in {own}, but {n} of its dates would be read by {other}, the format of another column")
    return formats
