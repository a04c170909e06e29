"""Flags, lenient parsing and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = -1
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"
# Whole numbers as nearly all are written; their digits are the number.
WHOLE = r"^[+-]?[0-9]{1,18}(\.0*)?$"

# Month and weekday names of the calendar (Monday first).
MONTH_NAMES = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
WEEKDAY_NAMES = ["Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado", "Domingo"]


def col(name: str) -> Column:
    """Column by exact name, also for names with dots such as ``dt._venda``."""
    return F.col("`" + name.replace("`", "``") + "`")


def equals_flag(text: Column, word: str) -> Column:
    """1 where ``text`` equals ``word`` ignoring case, else 0 (null included).

    No trimming and no accent folding: ``"ganho "`` is 0.
    """
    return F.coalesce(F.lower(text.cast("string")) == F.lit(word), F.lit(False)).cast("int")


def lenient_timestamp(value: Column, *formats: str) -> Column:
    """Timestamp without zone, or null where the text, blanks around it aside, fits none of ``formats``."""
    if not formats:
        return value.try_cast("timestamp_ntz")
    tries = [F.try_to_timestamp(F.trim(value), F.lit(fmt)).cast("timestamp_ntz") for fmt in formats]
    return F.coalesce(*tries)


def lenient_number(value: Column, kind: str = "double") -> Column:
    """Number, or null where the text is none.  Whole numbers may arrive as ``"7.0"``.

    Only decimal notation counts: a cast alone would take ``"7F"`` or ``"7D"`` for 7, and
    what is not a finite number (``"nan"``, ``"Infinity"``) would spoil every sum.
    """
    text = F.trim(value.cast("string"))
    if kind == "double":
        return F.when(text.rlike(NUMBER), text).try_cast("double")
    # Read once as an exact number; a whole one stays exact where a double would round it. What has too many digits for that
    # (or an exponent beyond them) is read as a double, and is whole only if it is one.  A filter evaluates each mention anew, so
    # texts written as whole numbers, and those that are no numbers, do without all that.
    exact, rounded = text.try_cast("decimal(38,18)"), text.try_cast("double")
    general = F.coalesce(F.when(exact == F.floor(exact), exact.try_cast(kind)), F.when(exact.isNull() & (rounded == F.rint(rounded)), rounded.try_cast(kind)))
    return F.when(text.rlike(WHOLE), F.substring_index(text, ".", 1).try_cast(kind)).when(text.rlike(NUMBER), general)


def finite(value: Column) -> Column:
    """A double, or null where it is not a finite number."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def date_key(when: Column) -> Column:
    """``YYYYMMDD`` as int; null stays null."""
    return (F.year(when) * 10000 + F.month(when) * 100 + F.dayofmonth(when)).cast("int")


def month_key(when: Column) -> Column:
    """``YYYYMM`` as int; null stays null."""
    return (F.year(when) * 100 + F.month(when)).cast("int")


def month_of_date_key(key: Column) -> Column:
    return F.floor(key / 100).cast("int")


def month_start(key: Column) -> Column:
    """First day of a ``YYYYMM`` month as timestamp."""
    return F.make_date(F.floor(key / 100).cast("int"), (key % 100).cast("int"), F.lit(1)).cast("timestamp_ntz")


def month_name(month: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTH_NAMES)), month)


def weekday_name(weekday: Column) -> Column:
    """Name of a weekday counted from 0 = Monday."""
    return F.element_at(F.array(*map(F.lit, WEEKDAY_NAMES)), weekday + 1)


def half_year(when: Column) -> Column:
    return F.when(F.month(when) > 6, 2).otherwise(1)


def business_days_in_month(when: Column) -> Column:
    """Mondays to Fridays in the month of ``when``, holidays not considered.

    Any 28 days in a row hold 20 of them, so only the days after the 28th count.
    """
    first = F.weekday(F.trunc(when, "MM"))
    length = F.dayofmonth(F.last_day(when))
    extra = [
        F.when((length >= day) & ((first + (day - 1)) % 7 < 5), 1).otherwise(0) for day in (29, 30, 31)
    ]
    return F.lit(20) + extra[0] + extra[1] + extra[2]


def known_or(value: Column, kind: str, default: int = UNKNOWN) -> Column:
    """``value`` as ``kind`` with the unknown member's key where it is null."""
    return F.coalesce(value, F.lit(default)).cast(kind)
