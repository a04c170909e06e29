"""Wide month columns to long rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlot.functions.scalars import col, date_key, lenient_timestamp


def months_to_rows(
    wide: DataFrame, label: str, value: str, date_format: str = "dd/MM/yyyy"
) -> DataFrame:
    """``(label, id_data, value)`` from one column per month, headed by its date.

    Cells without a value are left out; a header that is no date gives a null key.
    """
    months = [name for name in wide.columns if name != label]
    if label not in wide.columns:
        raise ValueError(f"column {label!r} is missing")
    if not months:
        raise ValueError("no date column found")
    long = wide.select(col(label), *[col(m).cast("double").alias(m) for m in months]).unpivot(
        [col(label)], [col(m) for m in months], "__month", value
    )
    return long.dropna(subset=[value]).select(
        col(label), date_key(lenient_timestamp(F.col("__month"), date_format)).alias("id_data"), col(value)
    )
