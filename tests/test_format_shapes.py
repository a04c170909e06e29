"""Shapes of date formats: no text that a format reads is kept from it, and few others are tried."""

import random

from pyspark.sql import functions as F

from starlot.functions.scalars import lenient_timestamp
from starlot.operators.formats import CANDIDATES, TIME, shape


def texts():
    rng = random.Random(2)
    out = ["", " ", "31/02/2024", "29.02.2024", "00/10/2024", "+12024-01-05", "-2024-01-05", "+20240105", "120240105", "0000-01-01", "2024-1-5", "1/1/2024", "05/01/24 10",
           "05/01/2024 10:11", "05/01/2024 10:11:12.123456 ", "05/01/2024  10:11", "05/01/2024\n10:11", "05/01/2024\n", "2024-01-05T10:11", "٠٥/٠١/٢٠٢٤", "05/01/12024 10:11", "05/01/+12024"]
    for _ in range(1200):
        y, a, b = rng.choice(["2024", "24", "0001", "12024", "+12024"]), rng.randrange(0, 35), rng.randrange(0, 35)
        sep = rng.choice(["-", "/", ".", ""])
        parts = [y, f"{a:02d}", f"{b:02d}"]
        rng.shuffle(parts)
        out.append(rng.choice(["", " "]) + sep.join(parts) + rng.choice(["", "", " ", " 10:11", " 10:11:12", " 25:00", "x"]))
    return out


def test_a_shape_lets_all_texts_pass_that_the_format_reads(spark):
    df = spark.createDataFrame([(t,) for t in texts()], "t string")
    read = df.select("t", *[lenient_timestamp(F.col("t"), c).isNotNull().alias(f"r{i}") for i, c in enumerate(CANDIDATES)],
                     *[F.trim("t").rlike(shape(c)).alias(f"s{i}") for i, c in enumerate(CANDIDATES)]).collect()
    for i, c in enumerate(CANDIDATES):
        assert [r["t"] for r in read if r[f"r{i}"] and not r[f"s{i}"]] == [], c
        assert any(r[f"r{i}"] for r in read) and sum(r[f"s{i}"] for r in read) < len(read) / 3


def test_formats_of_other_parts_have_no_shape():
    assert shape("dd MMM yyyy") is None and shape("d/M/yyyy") is None and shape("yyyy-MM-dd'T'HH:mm") is None
    assert shape("dd/MM/yyyy HH:mm:ss") is None and shape("dd/MM/yyyy" + TIME) is not None
