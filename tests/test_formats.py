import pytest
from pyspark.sql import functions as F

from starlot.operators.formats import AmbiguousDates, elect_formats, source_formats
from starlot.sources import feeds


def texts(spark, **columns):
    rows = list(zip(*columns.values()))
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in columns))


def test_each_column_elects_what_reads_most(spark):
    df = texts(
        spark,
        br=["31/12/2024", "01/02/2024 10:15", " 05/06/2024 10:15:30 ", "n/d", None],
        us=["12/31/2024", "01/02/2024", "02/30/2024", "", "05/06/2024 23:59:59.000001"],
        iso=["2024-12-31", "2024-01-02 03:04:05.123456", None, None, None],
        key=["20241231", "20240102", "x", "20240230", None],
        none=["x", "", None, "7", "31/31/2024"],
    )
    found = elect_formats(df, df.columns)
    assert {n: f and f.split("[")[0] for n, f in found.items()} == {
        "br": "dd/MM/yyyy", "us": "MM/dd/yyyy", "iso": "yyyy-MM-dd", "key": "yyyyMMdd", "none": None,
    }
    read = df.select(feeds.when(df, "br", (found["br"],)).alias("a"), feeds.when(df, "us", (found["us"],)).alias("b")).collect()
    assert [str(r.a) for r in read] == ["2024-12-31 00:00:00", "2024-02-01 10:15:00", "2024-06-05 10:15:30", "None", "None"]
    assert [str(r.b) for r in read][-1] == "2024-05-06 23:59:59.000001"


def test_dates_that_nothing_can_tell_apart_are_an_error(spark):
    with pytest.raises(AmbiguousDates, match="day.*dd/MM/yyyy.*MM/dd/yyyy.*all 2 dates, 1 of them"):
        elect_formats(texts(spark, day=["01/02/2024", "03/03/2024"]), ["day"])
    same = elect_formats(texts(spark, day=["02/02/2024", "03/03/2024"]), ["day"])
    assert same["day"].startswith("dd/MM/yyyy")
    assert elect_formats(texts(spark, day=["01/02/2024", "13/03/2024"]), ["day"])["day"].startswith("dd/MM")
    assert elect_formats(spark.createDataFrame([], "day string"), ["day"]) == {"day": None}


def test_a_source_may_mix_formats_that_cannot_be_confused(spark):
    df = texts(spark, a=["31/12/2024", None], b=["2024-12-31", "2024-01-01"]).withColumn("n", F.lit(1))
    assert len(source_formats(df, ("a", "b", "n", "missing"))) == 2
    clash = texts(spark, a=["31/12/2024", "01/02/2024"], b=["12/31/2024", "01/02/2024"])
    with pytest.raises(AmbiguousDates, match="another column"):
        source_formats(clash, ("a", "b"))
