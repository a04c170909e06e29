import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from starlot.functions.text import normalise_header, normalise_headers, normalise_text


def plain(text):
    """Brute-force statement of the rule, character by character."""
    if text is None:
        return ""
    decomposed = unicodedata.normalize("NFKD", text.strip().lower())
    kept = "".join(c for c in decomposed if c in "abcdefghijklmnopqrstuvwxyz0123456789 ")
    return re.sub(" +", " ", kept).strip()


def run(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["n"] for r in df.select("i", normalise_text(F.col("t")).alias("n")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "given, expected",
    [
        (["Cão", "João", "Ação"], ["cao", "joao", "acao"]),
        (["ABC", "DeF"], ["abc", "def"]),
        (["  abc  ", "xyz "], ["abc", "xyz"]),
        (["a  b", "c   d"], ["a b", "c d"]),
        (["a.b", "c-d", "e@f"], ["ab", "cd", "ef"]),
        ([None, "ok"], ["", "ok"]),
        (["lead123"], ["lead123"]),
        (["  João  da  Silva  "], ["joao da silva"]),
        (["a\tb", "a - b", "a b", " x "], ["ab", "a b", "a b", "x"]),
        (["ß", "æ", "ﬁ", "½", "nº", "™"], ["", "", "fi", "12", "no", ""]),
    ],
)
def test_cases(spark, given, expected):
    assert run(spark, given) == expected


def test_random_strings_equal_brute_force(spark):
    rng = random.Random(5)
    spans = [(0x20, 0x250), (0x20, 0xD7FF), (0xE000, 0x1FFFF)]
    texts = ["".join(chr(rng.randint(*spans[i % 3])) for _ in range(rng.randint(0, 30))) for i in range(3000)]
    assert run(spark, texts) == [plain(t) for t in texts]


def test_idempotent(spark):
    texts = ["  Ünïcödé ﬁn  ½ ", "x-y  z", "Ñandú"]
    once = run(spark, texts)
    assert run(spark, once) == once


def test_headers(spark):
    assert [normalise_header(n) for n in (" Código ", "Dt. Venda", "Placa/Chassi", "Ação Nº")] == [
        "codigo", "dt._venda", "placa/chassi", "acao_no",
    ]
    df = spark.createDataFrame([(1, 2)], "`Dt. Venda` int, `Código` int")
    assert normalise_headers(df).columns == ["dt._venda", "codigo"]
    with pytest.raises(ValueError, match="codigo"):
        normalise_headers(spark.createDataFrame([(1, 2)], "`Código` int, `Codigo ` int"))
