import importlib.util
from collections import defaultdict

import numpy as np
import pytest
import regex

if importlib.util.find_spec("corpus_pipeline") is None:
    pytest.skip("the pipeline is not here", allow_module_level=True)

import corpus_pipeline
from starlot.llm import secrets
from starlot.llm.tokens import Encoder, vocabulary_path
from tests.llm.test_near import brute_classes
from tests.llm.test_quality import brute as brute_quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(text):
    return " ".join(w for w in regex.split(r"[^\p{L}\p{M}\p{N}]+", text.lower()) if w)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The given small tables with planted copies, leaks and secrets."""
    base = tmp_path_factory.mktemp("corpus")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    given, item = [tuple(r) for r in docs.collect()], items.first().text
    long = [r for r in given if 800 < len(r[1]) < 3000][:6]
    rows = given + [(5000 + k, r[1] + " closing", *r[2:]) for k, r in enumerate(long)] + [(6000, long[0][1] + "\n" + item, *long[0][2:])]
    rows += [(6001, long[1][1][::-1] + " password=hunter22x", *long[1][2:]), (None, long[2][1], None, None, None), (6002, None, "en", "s", 0), given[3]]
    spark.createDataFrame(rows, docs.schema).repartition(3).write.parquet(str(base / "documents.parquet"))
    items.write.parquet(str(base / "benchmark.parquet"))
    return str(base), rows, {r.item_id: r.text for r in items.collect()}


def test_stages_and_rows_against_brute_force(spark, folder):
    base, rows, items = folder
    docs = spark.read.parquet(f"{base}/documents.parquet")
    states = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, base).cache()
        states.append(docs)
        if name != "packing":
            assert docs.columns == COLUMNS, name

    keyed = [(k if k is not None else -1, t) for k, t, *_ in rows]
    good = brute_quality(keyed)
    kept = [(k, t) for k, t in keyed if not good[k][-1]]
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in states[0].collect()) == sorted(k for k, _ in kept)

    # A row without an id does not lend its class one.
    named = brute_classes([(k if k >= 0 else 10**9, t) for k, t in kept])
    ones = {min(named[k], k) for k in named if named[k] == k}
    assert sorted(r.doc_id for r in states[1].collect()) == sorted(ones)

    texts = {k: t for k, t in kept}
    asked = [f" {words(t)} " for t in items.values()]
    clean = {k for k in ones if not any(a in f" {words(texts[k])} " for a in asked)}
    assert {r.doc_id for r in states[2].collect()} == clean

    count = secrets.token_counter(secrets.vocabulary_path())
    redacted = {k: secrets.hidden(texts[k], secrets.spans_of(texts[k], count), "<SECRET>") for k in clean}
    assert {r.doc_id: r.text for r in states[3].collect()} == redacted

    coder, got = Encoder(vocabulary_path()).tokenizer, defaultdict(int)
    for r in states[4].collect():
        assert r.offset + r.length <= 1024
        got[r.doc_id] += r.length
    assert got == {k: len(coder.encode(t, add_special_tokens=False).ids) + 1 for k, t in redacted.items()}
    assert 6000 not in clean and 6001 in clean and "hunter22x" not in redacted[6001] and not any(5000 <= k < 5006 for k in clean)


def test_run_writes_every_stage_and_gives_the_last(spark, folder):
    base, *_ = folder
    out = corpus_pipeline.run(spark, base)
    length = out.agg({"length": "sum"}).first()[0]
    assert out.select("sequence_id").distinct().count() == int(np.ceil(length / 1024))


def test_empty_documents(spark, folder, tmp_path):
    base, *_ = folder
    spark.read.parquet(f"{base}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{base}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
