import random

import pytest

from starlot.llm import decontam

ITEM = "A train leaves Paris at 9 with 120 people and drives 300 km to reach Lyon where Anna waits for 2 hours before she takes 45 bags to Marco"
OTHER = "A train leaves Berlin at 7 with 80 people and drives 512 miles to reach Bonn where Clara waits for 3 hours before she takes 16 bags to Peter"


@pytest.fixture
def benchmark(spark):
    def make(rows):
        return spark.createDataFrame([(k, t, 1) for k, t in rows], "item_id bigint, text string, key int")
    return make


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def found(docs, items):
    return {r.doc_id: list(r.item_ids) for r in decontam.leaks(docs, items).collect()}


def test_copies_and_new_parameters_are_leaks_and_clashing_slots_are_not(documents, benchmark):
    clash = ITEM.replace("120", "300").replace("45", "300").replace("300 km", "77 km")
    half = " ".join(ITEM.split()[:20])
    few = " ".join(ITEM.split()[:10])
    docs = documents([
        (1, f"{prose(1, 60)}. {ITEM}. {prose(2, 60)}"), (2, f"{prose(3, 60)}. {OTHER}. {prose(4, 10)}"), (3, prose(5, 200)),
        (4, f"{prose(6, 60)}. {half} {prose(7, 50)}"), (5, f"{prose(8, 60)}. {few} {prose(9, 50)}"), (6, ITEM.upper()), (7, None), (8, ""),
        (9, ITEM.replace(" ", "\n")), (1, f"{prose(1, 60)}. {ITEM}. {prose(2, 60)}"),
    ])
    got = found(docs, benchmark([(50, ITEM)]))
    assert got[1] == got[2] == got[4] == [50] and 3 not in got and 5 not in got and 7 not in got and 8 not in got
    assert clash != ITEM


def test_other_case_and_blanks_and_renamed_sentence_starts_are_leaks(documents, benchmark):
    asked = "Natalia sold clips to 48 friends in April. Natalia sold 24 clips in May. How many clips did Natalia sell?"
    renamed = asked.replace("Natalia", "Weng").replace("48", "30").replace("24", "15")
    docs = documents([
        (6, ITEM.upper()), (7, ITEM.lower()), (9, ITEM.replace(" ", "\n")), (10, f"{prose(1, 40)}. {renamed} {prose(2, 40)}"),
        (11, renamed.replace("Weng", "Mary Ann").replace(" 30 ", " thirty five ")),
        (13, prose(3, 80)), (14, asked.replace("clips", "cups").replace("sold", "gave").replace("friends", "guests").replace("How many", "Which")),
    ])
    got = found(docs, benchmark([(50, ITEM), (60, asked)]))
    assert got == {6: [50], 7: [50], 9: [50], 10: [60], 11: [60]}


def test_readings_of_texts_end_to_end():
    import numpy as np

    word, number, two, hours = 80, 8 * 7 | decontam.DIGITS, 8 * 11 | decontam.OTHER, 8 * 13 | decontam.OTHER
    cs = np.array([number, hours, two, two, hours, hours, 16 | decontam.FIRST, 24 | decontam.INSIDE, 32 | decontam.FIRST, word], dtype=np.int64)
    ends = np.array([5, 8, 10])
    one = lambda r: decontam.read(cs, r, np.array([8 * 13]), np.array([8 * 11]), ends)
    assert one(decontam.TYPED)[0].tolist() == [-1, -3, 88, 88, 104, 104, 16, -2, 32, 80]
    assert one(decontam.OPEN)[0].tolist() == [-1, -3, -1, -3, 104, -2, -2, 80] and one(decontam.OPEN)[2].tolist() == [0, 1, 2, 4, 5, 6, 8, 9]
    assert one(decontam.PLAIN)[0].tolist() == [56, 104, 88, 88, 104, 104, 16, 24, 32, 80]


def test_slots_must_agree():
    item = "in 4 days 4 men and 9 women build houses".split()
    slots = [decontam.NUMBER if w.isdigit() else 10 + k for k, w in enumerate(item)]
    met = [(0, 0)]
    assert decontam.consistent_windows(item, "in 6 days 6 men and 5 women build houses".split(), slots, met, 8) == 1
    assert decontam.consistent_windows(item, "in 6 days 7 men and 5 women build houses".split(), slots, met, 8) == 0
    assert decontam.consistent_windows(item, "in 6 days 6 men and 6 women build houses".split(), slots, met, 8) == 0


def test_short_items_tables_and_empty_sides(documents, benchmark):
    docs = documents([(1, f"{prose(1, 30)} the quick brown fox jumps {prose(2, 30)}"), (2, "1 2 3 4 5 6 7 8 9 10 11 12 13"), (3, "yes")])
    items = benchmark([(1, "The quick brown fox jumps"), (2, "9 8 7 6 5 4 3 2 1 12 14"), (3, "yes"), (4, None), (5, "")])
    assert found(docs, items) == {1: [1]}
    assert found(docs, benchmark([])) == {} and found(documents([]), items) == {}


def test_removal_keeps_clean_rows_and_columns(documents, benchmark):
    df = documents([(1, ITEM), (2, prose(3, 50)), (2, prose(3, 50)), (None, None), (None, ITEM), (4, "")])
    out = decontam.without_leaks(df, benchmark([(1, ITEM), (1, ITEM), (2, ITEM), (None, prose(8, 40))]))
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["2", "2", "4", "None"]


def test_shuffle_form_and_long_text(documents, benchmark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", -1)
    docs = documents([(k, f"{prose(k, 4000)} {ITEM} {prose(k + 50, 4000)}" if k % 2 else prose(k, 9000)) for k in range(6)])
    assert found(docs, benchmark([(7, ITEM), (8, OTHER), (9, prose(99, 40))])) == {1: [7, 8], 3: [7, 8], 5: [7, 8]}


def test_against_brute_force_on_the_given_tables(spark, small_documents):
    """On these tables leaks are whole passages: word for word containment finds the same."""
    import regex

    words = lambda t: " ".join(w for w in regex.split(r"[^\p{L}\p{M}\p{N}]+", t.lower()) if w)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts = {r.doc_id: f" {words(r.text)} " for r in small_documents.collect()}
    asked = {r.item_id: f" {words(r.text)} " for r in items.collect()}
    want = {d: sorted(i for i, a in asked.items() if a in t) for d, t in texts.items()}
    assert found(small_documents, items) == {d: x for d, x in want.items() if x}
