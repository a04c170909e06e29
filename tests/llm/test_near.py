import random
from collections import defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from starlot.llm import near


def words_of(text):
    return [w for w in regex.split(r"[^\p{L}\p{M}\p{N}]+", (text or "").lower()) if w]


def brute_classes(rows):
    """Classes by comparing all pairs."""
    sets, parent = [], list(range(len(rows)))
    for _, text, *_ in rows:
        w = words_of(text)
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and 10 * shared >= 8 * (len(sets[i]) + len(sets[j]) - shared) and shared:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    ids = defaultdict(list)
    for i, row in enumerate(rows):
        ids[top(i)].append(row[0])
    return {row[0]: min(ids[top(i)]) for i, row in enumerate(rows)}


def corpus(seed=3):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghijklmno") for _ in range(rnd.randint(2, 8))) for _ in range(4000)]
    prose = lambda n: [rnd.choice(vocabulary) for _ in range(n)]

    def edited(w, share):
        return [rnd.choice(vocabulary) if rnd.random() < share else x for x in w]

    rows, number = [], iter(range(10_000))
    passage = prose(60)
    for k in range(60):
        rows.append((next(number), " ".join(prose(rnd.randint(1, 200)))))
    for k in range(40):  # a common passage makes no near copy
        rows.append((next(number), " ".join(prose(90) + passage)))
    for share in (0.002, 0.01, 0.02, 0.03):
        base = prose(300)
        rows += [(next(number), " ".join(edited(base, share))) for _ in range(25)]
    base = prose(120)
    rows += [(next(number), " ".join(base).upper() if k % 2 else ", ".join(base)) for k in range(50)]
    rows += [(next(number), t) for t in ("", None, "one two", "One, two!", "one two three", " \n", "a a a a a a a a", "a a a a a a")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("rounds", [3, 1, 0])
def test_classes_against_all_pairs(documents, rounds):
    rows = corpus()
    got = {r.doc_id: r.class_id for r in near.near_duplicates(documents(rows), rounds=rounds).collect()}
    assert got == brute_classes(rows)


def test_prob_min_hash_estimates_probability_jaccard():
    rnd = np.random.default_rng(5)
    elements = rnd.integers(0, 2**63, 300).astype(np.uint64)
    x, y = rnd.exponential(size=300) + 0.05, rnd.exponential(size=300) + 0.05
    x[:60], y[240:] = 0, 0
    both = (x > 0) & (y > 0)
    want = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in np.flatnonzero(both))
    keep_x, keep_y = x > 0, y > 0
    owner = np.concatenate([np.zeros(keep_x.sum(), int), np.ones(keep_y.sum(), int)])
    first = near.prob_min_hash(owner, np.concatenate([elements[keep_x], elements[keep_y]]), np.concatenate([x[keep_x], y[keep_y]]), 2, 20_000)
    assert abs((first[0] == first[1]).mean() - want) < 0.015
    alone = near.prob_min_hash(np.zeros(keep_x.sum(), int), elements[keep_x], 7 * x[keep_x], 1, 20_000)
    assert (alone[0] == first[0]).mean() > 0.9999  # the scale of weights does not count


def test_repeated_rows_null_ids_and_one_of_each(documents):
    rows = corpus(9)
    doubled = rows + rows[:30] + [(None, rows[0][1]), (None, "alone and without a number at all today")]
    df = documents(doubled)
    got = near.near_duplicates(df).collect()
    assert len(got) == len(doubled)
    want = brute_classes(rows)
    assert all(r.class_id == want[r.doc_id] for r in got if r.doc_id is not None)
    kept = near.one_of_each(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    no_words = [k for k, t in doubled if k is not None and not words_of(t)]
    expected = sorted({c for k, c in want.items() if k not in no_words} | set()) + sorted(no_words)
    assert sorted(i for i in ids if i is not None) == sorted(expected)
    assert ids.count(None) == 1


def test_texts_that_repeat_a_passage_meet_those_that_do_not(documents):
    """Set similarity 0.967, but the weights of the repeated shingles differ by far."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    rows = []
    for k in range(60):
        text = [word() for _ in range(125)]
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(text + text[50:75] * 400))]
    got = {r.doc_id: r.class_id for r in near.near_duplicates(documents(rows)).collect()}
    assert got == brute_classes(rows) and sum(got[2 * k + 1] == 2 * k for k in range(60)) == 60


def test_parities_differ_by_no_more_than_the_sets(spark):
    rnd = random.Random(6)
    base = [rnd.getrandbits(63) - 2**62 for _ in range(300)]
    sets = [rnd.sample(base, rnd.randrange(1, 300)) for _ in range(60)]
    df = spark.createDataFrame([(s,) for s in sets], "s array<bigint>")
    found = [tuple(r) for r in df.select(*near._parities(F.col("s"))).collect()]
    for x, p in zip(sets, found):
        assert sum(bin(b & (2**64 - 1)).count("1") for b in p) % 2 == len(x) % 2
        for y, q in zip(sets, found):
            assert sum(bin((a ^ b) & (2**64 - 1)).count("1") for a, b in zip(p, q)) <= len(set(x) ^ set(y))


def test_rows_of_one_id_that_differ_elsewhere(documents):
    """Which of them stays does not depend on how they are dealt out."""
    df = documents([(1, "one two three four five six", "a"), (1, "one two three four five six", "b"), (1, "One, two three four five six", "c")])
    kept = {repr(near.one_of_each(df.repartition(n)).collect()) for n in (1, 2, 3, 7)}
    assert len(kept) == 1


def test_empty_table_and_long_text(documents):
    assert near.near_duplicates(documents([])).count() == 0
    assert near.one_of_each(documents([])).count() == 0
    rnd = random.Random(2)
    long = " ".join(str(rnd.randint(0, 10**6)) for _ in range(150_000))
    got = {r.doc_id: r.class_id for r in near.near_duplicates(documents([(5, long), (9, long + " end"), (2, "short one here is it")])).collect()}
    assert got == {5: 5, 9: 5, 2: 2}
