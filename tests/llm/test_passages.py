import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from starlot.llm import passages


def brute(rows, width):
    """Per row ``(id, n_words, n_removed, sha of the kept words)`` by looking at every window."""
    texts = [(passages.LAST_ID if i is None else i, re.findall(r"[^ \t-\r]+", t or "")) for i, t in rows]
    first = {}
    for i, ws in texts:
        for s in range(len(ws) - width + 1):
            w = tuple(ws[s : s + width])
            first[w] = min(first.get(w, i), i)
    out = []
    for (raw, _), (i, ws) in zip(rows, texts):
        seen, gone = set(), set()
        for s in range(len(ws) - width + 1):
            w = tuple(ws[s : s + width])
            if first[w] < i or w in seen:
                gone.update(range(s, s + width))
            seen.add(w)
        kept = " ".join(w for p, w in enumerate(ws) if p not in gone)
        out.append((raw, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def ours(df, **how):
    rows = passages.repeated_passages(df, **how).collect()
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows], key=repr)


def test_all_words_of_later_windows_go(documents):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    free = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, other = free(30), free(20)
    rows = [
        (9, " ".join(free(10) + passage + free(5))),
        (2, "\n".join(free(8) + passage + free(3) + passage)),  # twice in one text, and first of all texts
        (4, "  ".join(other + passage[:19])),  # one word short of a window
        (5, "\t".join(other + free(4) + passage[5:25])),
        (6, " ".join(["same"] * 60)),  # every window equal
        (7, " ".join(["same"] * 25)),
        (8, " ".join(["same"] * 19)),
        (3, " ".join(passage + ["é\x85x", "a\xa0b", "c\x1cd"] + passage)),  # these are inside words
        (1, None), (10, ""), (11, " \n "), (12, "one"),
        *[(20 + k, " ".join(other + passage)) for k in range(40)],  # exact copies, in no order
        (13, " ".join(other + passage)), (None, " ".join(passage)), (None, " ".join(free(3) + other)),
        (2, " ".join(passage)), (14, " ".join(other)), (14, " ".join(other)),  # rows of one id
    ]
    rng.shuffle(rows)
    assert ours(documents(rows)) == brute(rows, passages.WIDTH)


@pytest.mark.parametrize("width,part", [(5, 2), (5, 5), (7, 3), (4, 1)])
def test_few_words_and_many_repeats(documents, width, part):
    rng = random.Random(width)
    rows = [(rng.randrange(60), " ".join(rng.choice("abc") for _ in range(rng.randrange(30)))) for _ in range(120)]
    assert ours(documents(rows), width=width, part=part) == brute(rows, width)


def test_registered_query_equals_its_sql(spark):
    query = passages.op13_repeated_passages(spark, "/root/testdata/sf0.001")
    documents = "/root/testdata/sf0.001/documents.parquet"
    sql = duckdb.sql(passages.SQL.replace("FROM documents", f"FROM '{documents}'")).fetchall()
    assert sorted(tuple(r) for r in query.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()) == sorted(sql)
    assert sum(r[2] for r in sql) > 0


def test_a_long_text_is_read_in_pieces(documents, monkeypatch):
    rng = random.Random(3)
    words = [f"{rng.getrandbits(40):x}" for _ in range(150_000)]  # more than one piece
    rows = [(1, " ".join(words)), (2, " ".join(words[70_000:70_100]) + " " + "x" * (2 * passages.PIECE))]
    assert ours(documents(rows)) == brute(rows, passages.WIDTH)


def test_intervals_are_maximal_and_empty_tables_stay_empty(documents):
    assert passages.removal_intervals(np.array([0, 3, 30, 50, 71]), 20).tolist() == [[0, 23], [30, 70], [71, 91]]
    words = [f"w{k}" for k in range(50)]
    rows = [(1, " ".join(words)), (2, "x " + " ".join(words[:25]) + " y z " + " ".join(words[20:40]))]
    spans = {r.doc_id: r.intervals for r in passages.repeated_passages(documents(rows)).collect()}
    assert spans == {1: [], 2: [[1, 26], [28, 48]]}
    assert ours(documents(rows).limit(0)) == []


def test_rolling_hash_equals_the_plain_sum():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**64, 300, np.uint64)
    [rolled] = passages.Roll(1)(values, 20)
    plain = [sum(int(v) * pow(passages.BASES[1], j, 2**64) for j, v in enumerate(values[i : i + 20])) % 2**64 for i in range(281)]
    assert rolled.tolist() == plain
