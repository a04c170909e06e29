import itertools
import random
import re
import zlib

import duckdb
import pytest

from starlot.llm import repair
from starlot.llm.repair import Row

COLUMNS = "conv_id bigint, turn bigint, role string, text string"
LEGAL = re.compile("(s?(ua)+)?")


def brute(rows):
    """Least ``(cost, audit)`` over all edit scripts: every choice for each row, then every way to insert."""
    best = None
    for choice in itertools.product("DKua", repeat=len(rows)):
        cost, letters = 0, []
        for row, edit in zip(rows, choice):
            if edit != "D" and row.must_go:
                break
            cost += 2 if edit == "D" else 5 * row.truncated + (edit != "K")
            letters.append(("D", "") if edit == "D" else ("K", row.initial or "?") if edit == "K" else ("R", edit))
        else:
            for audit, inserts in _insertions(letters):
                found = (cost + 5 * inserts, audit)
                best = found if best is None or found < best else best
    return best


def _insertions(letters, limit=4):
    """Audits with up to ``limit`` turns put between the edits so that what they leave is legal."""
    for n in range(limit + 1):
        for places in itertools.combinations_with_replacement(range(len(letters) + 1), n):
            for roles in itertools.product("ua", repeat=n):
                put = [[] for _ in range(len(letters) + 1)]
                for place, role in zip(places, roles):
                    put[place].append(("I", role))
                whole = [*put[0], *itertools.chain.from_iterable([x, *put[i + 1]] for i, x in enumerate(letters))]
                if LEGAL.fullmatch("".join(r for _, r in whole)):
                    yield "".join(e for e, _ in whole), n


def test_against_every_edit_script():
    rng = random.Random(1)
    assert repair.cheapest_edits([]) == (0, "")
    for _ in range(250):
        rows = [Row(rng.choice("uuaasx"), rng.random() < 0.15, rng.random() < 0.25) for _ in range(rng.randrange(1, 5))]
        assert repair.cheapest_edits(rows) == brute(rows), rows


def fold(rows):
    """The same by one pass over the rows, labels as (cost, audit)."""
    far = (10**9, "~")
    plus = lambda x, c, e: (x[0] + c, x[1] + e) if x != far else far

    def insert(x):
        x[2] = min([x[2]] + [plus(x[q], 5, "I") for q in (0, 1, 3)])
        x[3] = min(x[3], plus(x[2], 5, "I"))
        return x

    at = insert([(0, ""), far, far, far])
    for row in rows:
        new = [plus(x, 2, "D") for x in at]
        if not row.must_go:
            more = 5 * row.truncated
            if row.initial == "s":
                new[1] = min(new[1], plus(at[0], more, "K"))
            for to, letter, sources in ((2, "u", (0, 1, 3)), (3, "a", (2,))):
                for q in sources:
                    new[to] = min(new[to], plus(at[q], more + 1, "R"), plus(at[q], more, "K") if row.initial == letter else far)
        at = insert(new)
    return min(at[0], at[3])


def test_longer_conversations_against_a_fold():
    rng = random.Random(2)
    for n in (6, 10, 25, 120):
        for _ in range(60):
            faulty = rng.choice([0, 0.1, 0.5])
            rows = [Row(rng.choice("ua") if rng.random() < faulty else "ua"[i % 2], rng.random() < faulty, rng.random() < faulty) for i in range(n)]
            assert repair.cheapest_edits(rows) == fold(rows)


def test_a_very_long_conversation_stays_linear():
    rows = [Row("ua"[i % 2], i % 97 == 0, i % 31 == 0) for i in range(30_000)]
    cost, audit = repair.cheapest_edits(rows)
    assert (cost, audit) == fold(rows) and len(audit) >= 30_000


ODD = [
    (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 5, "assistant", "Yes!"), (1, None, "system", "Be kind."),
    (2, 0, "tool", "x?"), (2, 1, "", "y?"), (2, 2, None, None), (2, 3, "user", "no end"), (3, 0, "assistant", " \n\t"), (4, 0, "user", "é" * 50_000),
    (None, 0, "user", "Who?"), (None, None, "assistant", "Me."), (5, None, None, None), (6, 1, "User", "Up."), (6, 2, "assistant", "a\x85"), (7, 2**60, "user", "a."), (7, 0, "user", "b."),
]


def ours(df):
    names = ["conv_id", *repair.RESULT, "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in repair.repair_conversations(repair.damaged(df)).select(*names).collect()), key=repr)


@pytest.mark.parametrize("where", ["sf0.001", "odd", "empty", "many"])
def test_sql_agrees(spark, where):
    if where == "sf0.001":
        path = "/root/testdata/sf0.001/conversations.parquet"
        conversations, df = duckdb.read_parquet(path), spark.read.parquet(path)
    else:
        rng = random.Random(9)
        many = [
            (c, rng.choice([None, *range(8)]), rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "c!", "", "d? "]))
            for c in range(80) for _ in range(rng.randrange(1, 9))
        ]
        df = spark.createDataFrame({"odd": ODD, "empty": [], "many": many}[where], COLUMNS)
        conversations = df.toArrow()
        df = df.selectExpr("*", "7 as known", "7 as conv", "7 as r", "7 as t", "7 as kind", "7 as copy", "true as gone")
    assert conversations is not None  # read by the SQL under this name
    assert ours(df) == sorted(duckdb.sql(repair.SQL).fetchall(), key=repr)


def test_a_conversation_that_is_dropped_whole(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    [row] = ours(spark.createDataFrame([(gone, 0, "user", "Hi.")], COLUMNS))
    assert row[:8] == (gone, 0, 0, 0, 0, 0, 0, "") and row[8].startswith("e3b0c442")


def test_repaired_turns(spark):
    rows = [("system", "S."), ("user", "A."), ("user", "A."), ("user", "B."), ("assistant", "C.")]
    found = repair.cheapest_edits([Row(r[0], f in ("blank", "duplicate"), f == "truncated") for r, f in zip([r for r, _ in rows], repair.faults(rows))])
    assert found == (4, "KDDKK")
    assert list(repair.repaired(rows, "KDDKK")) == [rows[0], rows[3], rows[4]]
    assert list(repair.repaired([("assistant", "x")], "IK")) == [("user", ""), ("assistant", "x")]
    assert list(repair.repaired([("tool", "x")], "RI")) == [("user", "x"), ("assistant", "")]
