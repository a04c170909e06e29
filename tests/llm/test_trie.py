import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from starlot.llm import trie

COLUMNS = "conv_id bigint, turn bigint, role string, text string"
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest(), text))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in turns.items()}
    members = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        path = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, d == len(path)))
    out = []
    for node, cs in members.items():
        under = [k for k in members if k[: len(node)] == node]
        kids = {k for k in under if len(k) == len(node) + 1}
        leaves = [k for k in under if not any(o[:-1] == k and o for o in members)]
        saved = sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in under if k)
        ends = ",".join(str(c) for c, last in cs if last)
        parent = members[node[:-1]][0][0] if node else None
        out.append((cs[0][0], len(node), parent, len(cs), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def ours(df, **how):
    return sorted(tuple(r) for r in trie.prefix_trie(df, **how).select(*RESULT).collect())


def forest(seed, n, words="abc"):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "assistant"]), rng.choice(words) * rng.randrange(1, 3))
        for c in rng.sample(range(-20, 4 * n), n) for t in range(rng.randrange(1, 7))
    ]


ODD = [
    (5, None, "user", "a"), (5, 1, None, None), (5, 1, None, None), (5, 0, "user", "b"),  # null turn first, repeated rows
    (6, 0, "user", ""), (None, 0, "user", "a"), (None, None, None, None), (7, 2, "user", "é" * 40_000), (8, 2, "assistant", "z"),
    (8, 2, "assistant", "y"), (8, 2, "user", "x"), (9, None, None, None), (1_000_003, 0, "user", "a"), (-7, 0, "user", "a"), (-5, 0, "user", "a"),
]


@pytest.mark.parametrize("bound", [1, 3, 10_000])
def test_against_brute_force(spark, bound):
    rows = ODD + [(c + 100 if c else c, t, r, x) for c, t, r, x in forest(bound, 30)]
    df = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "7 as key", "7 as conv", "7 as depth", "7 as size", "7 as step")
    assert ours(df, bound=bound) == brute(rows)


def test_long_conversations_and_a_common_one(spark):
    """A path of hundreds of turns, and many conversations that are one, are split in few rounds."""
    rows = [(c, t, "user", f"same {t}") for c in range(0, 300, 5) for t in range(4)]
    rows += [(c, t, "user", f"long {t}") for c in (1000, 1005) for t in range(200)]
    got = ours(spark.createDataFrame(rows, COLUMNS), bound=20)
    assert got == brute(rows)


@pytest.mark.parametrize("where", ["sf0.001", "odd", "forest"])
def test_sql_agrees(spark, where):
    if where == "sf0.001":
        path = "/root/testdata/sf0.001/conversations.parquet"
        conversations = duckdb.read_parquet(path)
        got = ours(spark.read.parquet(path))
    else:
        rows = ODD if where == "odd" else forest(4, 60)
        df = spark.createDataFrame(rows, COLUMNS)
        conversations, got = df.toArrow(), ours(df)
    assert conversations is not None  # read by the SQL under this name
    sql = duckdb.sql(trie.SQL)
    assert got == sorted(tuple(r[sql.columns.index(n)] for n in RESULT) for r in sql.fetchall())


def test_members_come_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 7)
    rows = [(c, 0, "user", "hi") for c in range(-60, 120, 3)]
    assert ours(spark.createDataFrame(rows, COLUMNS)) == brute(rows)


def test_empty_table_has_no_node(spark):
    assert ours(spark.createDataFrame([], COLUMNS)) == []
    assert ours(spark.createDataFrame([(None, 0, "user", "a")], COLUMNS)) == []


def test_decomposition_of_random_trees():
    rng = random.Random(2)
    for n in (1, 2, 3, 50, 400):
        parents = [0] + [rng.randrange(max(0, i - 5), i) for i in range(1, n)]
        values = [(rng.randrange(9), 1) for _ in range(n)]
        want = [list(v) for v in values]
        for i in range(n - 1, 0, -1):
            want[parents[i]] = [a + b for a, b in zip(want[parents[i]], want[i])]
        assert trie.decompose(parents, values, [w[1] for w in want]) == [tuple(w) for w in want]
