"""Conversation structure repair: the cheapest edits that make a conversation alternate, by bidirectional Dijkstra.

Legal are no turns at all, or at most one system turn and then pairs of user and assistant. The edit
lattice has a node for each number of rows consumed and each state of that pattern; its edges keep, re-role
or delete the next row, or insert an empty turn. Two heaps run from the untouched conversation and back
from its legal ends. They stop when no pair of open nodes can be as cheap as the best crossing, so
all crossings of that cost are finished; among them the least audit, the concatenated initials of the
edits, is taken. A node's audit is a link to its neighbour's, so memory grows with the rows, and
two audits are compared only back (or on) to where they part.

A conversation is the unit of work: Spark gathers and sorts its rows, one task repairs it, row after row
streaming from one conversation to the next.

Defined cases: null roles and texts are one space. Rows without a conv_id are one conversation, whose id
is null. Rows of one turn stand by role, then text; null turns first. A role that does not start with s, u or a
cannot be kept. A conversation all of whose rows are gone has zeros and an empty audit. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from math import inf
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlot.llm.common import sql_crc32

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
# States: nothing yet, after system, after user, after assistant. What comes next in each, and from where each is reached.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
BEFORE = {START: (), SYSTEM: (), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}


class Row(NamedTuple):
    """What the lattice needs of a row: its role's initial, whether it has to go, whether it is truncated."""

    initial: str
    must_go: bool
    truncated: bool


class Link(NamedTuple):
    """The last (or, in reverse, first) edit of an audit and the rest of it."""

    edit: str
    rest: "Link | None"
    length: int


END = Link("", None, 0)


def _earlier(a: Link, b: Link) -> bool:
    """Whether audit ``a`` is less than ``b``, both read from their far ends up to here."""
    left, right = [], []
    while a is not b:
        if a.length >= b.length:
            left.append(a.edit)
            a = a.rest
        else:
            right.append(b.edit)
            b = b.rest
    return left[::-1] < right[::-1]


def _earlier_on(a: Link, b: Link) -> bool:
    """Whether audit ``a`` is less than ``b``, both read from here on."""
    while a is not b:
        if a.edit != b.edit:
            return a.edit < b.edit
        a, b = a.rest, b.rest
    return False


class Lattice:
    """Edges of the edit lattice; nodes are ``(rows consumed, state)``."""

    def __init__(self, rows: list[Row]):
        self.rows, self.goals = rows, [(len(rows), START), (len(rows), ASSISTANT)]

    def _consuming(self, row: Row, state: int, to: int) -> Iterator[tuple[int, str]]:
        """Costs and edits that take ``row`` from one state to another."""
        if state == to:
            yield DELETE, "D"
        if row.must_go:
            return
        more = TRUNCATED if row.truncated else 0
        if state == START and to == SYSTEM and row.initial == "s":
            yield more, "K"
        letter, following = NEXT[state]
        if following == to:
            if row.initial == letter:
                yield more, "K"
            yield more + REROLE, "R"

    def after(self, node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
        at, state = node
        yield (at, NEXT[state][1]), INSERT, "I"
        if at < len(self.rows):
            for to in {state, NEXT[state][1], SYSTEM if state == START else state}:
                for cost, edit in self._consuming(self.rows[at], state, to):
                    yield (at + 1, to), cost, edit

    def before(self, node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
        at, state = node
        for source in BEFORE[state]:
            yield (at, source), INSERT, "I"
        if at:
            for source in {state, *BEFORE[state], START if state == SYSTEM else state}:
                for cost, edit in self._consuming(self.rows[at - 1], source, state):
                    yield (at - 1, source), cost, edit


class _Search:
    """One direction of Dijkstra. Of nodes of equal cost the one with fewer rows behind it is settled first.

    Edges without cost always consume a row, so all audits of the least cost meet a node before it is settled.
    """

    def __init__(self, sources, edges, sign, less):
        self.edges, self.sign, self.less = edges, sign, less
        self.found = {node: (0, END) for node in sources}
        self.settled: dict[tuple[int, int], tuple[int, Link]] = {}
        self.heap = []
        for node in sources:
            heappush(self.heap, (0, sign * node[0], node[1]))

    def top(self) -> float:
        while self.heap and (self.sign * self.heap[0][1], self.heap[0][2]) in self.settled:
            heappop(self.heap)
        return self.heap[0][0] if self.heap else inf

    def settle(self) -> Iterator[tuple[tuple[int, int], int]]:
        """Settle the nearest node; its neighbours with the cost over it."""
        _, place, state = heappop(self.heap)
        node = (self.sign * place, state)
        cost, link = self.settled[node] = self.found[node]
        for other, more, edit in self.edges(node):
            yield other, cost + more
            if other in self.settled:
                continue
            known = self.found.get(other, (inf, END))
            total = cost + more
            if total > known[0]:
                continue
            new = Link(edit, link, link.length + 1)
            if total < known[0]:
                heappush(self.heap, (total, self.sign * other[0], other[1]))
            elif not self.less(new, known[1]):
                continue
            self.found[other] = (total, new)


def _read_back(link: Link) -> str:
    out = []
    while link.rest is not None:
        out.append(link.edit)
        link = link.rest
    return "".join(out[::-1])


def _read_on(link: Link) -> str:
    return _read_back(link)[::-1]


def cheapest_edits(rows: list[Row]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair, of equally cheap ones the least in ASCII order."""
    if not rows:
        return 0, ""
    lattice = Lattice(rows)
    forward = _Search([(0, START)], lattice.after, 1, _earlier)
    reverse = _Search(lattice.goals, lattice.before, -1, _earlier_on)
    best = inf
    while True:
        a, b = forward.top(), reverse.top()
        if a + b > best or a == b == inf:
            break
        one, other = (reverse, forward) if b <= a else (forward, reverse)
        for node, cost in one.settle():
            if node in other.settled:
                best = min(best, cost + other.settled[node][0])
    # Crossings: edges from a node settled forward to one settled in reverse. Those into a node settled both ways go on
    # to a later crossing that is no worse, unless they end there.
    audits = []
    for node, (cost, link) in forward.settled.items():
        for to, more, edit in lattice.after(node):
            if to in reverse.settled and (to not in forward.settled or to in lattice.goals):
                rest = reverse.settled[to]
                if cost + more + rest[0] == best:
                    audits.append(_read_back(link) + edit + _read_on(rest[1]))
    return int(best), min(audits)


def repaired(rows: list[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """``(role, text)`` of the turns after the edits of ``audit``."""
    at, state = 0, START
    for edit in audit:
        role, text = rows[at] if edit != "I" else ("", "")
        at += edit != "I"
        if edit == "D":
            continue
        if edit == "K" and state == START and role[:1] == "s":
            state = SYSTEM
        else:
            letter, state = NEXT[state]
            role = role if edit == "K" else ROLES[letter]
        yield role, text


def faults(rows: list[tuple[str, str]]) -> list[str]:
    """The first fault of each row: ``blank``, ``duplicate``, ``truncated`` or none."""
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(SPACE)[-1:]
        mark = (role, hashlib.md5(text.encode()).digest())
        out.append("blank" if not end else "duplicate" if mark in seen else "" if end in ".!?" else "truncated")
        seen.add(mark)
    return out


def _repair(rows: list[tuple[str, str]], turns: list[int]) -> tuple:
    """``(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of one conversation."""
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    found = faults(rows)
    initials = [role[:1] for role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = cheapest_edits([Row(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, found)])
    sha = hashlib.sha256()
    for number, (role, text) in enumerate(repaired(rows, audit)):
        sha.update(b"\n" * (number > 0) + f"{role}:{text}".encode())
    return gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha.hexdigest()


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _repairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["known", "conv", *RESULT, "audit", "repaired_sha256"]
    whose, rows, turns = None, [], []
    for batch in batches:
        out = []
        for known, conv, gone, dated, turn, role, text in zip(*[batch[c] for c in ("known", "conv", "gone", "dated", "turn", "role", "text")]):
            if (known, conv) != whose:
                if whose is not None:
                    out.append((*whose, *_repair(rows, turns)))
                whose, rows, turns = (known, conv), [], []
            if not gone:
                rows.append((role, text))
                if dated:
                    turns.append(turn)
        yield pd.DataFrame(out, columns=columns)
    if whose is not None:
        yield pd.DataFrame([(*whose, *_repair(rows, turns))], columns=columns)


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage: ``(conv_id, turn, role, text, gone)``; dropped rows stay as marks of their conversation."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    role, text = F.col("r"), F.col("t")
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        spaced("role").alias("r"), spaced("text").alias("t"), kind.alias("kind"),
    )
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (F.col("kind") == 0).alias("gone"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row a conversation of ``(conv_id, turn, role, text)``: faults, cost, audit and digest of the repaired text.

    Rows with a true ``gone`` (if there is such a column) only tell that their conversation exists.
    """
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    zero = F.lit(0).cast("bigint")
    ready = rows.select(
        F.col("conv_id").isNotNull().alias("known"), F.coalesce("conv_id", zero).alias("conv"),
        (F.col("gone") if "gone" in rows.columns else F.lit(False)).alias("gone"), F.col("turn").isNotNull().alias("dated"),
        F.coalesce("turn", zero).alias("turn"), spaced("role"), spaced("text"),
    )
    ordered = ready.repartition("conv", "known").sortWithinPartitions("known", "conv", "dated", "turn", "role", "text")
    schema = "known boolean, conv bigint, " + ", ".join(f"{c} bigint" for c in RESULT) + ", audit string, repaired_sha256 string"
    found = ordered.mapInPandas(_repairs, schema)
    return found.select(F.when(F.col("known"), F.col("conv")).alias("conv_id"), *RESULT, "audit", "repaired_sha256")


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def _sql_step(acc: str, row: str) -> str:
    """One row of the same lattice as a fold: the cheapest ``cost and audit`` of each state, as texts that sort."""
    def add(label: str, cost: str, edit: str, when: str = "true") -> str:
        total = f"lpad(CAST(CAST({label}[1:9] AS INT) + {cost} AS VARCHAR), 9, '0') || {label}[10:] || '{edit}'"
        return f"CASE WHEN {label} = '~' OR NOT ({when}) THEN '~' ELSE {total} END"

    free, more = f"{row}[2] = '0'", f"CAST({row}[3] AS INT)"
    at = {q: f"{acc}[{q + 1}]" for q in range(4)}
    gone = {q: add(at[q], str(DELETE), "D") for q in range(4)}
    system = add(at[START], more, "K", f"{free} AND {row}[1] = 's'")

    def to(letter: str, sources: tuple[int, ...]) -> str:
        kept = [add(at[q], more, "K", f"{free} AND {row}[1] = '{letter}'") for q in sources]
        return ", ".join(kept + [add(at[q], f"{more} + {REROLE}", "R", free) for q in sources])

    labels = f"[{gone[0]}, least({gone[1]}, {system}), least({gone[2]}, {to('u', BEFORE[USER])}), least({gone[3]}, {to('a', BEFORE[ASSISTANT])})]"
    # Inserted turns: first those to a user, then, from what that gives, those to an assistant.
    user = f"list_transform([{labels}], lambda l: [l[1], l[2], least(l[3], {', '.join(add(f'l[{q + 1}]', str(INSERT), 'I') for q in BEFORE[USER])}), l[4]])"
    return f"list_transform({user}, lambda l: [l[1], l[2], l[3], least(l[4], {add('l[3]', str(INSERT), 'I')})])[1]"


# Before the first row two turns may be inserted.
_ONE, _TWO = (f"{k * INSERT:09d}{'I' * k}" for k in (1, 2))
SQL = f"""
WITH k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t,
         {sql_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE r END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(t, '.!?', '') ELSE t END AS text
  FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         left(role, 1) AS initial FROM d
), b AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM o
), f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN seen THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal FROM b
), g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal,
         list([initial, CASE WHEN fault IN ('blank', 'duplicate') THEN '1' ELSE '0' END,
               CASE WHEN fault = 'truncated' THEN '{TRUNCATED}' ELSE '0' END] ORDER BY i) AS rows FROM f GROUP BY conv_id
), s AS (
  SELECT *, list_reduce(list_concat([['000000000', '~', '{_ONE}', '{_TWO}']], rows), lambda acc, x: {_sql_step("acc", "x")}) AS labels FROM g
), a AS (
  SELECT *, least(labels[1], labels[4]) AS best FROM s
), e AS (
  SELECT conv_id, p, substr(best, 9 + CAST(p AS INT), 1) AS edit FROM (SELECT conv_id, best, unnest(range(1, length(best) - 8)) AS p FROM a)
), n AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w AS place FROM e
  WINDOW w AS (PARTITION BY conv_id ORDER BY p ROWS UNBOUNDED PRECEDING)
), m AS (
  SELECT n.*, f.role, f.text, max(CASE WHEN edit = 'K' AND place = 1 AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY n.conv_id) AS system
  FROM n LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM n.conv_id AND f.i = n.i AND edit <> 'I' WHERE edit <> 'D'
), t AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || coalesce(text, ''), chr(10) ORDER BY place) AS whole FROM m GROUP BY conv_id
), c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(CAST(best[1:9] AS BIGINT), 0) AS BIGINT) AS cost,
       coalesce(best[10:], '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM c LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""
