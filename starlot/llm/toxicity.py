"""Toxicity of texts by a learned lexicon, matched through Levenshtein automata, with context windows.

1. A bounded sample of labelled rows is taken, at most ``PER_CLASS`` of each class, those with the smallest
   hash of their id; near copies in it count once. Words and word beginnings that stand in toxic
   documents far more often than in others become the lexicon, at most ``TERMS`` with their log odds.
2. The lexicon is a trie. Its product with the Levenshtein automaton of each term, 1 edit from 5 letters
   on and 2 from 9 on, is made deterministic step by step as words ask for it, so a word costs one
   look-up a letter whatever the size of the lexicon, and most words leave it after a few letters.
3. The characters around a match tell quotation from abuse: inside quotation marks, on a quoted line or
   after a word that reports speech a match keeps a quarter of its weight.
4. A logistic regression on sums of exact and misspelled matches, fitted on the sample's features
   (5 numbers a row), gives the score. The fit runs on the driver, over the bounded sample only.

Rows whose crc32(doc_id as text) mod ``FOLDS`` is 0 are held out: their labels are never read. Scores
depend on the text alone. Scoring is one pass over the documents without a shuffle.

Defined cases: null and empty texts have the score of a text without matches; without labels of both
classes that is the sample's share of toxic rows, 0 if there are none; a document labelled twice is
toxic if one label says so; a null id is not held out; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlot.llm.common import text_or_empty, windows
from starlot.session import materialise, shared_folder

FOLDS = 5
PER_CLASS = 10_000
TERMS = 400
LEAST_DOCS = 4
LEAST_ODDS = 2.0
PREFIXES = range(4, 8)
WINDOW = 60
QUOTED_SHARE = 0.25
CACHED_WORDS = 300_000
CACHED_STATES = 100_000

WORD = re.compile(r"[^\W\d_]+")
# Words with digits and symbols for letters; what stands for a letter, and what may stand for any.
SPELT = re.compile(r"(?<![^\W_])[\d@$]{0,2}[^\W\d_]++(?:[\d*@$!]{1,3}[^\W\d_]++)*+[@$]{0,2}")
LETTERS = str.maketrans("0134578@$!", "oieastbasi")
ANY = "*"
# Marks that open and close quotations, and words that report speech.
MARKS = (('"', '"'), ("“", "”"), ("„", "“"), ("«", "»"), ("»", "«"))
REPORTS = frozenset("said says say called calls wrote writes quote quoted quoting term word sagte schrieb nannte dit appelle dijo llama".split())


def held_out(doc_id: str):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def edits(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


class Matcher:
    """The lexicon's trie crossed with the automata of its terms, made deterministic on demand.

    A state is a set of (trie node, edits so far) and the best that beginnings have matched already.
    ``weights(word)`` gives the largest weight of an exact and of a misspelled match, 0 for none.
    """

    def __init__(self, terms: list[tuple[str, bool, float]]):
        self.children: list[dict[str, int]] = [{}]
        self.word: dict[int, tuple[float, int]] = {}
        self.begin: dict[int, tuple[float, int]] = {}
        self.room = [0]
        for term, beginning, weight in terms:
            node, most = 0, edits(len(term))
            self.room[0] = max(self.room[0], most)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.room.append(0)
                node = self.children[node][letter]
                self.room[node] = max(self.room[node], most)
            (self.begin if beginning else self.word)[node] = (weight, most)
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.results: list[tuple[float, float] | None] = []
        self.start = self._number({0: 0}, 0.0, 0.0)

    def _number(self, nodes: dict[int, int], exact: float, fuzzy: float) -> int:
        """The state's number after adding what missing letters reach and what beginnings match."""
        todo = list(nodes.items())
        while todo:
            node, e = todo.pop()
            if nodes[node] < e:
                continue
            for child in self.children[node].values():
                if e + 1 <= self.room[child] and nodes.get(child, 99) > e + 1:
                    nodes[child] = e + 1
                    todo.append((child, e + 1))
        for node, e in nodes.items():
            weight, most = self.begin.get(node, (0.0, -1))
            if e == 0 and weight:
                exact = max(exact, weight)
            elif 0 < e <= most:
                fuzzy = max(fuzzy, weight)
        key = (tuple(sorted(nodes.items())), exact, fuzzy)
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            self.results.append(None)
        return self.numbers[key]

    def _step(self, state: int, letter: str) -> int:
        nodes, exact, fuzzy = self.states[state]
        after: dict[int, int] = {}
        for node, e in nodes:
            for other, child in self.children[node].items():
                cost = e + (other != letter and letter != ANY)
                if cost <= self.room[child] and after.get(child, 99) > cost:
                    after[child] = cost
            if e + 1 <= self.room[node] and after.get(node, 99) > e + 1:
                after[node] = e + 1
        self.steps[state][letter] = found = self._number(after, exact, fuzzy)
        return found

    def _result(self, state: int) -> tuple[float, float]:
        if self.results[state] is None:
            nodes, exact, fuzzy = self.states[state]
            for node, e in nodes:
                weight, most = self.word.get(node, (0.0, -1))
                if e == 0 and weight:
                    exact = max(exact, weight)
                elif 0 < e <= most:
                    fuzzy = max(fuzzy, weight)
            self.results[state] = (exact, fuzzy if not exact else 0.0)
        return self.results[state]

    def weights(self, word: str) -> tuple[float, float]:
        if len(self.states) > CACHED_STATES:
            self._forget()
        state, steps = self.start, self.steps
        for letter in word:
            following = steps[state].get(letter)
            state = self._step(state, letter) if following is None else following
            if not self.states[state][0]:
                break
        return self._result(state)


def quoted(text: str, start: int, end: int) -> bool:
    """Whether the window around a match looks like quotation."""
    line = text.rfind("\n", 0, start) + 1
    before = text[max(line, start - WINDOW):start]
    stop = text.find("\n", end)
    after = text[end:min(end + WINDOW, stop if stop >= 0 else len(text))]
    if text[line:line + 1] == ">":
        return True
    for opening, closing in MARKS:
        if closing in after:
            at = before.rfind(opening)
            inside = before.count(opening) % 2 == 1 if opening == closing else at > before.rfind(closing)
            if at >= 0 and inside:
                return True
    return any(w in REPORTS for w in WORD.findall(before)[-3:])


class Features:
    """Five numbers of a text: sums of exact and misspelled matches, the heaviest of each, and their share of words."""

    def __init__(self, terms: list[tuple[str, bool, float]]):
        self.matcher, self.seen = Matcher(terms), {}

    def _spelt(self, run: str) -> tuple[float, float]:
        """Weights of a word with digits and symbols in it; any match is a misspelled one."""
        read = [run, run.translate(LETTERS), run.replace("1", "l").translate(LETTERS)]
        stars, letters = run.count(ANY), sum(c.isalpha() for c in run)
        # Products of short names are no words.
        read = [r for r in read if not stars or (len(run) >= 4 and stars <= letters)]
        return 0.0, max([w for r in read for w in self.matcher.weights(r)], default=0.0)

    def of(self, text: str) -> tuple[float, ...]:
        low = text.lower()
        words = WORD.findall(low)
        hits = {}
        for word in set(words):
            found = self.seen.get(word)
            if found is None:
                if len(self.seen) >= CACHED_WORDS:
                    self.seen.clear()
                found = self.seen[word] = self.matcher.weights(word)
            if found[0] or found[1]:
                hits[word] = found
        spelt = {}
        for run in set(SPELT.findall(low)).difference(words):
            found = self.seen.get(run)
            if found is None:
                found = self.seen[run] = self._spelt(run)
            if found[1] and not any(w in hits for w in WORD.findall(run)):
                spelt[run] = found
        if not hits and not spelt:
            return (0.0,) * 5
        exact = fuzzy = most = near = 0.0
        for pattern, known in ((WORD, hits), (SPELT, spelt)):
            for m in pattern.finditer(low) if known else ():
                if m[0] in known:
                    share = QUOTED_SHARE if quoted(low, m.start(), m.end()) else 1.0
                    a, b = known[m[0]]
                    exact, fuzzy, most, near = exact + share * a, fuzzy + share * b, max(most, share * a), max(near, share * b)
        return (math.log1p(exact), math.log1p(fuzzy), most, near, math.log1p(100 * (exact + fuzzy) / len(words)))


def _features(terms):
    @F.pandas_udf("array<double>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features(terms)
        for batch in texts:
            yield pd.Series([list(features.of(t)) for t in batch])

    return run


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, per_class: int) -> DataFrame:
    """``(text, label)`` of the sample: labelled rows that are not held out, one of each sketch."""
    own = labels.where(~held_out(doc_id) & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("lid")).agg(F.max(label).alias("label"))
    order = (F.xxhash64("lid"), F.col("lid"))
    some = own.where("label = 0").orderBy(*order).limit(per_class).union(own.where("label = 1").orderBy(*order).limit(per_class))
    # At most 2 * per_class rows of two numbers: bounded, so broadcast.
    rows = docs.select(F.col(doc_id).alias("id"), text_or_empty(text).alias("text")).join(F.broadcast(some), F.col("id") == F.col("lid"))
    ws = F.split(F.col("text"), r"\s+", -1)
    rows = rows.withColumn("ws", ws)
    keys = F.transform(windows(F.size("ws"), 3), lambda i: F.xxhash64(F.get("ws", i), F.get("ws", i + 1), F.get("ws", i + 2)))
    sketched = rows.select("id", "text", "label", F.coalesce(F.array_min(keys), F.xxhash64("text")).alias("sketch"))
    # Of equal sketches the smallest id stays, toxic rows first.
    return sketched.groupBy("sketch").agg(F.max_by(F.struct("text", "label"), F.struct("label", -F.col("id"))).alias("r")).select("r.text", "r.label")


def lexicon(rows: DataFrame, terms: int = TERMS) -> list[tuple[str, bool, float]]:
    """``(term, whether a beginning, log odds)``; at most ``terms``, the strongest first."""
    ws = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}]+", -1), lambda w: F.length(w) > 2))
    starts = [F.transform(F.filter("ws", lambda w, n=n: F.length(w) > n), lambda w, n=n: F.struct(F.substring(w, 1, n).alias("term"), F.lit(True).alias("begin"))) for n in PREFIXES]
    whole = F.transform("ws", lambda w: F.struct(w.alias("term"), F.lit(False).alias("begin")))
    each = rows.select("label", ws.alias("ws")).select("label", F.explode(F.array_distinct(F.concat(whole, *starts))).alias("t"))
    counted = each.groupBy("t.term", "t.begin").agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("all"))
    sizes = rows.agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("all")).first()
    pos, neg = sizes["pos"] or 0, sizes["all"] - (sizes["pos"] or 0)
    if not pos or not neg:
        return []
    odds = F.log((F.col("pos") + 0.5) / F.lit(pos + 1.0)) - F.log((F.col("all") - F.col("pos") + 0.5) / F.lit(neg + 1.0))
    strong = counted.where(F.col("pos") >= LEAST_DOCS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    found = strong.orderBy(F.desc("odds"), F.desc("pos"), "begin", "term").limit(4 * terms).collect()
    out, begins = [], {}
    for r in sorted(found, key=lambda r: (not r["begin"], len(r["term"]), r["term"])):
        # A term adds nothing to a beginning of it that is as good a sign.
        if any(begins.get(r["term"][:n], -1.0) >= r["odds"] - 0.5 for n in PREFIXES if n <= len(r["term"])):
            continue
        if r["begin"]:
            begins[r["term"]] = r["odds"]
        out.append((r["term"], r["begin"], float(r["odds"])))
    return sorted(out, key=lambda x: (-x[2], x[0], x[1]))[:terms]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 50) -> np.ndarray:
    """Coefficients of a logistic regression, the constant first, by Newton steps with a quadratic penalty."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    ridge = penalty * np.eye(a.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        move = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ w)
        w = w + move
        if np.abs(move).max() < 1e-8:
            break
    return w


def score_documents(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    per_class: int = PER_CLASS, terms: int = TERMS,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row, learned from the labels that are not held out."""
    rows = materialise(sample(docs, labels, doc_id, text, label, per_class), shared_folder(docs.sparkSession, "toxicity"))
    words = lexicon(rows, terms)
    run = _features(words)
    known = rows.select(run("text").alias("x"), "label").collect()
    y = np.array([r["label"] for r in known], dtype=float)
    if len(set(y)) == 2:
        weights = fit(np.array([r["x"] for r in known]), y)
    else:
        share = min(max(float(y.mean()) if len(y) else 0.0, 0.0), 1.0)
        weights = np.array([math.log(share / (1 - share)) if 0 < share < 1 else (30.0 if share else -800.0)] + [0.0] * 5)
    x = F.col("x")
    linear = F.lit(float(weights[0]))
    for k, w in enumerate(weights[1:]):
        linear = linear + F.lit(float(w)) * F.get(x, F.lit(k))
    scored = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), run(text_or_empty(text)).alias("x"))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-linear))
    return scored.withColumn("score", score).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_toxicity_scores(spark, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
