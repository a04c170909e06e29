"""Substring dedup: words covered by a window of ``WIDTH`` words that already stood earlier are removed.

A Rabin-Karp hash rolls over every window of every text. Equal windows have equal parts, so a
window is counted only if its rarest-looking part, the one of least hash among its parts of ``PART`` words,
stands in the corpus more than once; any other window occurs once and needs no row. Spark counts those
marks, then the remaining windows by two independent rolling hashes, each under its smallest document.
A document keeps the windows it owns, the first of each of its own repeats included, and loses
all others: neighbouring starts merge into maximal intervals of words.

Texts that are equal word by word are counted once, under the smallest id; the others lose all words if they
hold a window. Both counts combine before their shuffle, so a passage that all documents share costs
one row a task. What is shuffled of a text is one mark in seven windows and the windows with a
repeated mark; the text itself only moves to meet those, once, and only texts with such a mark move again.

Defined cases: a null text has no words; texts shorter than a window keep all. A null id counts as the
largest, 2**63 - 1, which is read as null too. Rows of one id are no earlier than each other: equal rows get equal results, different
texts under one id keep what they share. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlot.llm.common import text_or_empty
from starlot.session import materialise, shared_folder

WIDTH = 20
PART = 8
LAST_ID = 2**63 - 1
# Texts are split to words in pieces of about so many bytes, so that a long one never stands in memory word by word.
PIECE = 1 << 20
# Two word hashes and two odd bases: independent values modulo 2**64.
SEEDS = (b"starlot-passage1", b"starlot-passage2")
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
MASK = 2**64 - 1


def word_pieces(text: str) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; ``bytes.split`` cuts at exactly the contract's separators."""
    data, start = text.encode(), 0
    while start < len(data):
        end = start + PIECE
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        words = data[start:end].split()
        if words:
            yield words
        start = end


def word_hashes(words: list[bytes], which: int) -> np.ndarray:
    return pd.util.hash_array(np.array(words, dtype=object), hash_key=SEEDS[which].decode(), categorize=False)


class Roll:
    """Rolling hashes of all windows of an array of word hashes, in one pass of prefix sums.

    The hash of a window is the sum of its word hashes times rising powers of the base: a difference of
    prefix sums, shifted to the window's start by powers of the inverse.
    """

    def __init__(self, which: int):
        self.base, self.inverse = BASES[which], pow(BASES[which], -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, hashes: np.ndarray, *widths: int) -> list[np.ndarray]:
        n = len(hashes)
        if len(self.up) < n + 1:
            self.up = self._powers(self.base, 2 * n)
            self.down = self._powers(self.inverse, 2 * n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * self.up[:n], out=sums[1:])
        return [(sums[w:] - sums[: n + 1 - w]) * self.down[: n + 1 - w] for w in widths]

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        steps = np.full(n + 1, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads rolling hashes, so that the least one is an arbitrary part."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def window_marks(parts: np.ndarray, width: int, part: int) -> np.ndarray:
    """The mark of each window: the least of the hashes of its parts, by doubling."""
    span, least = width - part + 1, parts
    size = 1
    while 2 * size <= span:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    if size < span:
        rest = span - size
        least = np.minimum(least[: len(least) - rest], least[rest:])
    return least


def _facts(rows: Iterator[pd.DataFrame], width: int, part: int) -> Iterator[pd.DataFrame]:
    """``(id, n_words, sha, marks)``; a mark whose part stands twice in the text is listed twice."""
    roll = Roll(0)
    for batch in rows:
        out = []
        for key, text in zip(batch["id"], batch["t"]):
            sha, hashes, n = hashlib.sha256(), [], 0
            for words in word_pieces(text):
                sha.update(b" " * (n > 0) + b" ".join(words))
                hashes.append(word_hashes(words, 0))
                n += len(words)
            marks = np.zeros(0, np.uint64)
            if n >= width:
                parts = _mixed(roll(np.concatenate(hashes), part)[0])
                marks = np.unique(window_marks(parts, width, part))
                ordered = np.sort(parts)
                twice = np.searchsorted(ordered, marks, "right") - np.searchsorted(ordered, marks, "left") > 1
                marks = np.concatenate([marks, marks[twice]])
            out.append((key, n, sha.digest(), marks.view(np.int64)))
        yield pd.DataFrame(out, columns=["id", "n_words", "sha", "marks"])


class _Windows:
    """The windows of a text that have one of the given marks: their starts and both hashes."""

    def __init__(self, width: int, part: int):
        self.width, self.part, self.rolls = width, part, (Roll(0), Roll(1))

    def __call__(self, pieces: list[list[bytes]], again: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.concatenate([word_hashes(words, 0) for words in pieces])
        second = np.concatenate([word_hashes(words, 1) for words in pieces])
        parts, a = self.rolls[0](first, self.part, self.width)
        marks = window_marks(_mixed(parts), self.width, self.part)
        starts = np.flatnonzero(np.isin(marks, np.asarray(again).view(np.uint64)))
        b = self.rolls[1](second, self.width)[0]
        keys = np.empty(len(starts), [("a", np.int64), ("b", np.int64)])
        keys["a"], keys["b"] = a[starts].view(np.int64), b[starts].view(np.int64)
        return starts, keys


def _candidates(rows: Iterator[pd.DataFrame], width: int, part: int) -> Iterator[pd.DataFrame]:
    """``(a, b, id)``: each distinct window of a text that may stand elsewhere."""
    windows = _Windows(width, part)
    for batch in rows:
        found, keys = [], []
        for key, text, again in zip(batch["id"], batch["t"], batch["again"]):
            pieces = list(word_pieces(text))
            if sum(map(len, pieces)) < width:
                continue
            own = np.unique(windows(pieces, again)[1])
            found.append(own)
            keys.append(np.full(len(own), key, np.int64))
        if found:
            every = np.concatenate(found)
            yield pd.DataFrame({"a": every["a"], "b": every["b"], "id": np.concatenate(keys)})


def removal_intervals(starts: np.ndarray, width: int) -> np.ndarray:
    """Rows ``(from, to)``, end exclusive: the maximal runs of words covered by windows at ``starts`` (ascending)."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    gap = np.flatnonzero(np.diff(starts) > width)
    return np.stack([starts[np.r_[0, gap + 1]], starts[np.r_[gap, len(starts) - 1]] + width], axis=1)


def _removals(rows: Iterator[pd.DataFrame], width: int, part: int) -> Iterator[pd.DataFrame]:
    """``(id, sha, intervals, n_removed, kept_sha256)`` of the texts with candidate windows."""
    windows = _Windows(width, part)
    for batch in rows:
        out = []
        for key, text, again, own_a, own_b in zip(batch["id"], batch["t"], batch["again"], batch["own_a"], batch["own_b"]):
            pieces = list(word_pieces(text))
            n = sum(map(len, pieces))
            if n < width:
                continue
            starts, keys = windows(pieces, again)
            owned = np.empty(0 if own_a is None else len(own_a), keys.dtype)
            if len(owned):
                owned["a"], owned["b"] = own_a, own_b
            # The first start of each owned window stays, its repeats in the text do not.
            first = np.zeros(len(keys), bool)
            first[np.unique(keys, return_index=True)[1]] = True
            spans = removal_intervals(starts[~(first & np.isin(keys, owned))], width)
            gone = np.zeros(n, bool)
            for begin, end in spans:
                gone[begin:end] = True
            sha, kept, at, left = hashlib.sha256(), hashlib.sha256(), 0, 0
            for words in pieces:
                sha.update(b" " * (at > 0) + b" ".join(words))
                stay = [w for w, lost in zip(words, gone[at : at + len(words)]) if not lost]
                if stay:
                    kept.update(b" " * (left > 0) + b" ".join(stay))
                at, left = at + len(words), left + len(stay)
            out.append((key, sha.digest(), spans.tolist(), int(gone.sum()), kept.hexdigest()))
        yield pd.DataFrame(out, columns=["id", "sha", "intervals", "n_removed", "kept_sha256"])


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, part: int = PART) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, intervals)``, one row a document.

    ``intervals`` lists ``[from, to]`` in words, end exclusive, of what is removed.
    """
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession, "passages")
    key = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST_ID))
    texts = docs.select(key.alias("id"), text_or_empty(text).alias("t"))
    facts = materialise(texts.mapInPandas(
        lambda rows: _facts(rows, width, part), "id bigint, n_words bigint, sha binary, marks array<bigint>"
    ), f"{folder}/facts")

    whole = facts.where(F.col("n_words") >= width)
    one = whole.groupBy("sha").agg(F.min("id").alias("id"), F.first("marks").alias("marks"))
    one = materialise(one, f"{folder}/texts")
    # Marks of one text only, told to that text; all others stand more than once.
    lone = one.select("id", F.explode("marks").alias("mark")).groupBy("mark").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    lone = lone.where("n = 1").groupBy("id").agg(F.collect_list("mark").alias("lone"))
    again = one.select("id", "marks").join(lone, "id", "left").select(
        "id", F.array_except("marks", F.coalesce("lone", F.array().cast("array<bigint>"))).alias("again")
    )
    again = again.where(F.size("again") > 0).groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("again"))).alias("again"))
    met = materialise(texts.join(again, "id"), f"{folder}/met")

    owners = met.mapInPandas(lambda rows: _candidates(rows, width, part), "a bigint, b bigint, id bigint")
    owners = owners.groupBy("a", "b").agg(F.min("id").alias("id"))
    owned = owners.groupBy("id").agg(F.collect_list(F.struct("a", "b")).alias("own"))
    owned = owned.select("id", F.col("own.a").alias("own_a"), F.col("own.b").alias("own_b"))
    removed = met.join(owned, "id", "left").mapInPandas(
        lambda rows: _removals(rows, width, part),
        "id bigint, sha binary, intervals array<array<bigint>>, n_removed bigint, kept_sha256 string",
    )
    removed = removed.dropDuplicates(["id", "sha"]).withColumnRenamed("n_removed", "lost")

    first = one.select("sha", F.col("id").alias("first"))
    copy = F.col("first") < F.col("id")
    all_of_it = F.array(F.array(F.lit(0).cast("bigint"), F.col("n_words")))
    found = facts.select("id", "n_words", "sha").join(first, "sha", "left").join(removed, ["id", "sha"], "left")
    return found.select(
        F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("lost", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
        F.when(copy, all_of_it).otherwise(F.coalesce("intervals", F.array().cast("array<array<bigint>>"))).alias("intervals"),
    )


def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("intervals")


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(doc_id, {LAST_ID}) AS id, doc_id,
         list_filter(string_split(translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '),
                     lambda x: x <> '') AS ws FROM documents
), w AS (
  SELECT r, id, i, array_to_string(ws[i : i + {WIDTH - 1}], ' ') AS x
  FROM (SELECT r, id, ws, unnest(range(1, len(ws) - {WIDTH - 2})) AS i FROM d)
), o AS (
  SELECT r, i, id > min(id) OVER (PARTITION BY x) OR i > min(i) OVER (PARTITION BY x, r) AS later FROM w
), gone AS (
  SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + {WIDTH})) AS p FROM o WHERE later)
), each AS (
  SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d
), kept AS (
  SELECT r, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS t FROM each ANTI JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
