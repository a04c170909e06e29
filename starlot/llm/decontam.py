"""Benchmark leaks in documents, also with other names, numbers and units, by template windows.

Texts become words in lower case, and each text is read in three ways. ``TYPED``: numbers, names (a
capital inside a sentence) and units are typed slots. ``OPEN``: any word with a capital and a small letter
is a name, number words are numbers, and neighbouring names or number words are one slot. ``PLAIN``: words
as they stand, so that upper and lower case and kinds of blanks make no difference. Windows of ``WIDTH``
words are hashed and the documents' windows joined with the benchmark's. A window made of slots (``PLAIN``:
numbers) for more than half is no evidence and not used, nor is the open reading of an item in which fewer
than half of the windows are evidence. For each
document, item and reading the windows that met are checked for slot consistency: along a run of one
alignment, an item's value must always stand for the same value in the document and the other way
round, so a passage whose numbers differ by one consistent replacement is a leak, and a table that
only looks alike is not. An item has leaked if consistent windows are ``least`` percent of its
windows or more in one reading. Items of 5 to 7 words are one window of their own width, shorter ones never match.

A window goes to the join only if its hash falls on one of ``FILTER`` positions that the benchmark has
set, a filter of fixed size that most windows fail. The benchmark's windows, and the keys of documents
with enough of them, are broadcast if they are at most ``BROADCAST_WINDOWS`` (counted first; about 24
bytes each), else joined by shuffle. Documents are not shuffled but in that last case.

Defined cases: null and empty texts never match, on either side; repeated rows give one result row
(``leaks``) and are all removed (``without_leaks``); an empty benchmark leaks nowhere; an item
without an id is reported as -1; other columns
are ignored or returned unchanged.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlot.llm.common import packed, text_or_empty, unpacked
from starlot.session import materialise, shared_folder

WIDTH = 8
SHORTEST = 5
LEAST = 50
BROADCAST_WINDOWS = 1_000_000
FILTER = 1 << 22
MIX = np.uint64(0x9E3779B97F4A7C15)

# Units of measure, time and money that stand for a slot.
UNITS = (
    "mm", "cm", "km", "mg", "kg", "ml", "lb", "lbs", "oz", "ft", "kwh", "mph", "kmh",
    "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles", "metre", "metres", "meter", "meters",
    "gram", "grams", "kilogram", "kilograms", "ounce", "ounces", "pound", "pounds", "litre", "litres", "liter", "liters",
    "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years",
    "cent", "cents", "dollar", "dollars", "euro", "euros", "usd", "eur", "gbp", "percent",
)
NUMBER_WORDS = (
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen",
    "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty",
    "ninety", "hundred", "thousand", "million", "billion",
)
NAME_MARK, FIRST_MARK = "\u0001", "\u0002"
NUMBER, NAME, UNIT = -1, -2, -3
TYPED, OPEN, PLAIN = 0, 1, 2
# Kinds of words, in the lowest bits of their codes; the last are units and number words, told apart by their hash.
DIGITS, INSIDE, FIRST, OTHER = 1, 2, 3, 7
KIND = 7


# Separators of words; everything else is a letter, a mark or a digit for this purpose.
SEPARATOR = r"[\x00\x03-/:-@\[-`{-\u00a9\u00ab-\u00b4\u00b6-\u00b9\u00bb-\u00bf\u00d7\u00f7\u2000-\u206f\u3000-\u303f]+"


def tokens(text: Column) -> Column:
    """Words in lower case; names carry a mark, separators inside numbers are gone."""
    plain = F.regexp_replace(F.translate(text, NAME_MARK + FIRST_MARK, "  "), r"[.,](?=\p{N})(?<=\p{N}.)", "")
    named = F.regexp_replace(plain, r"([ \t])(?=\p{Lu}\p{Ll})(?<=[^.!?:\s].)", f"$1{NAME_MARK}")
    named = F.regexp_replace(named, rf"(?=\p{{Lu}}\p{{Ll}})(?<![\p{{L}}\p{{M}}\p{{N}}{NAME_MARK}])", FIRST_MARK)
    return F.array_remove(F.split(F.lower(named), SEPARATOR, -1), "")


def codes(toks: Column) -> Column:
    """One number a token: a hash of the word, its kind in the lowest bits."""
    def one(w: Column) -> Column:
        coded = lambda x, kind: F.xxhash64(x).bitwiseAND(F.lit(~KIND).cast("long")).bitwiseOR(F.lit(kind).cast("long"))
        marked = F.when(w.startswith(NAME_MARK), coded(F.substring(w, 2, 1 << 30), INSIDE)).when(w.startswith(FIRST_MARK), coded(F.substring(w, 2, 1 << 30), FIRST))
        # The marks and digits sort before letters, so one comparison is enough for ordinary words.
        return F.when(w < ":", marked.otherwise(coded(w, DIGITS))).when(w.isin(*UNITS, *NUMBER_WORDS), coded(w, OTHER)).otherwise(coded(w, 0))

    return F.transform(toks, one)


def _hashes(spark, words: tuple[str, ...]) -> np.ndarray:
    return np.array(spark.range(1).select(F.array(*[F.xxhash64(F.lit(w)) for w in words])).first()[0], dtype=np.int64) & ~KIND


def read(cs: np.ndarray, reading: int, units: np.ndarray, numbers: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ts, number, kept)`` of texts laid end to end: templates, which words are numbers, and the places of the words kept."""
    kind, ts = cs & KIND, cs & ~KIND
    digits, every = kind == DIGITS, np.arange(len(cs))
    if reading == PLAIN or not len(cs):
        return ts, digits, every
    ts, other = ts.copy(), np.flatnonzero(kind == OTHER)
    first = np.zeros(len(cs) + 1, dtype=bool)
    first[0] = True
    first[ends] = True
    spelt, name = np.zeros(len(cs), dtype=bool), kind == INSIDE
    if reading == OPEN:
        spelt[other[np.isin(ts[other], numbers)]] = True
        name |= kind == FIRST
    number = digits | spelt
    unit = other[np.isin(ts[other], units)]
    unit = unit[~first[unit]]
    unit = unit[number[unit - 1]]
    ts[number], ts[name], ts[unit] = NUMBER, NAME, UNIT
    if reading == TYPED:
        return ts, number, every
    again = np.zeros(len(cs), dtype=bool)
    again[1:] = ((name[1:] & name[:-1]) | (spelt[1:] & spelt[:-1])) & ~first[1:-1]
    kept = np.flatnonzero(~again)
    return ts[kept], number[kept], kept


def window_hashes(ts: np.ndarray, width: int, reading: int = TYPED) -> np.ndarray:
    """Hash of each window of ``width`` numbers."""
    n = max(0, len(ts) - width + 1)
    h, x = np.full(n, width + 16 * reading, dtype=np.uint64), ts.view(np.uint64)
    for k in range(width):
        h = (h ^ x[k:k + n]) * MIX
        h = h ^ (h >> np.uint64(29))
    return h.view(np.int64)


def _of_items(units: np.ndarray, numbers: np.ndarray):
    """``(item, reading, ipos, width, iw)`` of the windows that are evidence."""
    def run(batches):
        for b in batches:
            for item, cs in zip(b["item"], b["cs"]):
                cs = np.asarray(cs, dtype=np.int64)
                for reading in (TYPED, OPEN, PLAIN):
                    ts, number, _ = read(cs, reading, units, numbers, np.array([len(cs)]))
                    if len(ts) < SHORTEST:
                        continue
                    width = min(len(ts), WIDTH)
                    found = window_hashes(ts, width, reading)
                    slot = number if reading == PLAIN else (ts >= UNIT) & (ts <= NUMBER)
                    slots = np.concatenate([[0], np.cumsum(slot)])
                    at = np.flatnonzero(2 * (slots[width:] - slots[:-width]) <= width)
                    if reading == OPEN and 2 * len(at) < len(found):
                        continue
                    yield pd.DataFrame({"item": item, "reading": reading, "ipos": at, "width": width, "iw": found[at]})

    return run


def _of_docs(kinds: list[tuple[int, int]], positions: np.ndarray, units: np.ndarray, numbers: np.ndarray):
    """``(key, pos, w)`` of the windows whose hash falls on a position that the benchmark has set; ``kinds`` are readings and widths."""
    wanted = np.zeros(FILTER, dtype=bool)
    wanted[positions] = True

    def run(batches):
        for b in batches:
            arrays = [np.asarray(x, dtype=np.int64) for x in b["cs"]]
            sizes = np.array([len(x) for x in arrays], dtype=np.int64)
            held = np.cumsum(sizes) // 2_000_000
            for part in np.unique(held):
                rows = np.flatnonzero(held == part)
                whole, keys = np.concatenate([arrays[r] for r in rows]), b["key"].to_numpy()[rows]
                last = np.cumsum(sizes[rows])
                for reading in sorted({r for r, _ in kinds}):
                    flat, _, kept = read(whole, reading, units, numbers, last)
                    ends = np.searchsorted(kept, last, side="left")
                    starts = np.concatenate([[0], ends[:-1]])
                    for width in (w for r, w in kinds if r == reading):
                        found = window_hashes(flat, width, reading)
                        at = np.flatnonzero(wanted[found & (FILTER - 1)])
                        doc = np.searchsorted(ends, at, side="right")
                        inside = at + width <= ends[doc]
                        at, doc = at[inside], doc[inside]
                        yield pd.DataFrame({"key": keys[doc], "pos": at - starts[doc], "w": found[at]})

    return run


def consistent_windows(item: list[str], doc: list[str], slots: list[int], met: list[tuple[int, int]], width: int) -> int:
    """How many of the item's windows meet the document with slot values that agree.

    ``met`` holds ``(start in the item, start in the document)``; ``slots`` is the item's template.
    """
    runs = defaultdict(list)
    for i, d in met:
        runs[d - i].append(i)
    covered: set[int] = set()
    for shift, starts in sorted(runs.items(), key=lambda r: (-len(r[1]), r[0])):
        there, back = {}, {}
        for i in sorted(starts):
            pairs = [(slots[p], item[p], doc[p + shift]) for p in range(i, i + width) if UNIT <= slots[p] <= NUMBER]
            new_there, new_back = {}, {}
            for t, a, b in pairs:
                new_there.setdefault((t, a), there.get((t, a), b))
                new_back.setdefault((t, b), back.get((t, b), a))
            if all(new_there[t, a] == b and new_back[t, b] == a for t, a, b in pairs):
                there.update(new_there)
                back.update(new_back)
                covered.add(i)
    return len(covered)


def _checked(units: np.ndarray, numbers: np.ndarray):
    def one(toks, cs, reading):
        cs = np.asarray(cs, dtype=np.int64)
        ts, _, kept = read(cs, reading, units, numbers, np.array([len(cs)]))
        ends = [*kept[1:], len(cs)]
        bare = [t.lstrip(NAME_MARK + FIRST_MARK) for t in toks]
        return [" ".join(bare[i:j]) for i, j in zip(kept, ends)], ts.tolist()

    def run(batches):
        for b in batches:
            n = []
            for i, ic, d, dc, met, w, r in zip(b["itoks"], b["ics"], b["toks"], b["cs"], b["met"], b["width"], b["reading"]):
                (item, slots), (doc, _) = one(i, ic, r), one(d, dc, r)
                n.append(consistent_windows(item, doc, slots, [(m["ipos"], m["pos"]) for m in met], w))
            yield pd.DataFrame({**{c: b[c] for c in ("doc_id", "has_id", "key", "item_id", "item", "windows")}, "n": n})

    return run


def _key(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id).cast("long"), text_or_empty(text))


def item_leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", least: int = LEAST,
) -> DataFrame:
    """``(doc_id, key, item_id, n, windows)``: the item's windows found, for each leak; ``key`` is a hash of id and text."""
    folder = shared_folder(docs.sparkSession, "leaks")
    each = benchmark.select(F.col(item_id).cast("long").alias("item_id"), text_or_empty(item_text).alias("t")).distinct()
    # Items that share an id stay apart; repeated items are one.
    units, numbers = _hashes(docs.sparkSession, UNITS), _hashes(docs.sparkSession, NUMBER_WORDS)
    toks = each.select(F.xxhash64("item_id", "t").alias("item"), "item_id", tokens(F.col("t")).alias("toks")).where(F.size("toks") >= SHORTEST)
    items = materialise(toks.select("item", "item_id", "toks", codes(F.col("toks")).alias("cs")), f"{folder}/items")
    made = items.select("item", "cs").mapInPandas(_of_items(units, numbers), "item bigint, reading int, ipos bigint, width int, iw bigint")
    evidence = materialise(made, f"{folder}/evidence")
    known = evidence.agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set(F.struct("reading", "width"))).alias("kinds")).first()
    kinds = [(k["reading"], k["width"]) for k in known["kinds"]]
    positions = np.array([r["p"] for r in evidence.select(F.expr(f"iw & {FILTER - 1}").alias("p")).distinct().collect()], dtype=np.int64)

    made = docs.select(_key(doc_id, text).alias("key"), tokens(text_or_empty(text)).alias("toks")).select("key", codes(F.col("toks")).alias("cs"))
    sought = made.mapInPandas(_of_docs(kinds, positions, units, numbers), "key bigint, pos bigint, w bigint")
    few = known["n"] <= BROADCAST_WINDOWS
    met = sought.join(F.broadcast(evidence) if few else evidence, F.col("w") == F.col("iw"))
    total = evidence.groupBy(F.col("item").alias("ti"), F.col("reading").alias("tr")).agg(F.count(F.lit(1)).alias("windows"))
    by_item = met.groupBy("key", "item", "reading", "width").agg(F.collect_set(F.struct("ipos", "pos")).alias("met"))
    enough = materialise(by_item.join(total, (F.col("item") == F.col("ti")) & (F.col("reading") == F.col("tr"))).where(
        100 * F.size(F.array_distinct(F.transform("met", lambda m: m["ipos"]))) >= least * F.col("windows")
    ).select("key", "item", "reading", "width", "met", "windows"), f"{folder}/enough")

    keys = enough.select(F.col("key").alias("k")).distinct()
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _key(doc_id, text).alias("key"), text_or_empty(text).alias("t"))
    held = own.join(F.broadcast(keys) if keys.count() <= BROADCAST_WINDOWS else keys, F.col("key") == F.col("k"), "left_semi")
    texts = held.dropDuplicates(["key"]).select(F.col("key").alias("tk"), "doc_id", tokens(F.col("t")).alias("toks")).select("*", codes(F.col("toks")).alias("cs"))
    sides = items.select(F.col("item").alias("ii"), "item_id", F.col("toks").alias("itoks"), F.col("cs").alias("ics"))
    both = enough.join(texts, F.col("key") == F.col("tk")).join(sides, F.col("item") == F.col("ii")).select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("has_id"), "key",
        F.coalesce("item_id", F.lit(-1)).alias("item_id"), "item", "reading", "width", "windows", "met", "toks", "cs", "itoks", "ics",
    )
    checked = both.mapInPandas(_checked(units, numbers), "doc_id bigint, has_id boolean, key bigint, item_id bigint, item bigint, windows bigint, n bigint")
    # Of the readings in which an item has leaked the one with most windows counts.
    best = checked.where(100 * F.col("n") >= least * F.col("windows")).groupBy("doc_id", "has_id", "key", "item_id", "item").agg(
        F.max(F.struct("n", "windows")).alias("best")
    )
    return best.select(F.when(F.col("has_id"), F.col("doc_id")).alias("doc_id"), "key", "item_id", "best.n", "best.windows")


def leaks(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """One row a document with leaks: ``(doc_id, item_ids, n_items, n_windows)``."""
    found = item_leaks(docs, benchmark, **names)
    return found.groupBy("doc_id", "key").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.count_distinct("item_id").alias("n_items"), F.sum("n").alias("n_windows")
    ).drop("key")


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The documents into which no item has leaked, with all their columns."""
    found = item_leaks(docs, benchmark, doc_id, text, **names).select(F.col("key").alias("lk")).distinct()
    found = materialise(found, shared_folder(docs.sparkSession, "leaked"))
    own = packed(docs, key=_key(doc_id, text))
    few = found.count() <= BROADCAST_WINDOWS
    return unpacked(own.join(F.broadcast(found) if few else found, F.col("key") == F.col("lk"), "left_anti"), docs.columns)


def op3_benchmark_leaks(spark, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
