"""Near-duplicate documents by ProbMinHash over weighted five-word shingles.

1. Words are runs of letters and digits in lower case. Documents with equal words are one *text*,
   known by the 64-bit hash of its words; only texts go further, so copies cost no comparisons.
   (Among n different texts two share a hash with probability n * n / 2**65.)
2. A text is signed by ProbMinHash: every shingle runs a Poisson process whose rate is its weight,
   1 + ln(occurrences); each arrival falls into a random register, and a register keeps the shingle
   that arrives first. Once a shingle's next arrival is later than all registers it stops. Two texts
   agree in a register with the probability Jaccard similarity of their weighted shingles. That may be far
   below the similarity of the shingle sets where a passage recurs many times in one of them, so a text in
   which any shingle recurs is signed by weights of one, too, for which both similarities are the same.
3. Registers are hashed in 25 bands of 5, of either signature alike. In a bucket every text meets a leader, one that a hash of text
   and bucket picks, and the pair is verified: exact Jaccard similarity of the shingle sets of 0.8 or
   more. A pair of that similarity shares a bucket with probability 0.9999. Linked texts form classes.
4. Buckets that still hold several classes get other leaders, for ``ROUNDS`` rounds in all. This joins
   groups in which not every text is similar to every other, at one comparison a text and bucket.
5. The texts of buckets that are of several classes even then are joined on the rarest fifth of their
   shingles, without which no pair can reach 0.8 (prefix filter), and compared across classes. Pairs that
   cannot be similar by where they meet in that order, or by the parity of their shingles in 512 classes
   of hashes, are left out by the join itself. All this is exact: no link between bucket mates is
   lost, and texts that only share a passage cost little.

Skew: counts and minima are combined before shuffles, buckets are never gathered into one row or
task, and the joins are plain shuffle joins, which adaptive execution splits. Texts are read twice:
to sign them, and to write the shingles of those that share a bucket. The second reading takes
their row keys by broadcast if these are at most ``BROADCAST_KEYS`` (16 bytes each), else by a
shuffle. Nothing is collected; the loop that joins classes learns one bit a step, and writes its
state below the shared folder.

Defined cases: a text without words belongs to nobody else; below five words, all words are one
shingle; null ids are one id in classes (``min`` skips them); repeated rows are copies.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlot.llm.common import packed, text_or_empty, unpacked, windows
from starlot.session import materialise, shared_folder

WORDS = 5
SIMILAR = (8, 10)
BANDS = 25
ROWS = 5
ROUNDS = 3
BROADCAST_KEYS = 1_000_000
PARITY = [f"odd{k}" for k in range(8)]

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{M}\\p{N}]+", -1), lambda w: w != "")


def node_of(ws: Column) -> Column:
    """Hash of the words: equal for copies; null without words."""
    return F.when(F.size(ws) > 0, F.xxhash64(F.concat_ws(" ", ws)))


def _key(doc_id: str, text: str) -> Column:
    """Tells rows apart without their words."""
    return F.xxhash64(F.col(doc_id).cast("long"), text_or_empty(text))


def shingles(ws: Column) -> Column:
    """Distinct hashed shingles of a word list."""
    each = F.transform(windows(F.size(ws), WORDS), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(WORDS)]))
    return F.when(F.size(ws) >= WORDS, F.array_distinct(each)).otherwise(F.array(F.xxhash64(F.concat_ws(" ", ws))))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def prob_min_hash(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, owners: int, registers: int) -> np.ndarray:
    """``owners`` x ``registers``: for each owner's weighted set the elements that arrive first.

    Arrays are parallel: element ``element[j]`` of ``owner[j]`` has ``weight[j]`` > 0. Elements of all
    owners step from arrival to arrival together; one that can no longer win any register is dropped.
    """
    times = np.full(owners * registers, np.inf)
    first = np.zeros(owners * registers, dtype=np.uint64)
    now, seed = np.zeros(len(element)), element.copy()
    while len(element):
        seed = seed + GOLDEN
        bits = _mixed(seed)
        now = now - np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        slot = owner * registers + (_mixed(bits ^ GOLDEN) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(times, slot, now)
        won = times[slot] == now
        first[slot[won]] = element[won]
        going = now < times.reshape(owners, registers).max(axis=1)[owner]
        owner, element, weight, now, seed = owner[going], element[going], weight[going], now[going], seed[going]
    return first.reshape(owners, registers)


def signatures(word_hashes: list[np.ndarray], bands: int = BANDS, rows: int = ROWS) -> list[list[int]]:
    """Band hashes of each word list; none below five words, where only equal texts are similar.

    A list in which a shingle recurs is signed twice, by its weights and by weights of one.
    """
    out: list[list[int]] = [[] for _ in word_hashes]
    long = [i for i, w in enumerate(word_hashes) if len(w) >= WORDS]
    if not long:
        return out
    owner, element, weight, whose = [], [], [], []
    for i in long:
        w = np.ascontiguousarray(word_hashes[i]).view(np.uint64)
        n = len(w) - WORDS + 1
        h = np.zeros(n, dtype=np.uint64)
        for j in range(WORDS):
            h = _mixed(h * MIX[1] + w[j:j + n] + GOLDEN)
        found, times = np.unique(h, return_counts=True)
        signs = [1.0 + np.log(times)] + [np.ones(len(found))] * bool((times > 1).any())
        for each in signs:
            owner.append(np.full(len(found), len(whose)))
            element.append(found)
            weight.append(each)
            whose.append(i)
    first = prob_min_hash(np.concatenate(owner), np.concatenate(element), np.concatenate(weight), len(whose), bands * rows)
    keys = np.zeros((len(whose), bands), dtype=np.uint64)
    for j in range(rows):
        keys = _mixed(keys * MIX[0] + first.reshape(len(whose), bands, rows)[:, :, j] + GOLDEN)
    keys = _mixed(keys + np.arange(bands, dtype=np.uint64)).view(np.int64)
    for k, i in enumerate(whose):
        out[i] = np.union1d(np.array(out[i], np.int64), keys[k])
    return out


def _signed(batches):
    """Signs the texts of a batch in portions of about a million words, which bounds the memory."""
    for batch in batches:
        hashes = [np.asarray(x, dtype=np.int64) for x in batch["hashes"]]
        ends = np.cumsum([len(x) for x in hashes]) // 1_000_000
        for part in range(int(ends[-1]) + 1 if len(ends) else 0):
            rows = np.flatnonzero(ends == part)
            if len(rows):
                yield pd.DataFrame({
                    **{c: batch[c].iloc[rows].to_numpy() for c in ("id", "has_id", "key", "node")},
                    "bands": signatures([hashes[r] for r in rows]),
                })


def signed_documents(docs: DataFrame, doc_id: str, text: str, folder: str) -> DataFrame:
    """``(id, key, node, bands)`` for every row, written once; node is null without words."""
    ws = docs.select(F.col(doc_id).cast("long").alias("id"), _key(doc_id, text).alias("key"), word_list(text_or_empty(text)).alias("ws"))
    read = ws.select(
        F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNotNull().alias("has_id"), "key",
        F.coalesce(node_of(F.col("ws")), F.lit(0)).alias("node"), F.transform("ws", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    signed = read.mapInPandas(_signed, "id bigint, has_id boolean, key bigint, node bigint, bands array<bigint>")
    no_words = (F.col("node") == 0) & (F.size("bands") == 0)
    return materialise(signed.select(
        F.when(F.col("has_id"), F.col("id")).alias("id"), "key", F.when(~no_words, F.col("node")).alias("node"), "bands"
    ), f"{folder}/signed")


def member_sets(docs: DataFrame, doc_id: str, text: str, members: DataFrame, texts: DataFrame, folder: str) -> DataFrame:
    """``(node, s)``: the shingles of the texts that share a bucket with another, written once."""
    nodes = members.select(F.col("node").alias("m")).distinct()
    keys = materialise(texts.join(nodes, F.col("node") == F.col("m"), "left_semi").select(F.col("key").alias("k"), F.col("node").alias("kn")), f"{folder}/keys")
    few = keys.count() <= BROADCAST_KEYS
    rows = docs.select(_key(doc_id, text).alias("key"), text_or_empty(text).alias("t"))
    held = rows.join(F.broadcast(keys) if few else keys, F.col("key") == F.col("k")).select(F.col("kn").alias("node"), word_list(F.col("t")).alias("ws"))
    # Rows that repeat an id and a text have one key; one of them is enough.
    return materialise(held.select("node", shingles(F.col("ws")).alias("s")).dropDuplicates(["node"]), f"{folder}/sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs ``(a, b)`` and their classes, ``(ac, bc)`` of those whose shingle sets have the similarity asked for."""
    part, whole = SIMILAR
    left, right = (sets.select(F.col("node").alias(f"{k}_n"), F.col("s").alias(f"{k}_s")) for k in "ab")
    sizes = sets.select(F.col("node").alias("n"), F.size("s").alias("size"))
    # Sizes alone rule out many pairs before any set travels.
    sized = pairs.join(sizes, F.col("a") == F.col("n")).select("a", "b", "ac", "bc", F.col("size").alias("a_size"))
    sized = sized.join(sizes, F.col("b") == F.col("n")).where(whole * F.least("a_size", "size") >= part * F.greatest("a_size", "size"))
    both = sized.select("a", "b", "ac", "bc").join(left, F.col("a") == F.col("a_n")).join(right, F.col("b") == F.col("b_n"))
    shared = both.withColumn("x", F.size(F.array_intersect("a_s", "b_s")))
    return shared.where(whole * F.col("x") >= part * (F.size("a_s") + F.size("b_s") - F.col("x"))).select("ac", "bc")


def connected(links: DataFrame, folder: str) -> DataFrame:
    """``(node, class)``: each linked node with the smallest node it is connected to.

    Labels fall to the smallest label next door and then to that label's own label, so a chain
    shrinks by half a step; every step is written, and ends the loop once nothing changed.
    """
    spark = links.sparkSession
    edges = materialise(
        links.select(F.col("ac").alias("u"), F.col("bc").alias("v")).union(links.select("bc", "ac")).distinct(), f"{folder}/edges"
    )
    labels = materialise(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("class")).withColumnRenamed("u", "node"), f"{folder}/labels-0")
    step = 0
    while True:
        step += 1
        there = labels.select(F.col("node").alias("v"), F.col("class").alias("next"))
        best = edges.join(there, "v").groupBy("u").agg(F.min("next").alias("best"))
        lower = labels.join(best, F.col("node") == F.col("u")).select("node", F.col("class").alias("old"), F.least("class", "best").alias("class"))
        up = labels.select(F.col("node").alias("p"), F.col("class").alias("above"))
        jumped = lower.join(up, F.col("class") == F.col("p"), "left").select("node", "old", F.least("class", F.coalesce("above", "class")).alias("class"))
        written = materialise(jumped, f"{folder}/labels-{step}")
        labels = written.select("node", "class")
        if written.where(F.col("old") != F.col("class")).isEmpty():
            return labels


def _ordered(one: str, other: str, one_class: str, other_class: str) -> list[Column]:
    """A pair in the order of its texts, with their classes."""
    first = F.col(one) < F.col(other)
    return [
        F.least(one, other).alias("a"), F.greatest(one, other).alias("b"),
        F.when(first, F.col(one_class)).otherwise(F.col(other_class)).alias("ac"), F.when(first, F.col(other_class)).otherwise(F.col(one_class)).alias("bc"),
    ]


def _undecided(members: DataFrame) -> DataFrame:
    """The members of keys that hold several classes."""
    keys = members.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi").select(F.col("key").alias("mk"))
    return members.join(keys, F.col("key") == F.col("mk"), "left_semi")


def _with_leaders(members: DataFrame, salt: int) -> DataFrame:
    """Pairs of each key's texts with its leader, where their classes differ."""
    rank = F.xxhash64("node", "key", F.lit(salt))
    leaders = members.groupBy("key").agg(F.min_by("node", rank).alias("x"), F.min_by("class", rank).alias("c")).withColumnRenamed("key", "k")
    pairs = members.join(leaders, (F.col("key") == F.col("k")) & (F.col("class") != F.col("c")))
    return pairs.select(*_ordered("node", "x", "class", "c")).distinct()


def _across(members: DataFrame) -> DataFrame:
    """Pairs of bucket mates within a key across classes, from the rows of ``_rare_fifth``.

    The join's condition leaves out pairs of unlike sizes, pairs that share no bucket, and pairs that
    meet at an earlier key, so each pair is made once.  As that is their first common shingle, they have no more in common than
    either has from there on; and their sets differ by at least the bits in which their parities do.  Texts outside a key's largest class meet everything of another class: a class with all but few
    of a key's texts is never paired with itself, neither in the result nor inside the join.
    """
    sizes = members.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n"))
    major = sizes.groupBy("key").agg(F.max_by("class", F.col("n")).alias("largest")).withColumnRenamed("key", "mk")
    placed = members.join(major, F.col("key") == F.col("mk"))
    minor = placed.where(F.col("class") != F.col("largest")).select(
        F.col("key").alias("k"), F.col("node").alias("x"), F.col("class").alias("c"), *[F.col(c).alias(f"x_{c}") for c in ("size", "place", "rare", "bands", *PARITY)]
    )
    part, whole = SIMILAR
    sized = whole * F.least("size", "x_size") >= part * F.greatest("size", "x_size")
    both = F.col("size") + F.col("x_size")
    # Similar sets have part / (part + whole) of both sizes in common, so they differ in the rest.
    in_reach = (part + whole) * F.least(F.col("size") - F.col("place"), F.col("x_size") - F.col("x_place")) >= part * both
    odd = reduce(lambda x, y: x + y, [F.bit_count(F.col(c).bitwiseXOR(F.col(f"x_{c}"))) for c in PARITY])
    sized = sized & in_reach & ((part + whole) * odd <= (whole - part) * both)
    met_here = F.get(F.array_intersect("rare", "x_rare"), 0) == F.col("key")
    pairs = members.join(minor, (F.col("key") == F.col("k")) & (F.col("class") != F.col("c")) & sized & F.arrays_overlap("bands", "x_bands") & met_here)
    return pairs.select(*_ordered("node", "x", "class", "c")).distinct()


def _parities(s: Column) -> list[Column]:
    """512 bits: whether an odd number of the shingles fall on each."""
    one = F.lit(1).cast("bigint")
    flip = lambda acc, h: acc.bitwiseXOR(F.call_function("shiftleft", one, h.bitwiseAND(F.lit(63)).cast("int")))
    own = lambda k: F.filter(s, lambda h: F.shiftright(h, 6).bitwiseAND(F.lit(len(PARITY) - 1)) == k)
    return [F.aggregate(own(k), F.lit(0).cast("bigint"), flip).alias(c) for k, c in enumerate(PARITY)]


def _rare_fifth(members: DataFrame, sets: DataFrame, texts: DataFrame, folder: str) -> DataFrame:
    """``(key, place, node, class, size, rare, bands, parities)`` with the shingles as keys by which similar texts must meet.

    ``rare`` holds the keys of a text that texts of other classes have, too, the rarest first.
    """
    part, whole = SIMILAR
    nodes = members.select(F.col("node").alias("m"), "class").distinct()
    each = sets.join(nodes, F.col("node") == F.col("m")).select("node", "class", F.explode("s").alias("h"))
    often = each.groupBy("h").agg(F.count(F.lit(1)).alias("often")).withColumnRenamed("h", "g")
    ranked = each.join(often, F.col("h") == F.col("g")).groupBy("node", "class").agg(F.sort_array(F.collect_list(F.struct("often", "h"))).alias("s"))
    size = F.size("s")
    keep = size - F.ceil(size * F.lit(part) / F.lit(whole)).cast("int") + 1
    # Written, as the steps below read it twice; so is the result, which its caller reads three times.
    thin = ranked.select("node", "class", size.alias("size"), F.posexplode(F.slice("s", F.lit(1), keep)).alias("place", "e"))
    thin = materialise(thin.select(F.col("e.h").alias("key"), "node", "class", "size", "place"), f"{folder}/prefix")
    # Most keys are of one class only and go before the lists that the comparison needs are made.
    shared = _undecided(thin)
    listed = shared.groupBy("node", "class", "size").agg(F.sort_array(F.collect_list(F.struct("place", "key"))).alias("l"))
    banded = listed.join(texts.select(F.col("node").alias("bn"), "bands"), F.col("node") == F.col("bn"))
    parities = sets.select(F.col("node").alias("pn"), *_parities(F.col("s")))
    rare = banded.join(parities, F.col("node") == F.col("pn")).select(
        "node", "class", "size", "l", F.transform("l", lambda e: e["key"]).alias("rare"), "bands", *PARITY
    )
    return materialise(rare.select(F.explode("l").alias("e"), *rare.columns).select("e.key", "e.place", *rare.drop("l").columns), f"{folder}/rare")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """``(signed rows, (node, class) of the texts that share a bucket)``."""
    folder = shared_folder(docs.sparkSession, "near")
    signed = signed_documents(docs, doc_id, text, folder)
    texts = signed.where("size(bands) > 0").groupBy("node").agg(F.first("bands").alias("bands"), F.min("key").alias("key"))
    texts = materialise(texts, f"{folder}/texts")
    each = texts.select("node", F.explode("bands").alias("band"))
    buckets = each.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("band").alias("shared"))
    members = each.join(buckets, F.col("band") == F.col("shared")).select(F.col("band").alias("key"), "node", F.col("node").alias("class"))
    members = materialise(members, f"{folder}/members")
    sets = member_sets(docs, doc_id, text, members, texts, folder)
    owners = members.select("node", "class").distinct()

    def linked(pairs: DataFrame, step: str) -> bool:
        """Verifies pairs and gives classes that a link joins one name, in members and owners; whether any was."""
        nonlocal members, owners
        links = materialise(_verified(pairs, sets).distinct(), f"{folder}/links-{step}")
        if links.isEmpty():
            return False
        moved = connected(links, f"{folder}/{step}").select(F.col("node").alias("was"), F.col("class").alias("now"))
        renamed = lambda df: df.join(moved, F.col("class") == F.col("was"), "left").withColumn("class", F.coalesce("now", "class")).drop("was", "now")
        owners = materialise(renamed(owners), f"{folder}/owners-{step}")
        members = materialise(_undecided(renamed(members)), f"{folder}/members-{step}")
        return True

    for salt in range(rounds):
        if not linked(_with_leaders(members, salt), str(salt)):
            break
    # Without rounds all buckets come here as they are: the prefix filter alone is exact, too.
    linked(_across(_rare_fifth(members, sets, texts, folder)), "rest")
    return signed, owners


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, class_id)`` for every row; the class id is the smallest document id of the class."""
    signed, found = classes(docs, doc_id, text, rounds)
    return _labelled(signed, found).select(F.col("id").alias("doc_id"), "class_id")


def _labelled(signed: DataFrame, found: DataFrame) -> DataFrame:
    """``(id, node, class_id, group)``; rows of few bytes only meet here."""
    rows = signed.select("id", "node")
    texts = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("first"))
    named = found.select(F.col("node").alias("fn"), F.col("class").alias("fc"))
    grouped = texts.join(named, F.col("node") == F.col("fn"), "left").select("node", "first", F.coalesce("fc", "node").alias("group"))
    ids = grouped.groupBy("group").agg(F.min("first").alias("class_id")).withColumnRenamed("group", "g")
    by_text = grouped.join(ids, F.col("group") == F.col("g")).select(F.col("node").alias("tn"), "group", "class_id")
    return rows.join(by_text, F.col("node") == F.col("tn"), "left").select(
        "id", "node", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), "group"
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """The documents without all but one of each class, with all their columns.

    The document with the smallest id stays; of rows that repeat it, one. Texts without words all stay.
    """
    signed, found = classes(docs, doc_id, text, rounds)
    named = _labelled(signed, found)
    kept = (
        named.where(F.col("node").isNotNull() & F.col("id").eqNullSafe(F.col("class_id")))
        .groupBy("group").agg(F.min("node").alias("k_node"), F.first("id").alias("k_id"), F.count(F.lit(1)).alias("times"))
        .select("k_node", "k_id", "times")
    )
    own = packed(docs, _id=F.col(doc_id).cast("long"), _node=node_of(word_list(text_or_empty(text))))
    chosen = own.join(kept, (F.col("_node") == F.col("k_node")) & F.col("_id").eqNullSafe(F.col("k_id")))
    single = chosen.where("times = 1").select("_row")
    # Rows of one id and the same words may differ in anything else: the least hash of a whole row decides.
    repeated = chosen.where("times > 1").groupBy("k_node").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row")).select("_row")
    return unpacked(single.union(repeated).union(own.where("_node IS NULL").select("_row")), docs.columns)


def op9_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
