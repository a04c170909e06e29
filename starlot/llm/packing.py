"""Mixture-controlled packing: deficit round-robin over one queue of tokens a source.

Each document is its token ids and an end id; a source's documents stand one behind another in its
queue. Rounds visit the queues in order of their names; a queue's quantum is its target share of a
window, a fraction of tokens in general. What a round may not send yet, the fraction, is carried as
the queue's deficit, so after ``t`` rounds a queue of quantum ``q`` has sent ``floor(t * q)`` tokens
or, at its end, all it has. A queue whose quantum is below ``step`` tokens saves its deficit until a step is
full, ``floor(t * q / step) * step``, so that documents are not ground to pieces of a few tokens. The stream of
all rounds is cut at every ``width`` tokens; windows are filled to the target proportions as long as the queues
last, within as many tokens as there are sources and a step for each queue that saves, never more than
that behind over any number of windows. Only the last window is short.

What a queue has sent by any round is a formula, so every task knows the deficits at its first
document without the tasks before it: the state carried over windows and partitions is the number
of tokens that precede a document in its queue. These come from the sums of each queue in each
partition of the written tokens, a table of (queues x partitions) rows.

Without ``targets`` the proportions are those of the documents, so that all queues end together.
A window has no room for a token of more than ``width`` sources; beyond that many, sources share
queues by a hash of their name. Shares are whole multiples of 2**-20, at least one.

Defined cases: a null text is empty and has its end id only; a null source is the source ""; repeated
rows are packed each; an empty table gives no pieces; other columns are ignored. The order inside a
queue is that of the input's partitions and rows.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starlot.llm.common import text_or_empty
from starlot.llm.tokens import encoder, portions, vocabulary_path
from starlot.session import shared_folder

WIDTH = 1024
UNIT = 1 << 20
BROADCAST_ROWS = 200_000
SEND_PIECES = 50_000

TOKENS = "doc_id bigint, has_id boolean, queue string, part bigint, before bigint, n bigint, ids binary"
PIECES = "doc_id bigint, has_id boolean, queue string, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def _tokenised(path: str, end_id: int):
    def run(batches):
        coder, sent, part = encoder(path), defaultdict(int), TaskContext.get().partitionId()
        for batch in batches:
            texts = batch["text"].tolist()
            for rows in portions(texts):
                ids, lengths = coder.encode(texts[rows])
                ends = np.cumsum(lengths + 1)
                whole = np.full(int(ends[-1]), end_id, dtype="<u4")
                keep = np.ones(len(whole), dtype=bool)
                keep[ends - 1] = False
                whole[keep] = ids
                before = []
                for queue, n in zip(batch["queue"].iloc[rows], lengths + 1):
                    before.append(sent[queue])
                    sent[queue] += int(n)
                own = batch.iloc[rows]
                yield pd.DataFrame({
                    "doc_id": own["doc_id"].to_numpy(), "has_id": own["has_id"].to_numpy(), "queue": own["queue"].to_numpy(), "part": part,
                    "before": before, "n": lengths + 1, "ids": [whole[e - n:e].tobytes() for e, n in zip(ends, lengths + 1)],
                })
    return run


def write_tokens(docs: DataFrame, folder: str, doc_id: str, text: str, source: str, vocabulary: str, end_id: int, queues: int) -> DataFrame:
    """Token ids of every row with its place in its queue's part, written once."""
    name = F.coalesce(F.col(source).cast("string"), F.lit(""))
    names = docs.select(name.alias("s")).distinct().limit(queues + 1).count()
    queue = name if names <= queues else F.concat(F.lit("#"), F.pmod(F.crc32(name), F.lit(queues)).cast("string"))
    read = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("doc_id"), F.col(doc_id).isNotNull().alias("has_id"),
        queue.alias("queue"), text_or_empty(text).alias("text"),
    )
    written = read.mapInPandas(_tokenised(vocabulary, end_id), TOKENS)
    written.write.option("compression", "zstd").parquet(f"{folder}/tokens")
    return docs.sparkSession.read.schema(TOKENS).parquet(f"{folder}/tokens")


def _many(docs: DataFrame, source: str, queues: int) -> bool:
    """Whether there are more sources than queues, so that sources share queues."""
    return docs.select(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("s")).distinct().limit(queues + 1).count() > queues


def by_queue(targets: dict[str, float], totals: dict[str, int], shared: bool, queues: int) -> dict[str, float]:
    """Targets of sources as targets of queues; sources that share a queue add up."""
    out: dict[str, float] = {}
    for name, weight in targets.items():
        queue = f"#{zlib.crc32(name.encode()) % queues}" if shared else name
        if queue not in totals:
            raise ValueError(f"target {name!r} names no source of the documents")
        out[queue] = out.get(queue, 0.0) + max(0.0, float(weight))
    return out


def shares(totals: dict[str, int], targets: dict[str, float] | None) -> np.ndarray:
    """Whole numbers of 2**-20 by queue in order of names, summing to 2**20; largest remainders are rounded up."""
    weight = [max(0.0, float((targets or totals).get(q, 0))) for q in sorted(totals)]
    whole = sum(weight) or 1.0
    exact = [UNIT * w / whole for w in weight]
    out = np.array([max(1, int(x)) for x in exact], dtype=np.int64)
    order = sorted(range(len(exact)), key=lambda k: (int(exact[k]) - exact[k], k))
    k = 0
    while out.sum() < UNIT:
        out[order[k % len(order)]] += 1
        k += 1
    while out.sum() > UNIT:
        out[int(out.argmax())] -= 1
    return out


def _sent(t: np.ndarray, share: np.ndarray, unit: int, total: np.ndarray, saved: np.ndarray) -> np.ndarray:
    """Tokens each queue has sent after ``t`` rounds, in whole multiples of what it saves: (rounds x queues)."""
    due = t[:, None] * share[None, :] // unit
    return np.minimum(total[None, :], due - due % saved[None, :])


def schedule(begin: np.ndarray, n: np.ndarray, queue: np.ndarray, share: np.ndarray, total: np.ndarray, width: int, step: int = 1):
    """Pieces of documents at ``begin`` .. ``begin + n`` of their queues: (document, from, length, stream position)."""
    docs, froms, sizes, places = [], [], [], []
    # A quantum is share / unit tokens, in lowest terms to keep products within 64 bits.
    common = math.gcd(UNIT, width)
    share, unit = share * (width // common), UNIT // common
    saved = np.where(share < unit * step, step, 1)
    own, size = share[queue], saved[queue]
    # The round that sends token x of a queue is the first t with t * share // unit > x.
    first, last = (-(-((x + 1) * unit) // own) for x in (begin, begin + n - 1))
    by_step = own < unit * step
    steps = np.where(by_step, (begin + n - 1) // size - begin // size + 1, last - first + 1)
    at = np.repeat(np.arange(len(n)), steps)
    nth = np.arange(int(steps.sum())) - np.repeat(np.cumsum(steps) - steps, steps)
    # A queue that saves sends one step a round at most; the step from token x on is due once x + step tokens are.
    token = (begin[at] // size[at] + nth) * size[at]
    t = np.where(by_step[at], -(-((token + size[at]) * unit) // own[at]), first[at] + nth)
    rows = max(1, 2_000_000 // max(1, len(share)))
    for i in range(0, len(at), rows):
        a, r = at[i:i + rows], t[i:i + rows]
        k = queue[a]
        before, after = _sent(r - 1, share, unit, total, saved), _sent(r, share, unit, total, saved)
        line = np.arange(len(a))
        sent = np.cumsum(after - before, axis=1) - (after - before)
        mine, upto = before[line, k], after[line, k]
        lo, hi = np.maximum(mine, begin[a]), np.minimum(upto, begin[a] + n[a])
        place = before.sum(axis=1) + sent[line, k] + (lo - mine)
        some = hi > lo
        docs.append(a[some])
        froms.append(lo[some] - begin[a][some])
        sizes.append((hi - lo)[some])
        places.append(place[some])
    if not docs:
        return (np.zeros(0, dtype=np.int64),) * 4
    d, f, s, p = (np.concatenate(x) for x in (docs, froms, sizes, places))
    room = width - p % width
    cut = s > room
    rest = (d[cut], f[cut] + room[cut], s[cut] - room[cut], p[cut] + room[cut])
    d, f, s, p = (np.concatenate([x, y]) for x, y in zip((d, f, np.minimum(s, room), p), rest))
    order = np.lexsort((f, d))
    return d[order], f[order], s[order], p[order]


def _packed(names: list[str], share: np.ndarray, total: np.ndarray, width: int, step: int):
    number = {q: k for k, q in enumerate(names)}

    def run(batches):
        for batch in batches:
            n = batch["n"].to_numpy()
            held = np.cumsum(n) // 2_000_000
            for portion in range(int(held[-1]) + 1 if len(n) else 0):
                b = batch[held == portion]
                if not len(b):
                    continue
                queue = b["queue"].map(number).to_numpy()
                d, f, s, p = schedule((b["base"] + b["before"]).to_numpy(), b["n"].to_numpy(), queue, share, total, width, step)
                ids = b["ids"].tolist()
                cols = {c: b[c].to_numpy() for c in ("doc_id", "has_id", "queue", "n")}
                for i in range(0, len(d), SEND_PIECES):
                    e, g, h, at = d[i:i + SEND_PIECES], f[i:i + SEND_PIECES], s[i:i + SEND_PIECES], p[i:i + SEND_PIECES]
                    yield pd.DataFrame({
                        "doc_id": cols["doc_id"][e], "has_id": cols["has_id"][e], "queue": cols["queue"][e], "start": g, "length": h,
                        "doc_tokens": cols["n"][e], "sequence_id": at // width, "offset": at % width,
                        "ids": [ids[k][4 * x:4 * (x + y)] for k, x, y in zip(e.tolist(), g.tolist(), h.tolist())],
                    })
    return run


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", targets: dict[str, float] | None = None,
    vocabulary: str | None = None, end_id: int = 0, width: int = WIDTH, step: int | None = None,
) -> DataFrame:
    """One row a piece: ``(doc_id, queue, start, length, doc_tokens, sequence_id, offset, ids)``; ids are little-endian unsigned 32 bits.

    ``step`` is a sixteenth of ``width`` unless given; 1 follows the proportions to the token.
    """
    step = max(1, width // 16) if step is None else step
    folder = shared_folder(docs.sparkSession, "packing")
    tokens = write_tokens(docs, folder, doc_id, text, source, vocabulary or vocabulary_path(), end_id, width)
    sums = tokens.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    totals = {r["queue"]: int(r["n"]) for r in sums.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return docs.sparkSession.createDataFrame([], PIECES).drop("has_id")
    if targets:
        targets = by_queue(targets, totals, _many(docs, source, width), width)
    names = sorted(totals)
    order = W.partitionBy("queue").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = sums.select(F.col("queue").alias("b_queue"), F.col("part").alias("b_part"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    bases = F.broadcast(bases) if bases.count() <= BROADCAST_ROWS else bases
    placed = tokens.join(bases, (F.col("queue") == F.col("b_queue")) & (F.col("part") == F.col("b_part"))).drop("b_queue", "b_part")
    run = _packed(names, shares(totals, targets), np.array([totals[q] for q in names], dtype=np.int64), width, step)
    return placed.mapInPandas(run, PIECES).withColumn("doc_id", F.when(F.col("has_id"), F.col("doc_id"))).drop("has_id")


def sequences(pieces: DataFrame, width: int = WIDTH, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, length, padded_length, ids)``: windows put together; a length that is no power of two is padded to ``width``."""
    whole = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("x")))).alias("p"), F.sum("length").alias("length"))
    even = F.expr("(length & (length - 1)) = 0")
    padded = F.when(even, F.col("length")).otherwise(F.lit(width).cast("long"))
    pad = F.lit(pad_id.to_bytes(4, "little").hex().upper())
    joined = F.array_join(F.transform("p", lambda x: x["x"]), "")
    return whole.select("sequence_id", "length", padded.alias("padded_length"), F.unhex(F.concat(joined, F.repeat(pad, (padded - F.col("length")).cast("int")))).alias("ids"))


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", F.col("queue").alias("source"))


def op2_mixture_packing(spark, sf_dir: str) -> DataFrame:
    return digests(pack(spark.read.parquet(f"{sf_dir}/documents.parquet")))
