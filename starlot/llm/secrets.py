"""Secrets in texts: three fixed patterns, and random strings shown by a tokenizer vocabulary.

Byte-pair merges are learned from ordinary text, so words, identifiers and paths take few tokens for
their length while random strings take many. A run of key characters is reported as ``random`` if
it holds fewer than ``max_ratio`` characters a token. Where the whole run does not, its parts between
'/', '-' and '_' are tested, and then stretches of ``SHORTEST`` characters from token to token, so that
readable text beside a random string does not hide it; a stretch is reported up to the ends of its
parts. Left out is what is known for something else: hexadecimal digests of the usual lengths,
subresource digests, UUIDs, numbers, and what a fixed pattern has found already.

Texts are searched whole, each on its own; nothing is shuffled and only spans leave the workers.
Defined cases: a null text is empty and has no spans; repeated rows are each reported; other
columns are ignored by ``find_secrets`` and returned unchanged by ``redact``.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlot.llm.common import packed, text_or_empty, unpacked

# The kinds in their order and the three patterns with the least length of what they find.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
PART = re.compile(r"[^/_-]+")
SHORTEST = 20
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
HEX_ONLY = re.compile(r"[0-9a-fA-F]+")
UUID = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")
SUBRESOURCE = re.compile(r"sha(256|384|512)-[A-Za-z0-9+/]+={0,2}")
MAX_RATIO = 2.0
LONGEST_PIECE = 4_000

SPANS = "array<struct<kind:string,start:int,end:int>>"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(maxsize=2)
def token_counter(path: str):
    """Number of tokens of a string under the vocabulary of a rank file; its ``lengths`` are the bytes of each token."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def lengths(run: str) -> list[int]:
        # Merges take time in the square of a piece's length; very long runs are counted in portions.
        each = (encoding.encode_ordinary(run[i:i + LONGEST_PIECE]) for i in range(0, len(run), LONGEST_PIECE))
        return [len(encoding.decode_single_token_bytes(t)) for ts in each for t in ts]

    def count(run: str) -> int:
        return len(lengths(run))

    count.lengths = lengths
    return count


def known(run: str) -> bool:
    """Runs that are no secrets by their form."""
    if HEX_ONLY.fullmatch(run) and len(run) in DIGEST_LENGTHS:
        return True
    if UUID.fullmatch(run) or SUBRESOURCE.fullmatch(run):
        return True
    return not any(c.isalpha() for c in run)


def _small(m: re.Match) -> str:
    """Capitals alone take more tokens than the same words in small letters."""
    return m[0].lower() if m[0].isalpha() and m[0].isupper() else m[0]


def random_stretches(run: str, lengths, max_ratio: float, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``(start, end)`` of what is random in a run, outside ``taken``."""
    free = lambda a, b: not any(s < b and a < e for s, e in taken)
    if known(run):
        return []
    eased = PART.sub(_small, run)
    sizes = lengths(eased)
    if free(0, len(run)) and len(run) < max_ratio * len(lengths(run) if any(c.islower() or c.isdigit() for c in run) else sizes):
        return [(0, len(run))]
    found, parts = [], [(m.start(), m.end()) for m in PART.finditer(run)]
    taken = taken + [(m.start(), m.end()) for m in UUID.finditer(run)] + [p for p in parts if p[1] - p[0] >= SHORTEST and known(run[slice(*p)])]
    for a, b in parts:
        if b - a >= SHORTEST and free(a, b) and b - a < max_ratio * len(lengths(eased[a:b])):
            found.append((a, b))
    taken = taken + found
    ends = list(itertools.accumulate(sizes))
    # Separators are tokens of their own in readable text, so they count neither way.
    inner = [len(eased[e - n:e].strip("/_-")) for e, n in zip(ends, sizes)]
    letters, full = [0, *itertools.accumulate(inner)], [0, *itertools.accumulate(map(bool, inner))]
    wide, j = [], 0
    for i, size in enumerate(sizes):
        a = ends[i] - size
        while j < len(sizes) and ends[j] - a < SHORTEST:
            j += 1
        if j == len(sizes):
            break
        if letters[j + 1] - letters[i] < max_ratio * (full[j + 1] - full[i]) and free(a, ends[j]) and any(c.isalpha() for c in run[a:ends[j]]):
            if wide and a <= wide[-1][1]:
                wide[-1][1] = ends[j]
            else:
                wide.append([a, ends[j]])
    whole = []
    for a, b in wide:
        # The rest of a part belongs to the string, unless it has been found as something else.
        first = min([s for s, e in parts if s < b and a < e and free(s, a)], default=a)
        last = max([e for s, e in parts if s < b and a < e and free(b, e)], default=b)
        if whole and first < whole[-1][1]:
            whole[-1] = (whole[-1][0], max(b, last))
        else:
            whole.append((min(a, first), max(b, last)))
    return found + whole


def spans_of(text: str, count, max_ratio: float = MAX_RATIO) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of all spans, by start and then kind."""
    found = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted((s, e) for s, _, e in found)
    for m in RUN.finditer(text):
        start, end = m.span()
        taken = [(max(s - start, 0), min(e, end) - start) for s, e in base if s < end and start < e]
        found += [(start + a, 3, start + b) for a, b in random_stretches(m[0], count.lengths, max_ratio, taken)]
    return sorted(found)


def _finder(path: str, max_ratio: float) -> Column:
    @F.pandas_udf(SPANS)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = token_counter(path)
        for batch in texts:
            yield pd.Series([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans_of(t, count, max_ratio)] for t in batch])

    return find


def _redactor(path: str, max_ratio: float, mark: str) -> Column:
    @F.pandas_udf("string")
    def hide(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = token_counter(path)
        for batch in texts:
            yield pd.Series([hidden(t, spans_of(t, count, max_ratio), mark) for t in batch], dtype=object)

    return hide


def hidden(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """``text`` with every stretch covered by spans replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def find_secrets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, max_ratio: float = MAX_RATIO
) -> DataFrame:
    """``(doc_id, spans)`` for every row; spans are code points, end exclusive."""
    find = _finder(vocabulary or vocabulary_path(), max_ratio)
    return docs.select(F.col(doc_id).alias("doc_id"), find(text_or_empty(text)).alias("spans"))


def redact(
    docs: DataFrame, text: str = "text", chars: str | None = "n_chars", vocabulary: str | None = None,
    max_ratio: float = MAX_RATIO, mark: str = "<SECRET>",
) -> DataFrame:
    """All rows and columns of ``docs``; secrets in the text are replaced, ``chars`` is counted anew where one was."""
    hide = _redactor(vocabulary or vocabulary_path(), max_ratio, mark)
    old = F.col("_text")
    made = packed(docs, _text=F.col(text)).withColumn("_new", F.when(old.isNotNull(), hide(F.coalesce(old, F.lit("")))))
    new = {text: F.col("_new")}
    if chars in docs.columns:
        kind = docs.schema[chars].dataType
        new[chars] = F.when(old == F.col("_new"), F.col("_row").getField(chars)).otherwise(F.length("_new").cast(kind))
    return unpacked(made, docs.columns, **new)


def op1_secret_spans(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    spans = F.col("spans")
    joined = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(F.filter(spans, lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        joined(spans).alias("spans"), number("random").alias("n_random"),
    )
