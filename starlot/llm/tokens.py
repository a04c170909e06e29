"""Token ids of whole texts by a byte-level BPE vocabulary, with a cache of what stands between blanks.

The vocabulary's pattern never lets a token cross a single blank between two other characters; the
blank begins the next token. So a text is the sequence of its stretches between such blanks, each
with the blank before it, and ids of stretches seen before need no second encoding. Stretches not
seen are joined again and encoded together; the only tokens that begin with a blank are their
first, which tells them apart. A text with a blank beside other white space, or at either end, is
encoded directly. Both ways give exactly the library's ids (``tests/llm/test_tokens.py``).
"""

from __future__ import annotations

import functools
import os
from itertools import chain, compress, repeat

import numpy as np

CACHED = 600_000
JOINED = 64
# Stretches at the start of a text have no blank before them; no other stretch holds a blank.
AT_START = " "
ODD, NEW = -1, -2
MET_MASK = (1 << 22) - 1


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts under one vocabulary file; strings of special tokens are ordinary text."""

    def __init__(self, path: str, cached: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size()
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self.cached = cached
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.met = np.zeros(MET_MASK + 1, dtype=bool)
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.used = self.known = 0
        self.start = np.zeros(1 << 14, dtype=np.int64)
        self.count = np.zeros(1 << 14, dtype=np.int64)

    def _direct(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, at: dict[str, int], stretches: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        n, total = self.known, self.used + len(ids)
        while total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(stretches) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        self.flat[self.used:total] = ids
        self.start[n:n + len(stretches)] = self.used + np.cumsum(counts) - counts
        self.count[n:n + len(stretches)] = counts
        at.update(zip(stretches, range(n, n + len(stretches))))
        self.used, self.known = total, n + len(stretches)

    def _learn_new(self, at: dict[str, int], stretches: list[str]) -> None:
        """Encodes stretches not seen before and notes them in ``at``; those that make their text odd are noted as ``ODD``."""
        inner = [s for s in stretches if s and s.strip() == s]
        if len(inner) < len(stretches):
            other = [s for s in stretches if not s or s.strip() != s]
            begins = [s[:1] == AT_START and len(s) > 1 and not s[-1].isspace() for s in other]
            at.update((s, ODD) for s, first in zip(other, begins) if not first)
            first = list(compress(other, begins))
            found = self._direct([s[len(AT_START):] for s in first])
            self._learn(at, first, _flat(found), np.array([len(x) for x in found], dtype=np.int64))
        if not inner:
            return
        groups = range(0, len(inner), JOINED)
        found = self._direct([" " + " ".join(inner[i:i + JOINED]) for i in groups])
        ids = _flat(found)
        opens = np.flatnonzero(self.opens[ids])
        if not np.array_equal(np.searchsorted(opens, np.cumsum([0, *map(len, found)])), [*groups, len(inner)]):
            raise ValueError("the vocabulary splits at other places than blanks")
        self._learn(at, inner, ids, np.diff(np.append(opens, len(ids))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and the number of ids of each text."""
        parts = [t.split(" ") for t in texts]
        for p in parts:
            p[0] = AT_START + p[0]
        stretches = list(chain.from_iterable(parts))
        index = np.fromiter(map(self.at.get, stretches, repeat(NEW)), dtype=np.int64, count=len(stretches))
        missing = np.flatnonzero(index == NEW)
        unknown = [stretches[k] for k in missing.tolist()]
        stay, go = self._admitted(list(dict.fromkeys(unknown)))
        self._learn_new(self.at, stay)
        state = (self.used, self.known)
        own: dict[str, int] = {}
        self._learn_new(own, go)
        own.update((s, self.at[s]) for s in stay)
        index[missing] = np.fromiter(map(own.__getitem__, unknown), dtype=np.int64, count=len(unknown))
        out = self._gathered(texts, index, np.array([len(p) for p in parts], dtype=np.int64))
        self.used, self.known = state
        return out

    def _admitted(self, new: list[str]) -> tuple[list[str], list[str]]:
        """New stretches to keep, and those to forget after this call: the ones no earlier call has met.

        Most stretches are met once only.  What was met is noted in a table of fixed size by
        hash; a full cache keeps what it has.
        """
        if len(self.at) >= self.cached:
            return [], new
        places = np.fromiter(map(hash, new), dtype=np.int64, count=len(new)) & MET_MASK
        met = self.met[places]
        self.met[places] = True
        return list(compress(new, met.tolist())), list(compress(new, (~met).tolist()))

    def _gathered(self, texts: list[str], index: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        odd = np.zeros(len(texts), dtype=bool)
        odd[np.searchsorted(np.cumsum(n), np.flatnonzero(index == ODD), side="right")] = True
        if odd.any():
            index = index[~np.repeat(odd, n)]
            n = np.where(odd, 0, n)
        counts = self.count[index]
        ends = np.cumsum(counts)
        ids = self.flat[np.repeat(self.start[index] - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)]
        lengths = np.diff(np.concatenate([[0], ends])[np.cumsum(n)], prepend=0)
        if not odd.any():
            return ids, lengths
        direct = iter(self._direct([t for t, o in zip(texts, odd) if o]))
        out, at = [], 0
        for k, o in enumerate(odd):
            if o:
                own = np.array(next(direct), dtype=np.uint32)
                lengths[k] = len(own)
                out.append(own)
            else:
                out.append(ids[at:at + lengths[k]])
                at += lengths[k]
        return np.concatenate(out), lengths


def _flat(found: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=sum(map(len, found)))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a worker process; its cache goes on from task to task."""
    return Encoder(path)


def portions(texts: list[str], chars: int = 1_000_000) -> list[slice]:
    """Slices of about ``chars`` characters, so that a batch of long texts is encoded bit by bit."""
    out, begin, held = [], 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= chars:
            out.append(slice(begin, i + 1))
            begin, held = i + 1, 0
    return out + [slice(begin, len(texts))] if begin < len(texts) else out
