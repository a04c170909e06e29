import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from starlot.llm import packing
from starlot.llm.tokens import Encoder, vocabulary_path


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(["the", "sea", "and", "sun", "rising", "é", "2024", "word,"]) for _ in range(n))


def tokens(text):
    return np.array(Encoder(vocabulary_path()).tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4").tobytes()


def whole(pieces):
    """Checks that every sequence is gapless; the tokens of each document and each sequence's sources."""
    by, seq = defaultdict(list), defaultdict(list)
    for r in pieces:
        assert len(r.ids) == 4 * r.length > 0
        by[r.doc_id].append((r.start, bytes(r.ids)))
        seq[r.sequence_id].append((r.offset, r.length, r.queue))
    assert sorted(seq) == list(range(len(seq)))
    for k, v in seq.items():
        at = 0
        for o, n, _ in sorted(v):
            assert o == at
            at += n
        assert at == 1024 or k == len(seq) - 1
    return by, seq


def test_every_token_once_and_windows_on_target(documents):
    rows = [(k, prose(k, 40 + 13 * (k % 50)), f"s{min(k % 9, 5)}") for k in range(300)]
    pieces = packing.pack(documents(rows).repartition(5)).collect()
    by, seq = whole(pieces)
    for k, text, _ in rows:
        assert b"".join(x for _, x in sorted(by[k])) == tokens(text)
    total = Counter()
    for r in pieces:
        total[r.queue] += r.length
    share = {q: n / sum(total.values()) for q, n in total.items()}
    for k, v in seq.items():
        if k < len(seq) - 2:
            own = Counter()
            for _, n, q in v:
                own[q] += n
            assert all(abs(own[q] - 1024 * share[q]) <= len(total) + 1 for q in total)


def test_targets_of_sources_that_share_queues_add_up(documents):
    names = [f"s{k}" for k in range(12)]
    at = lambda s: f"#{zlib.crc32(s.encode()) % 8}"
    docs = documents([(k, prose(k, 200), names[k % 12]) for k in range(48)])
    targets = {n: 5.0 if at(n) == at("s0") else 0.001 for n in names}
    first = Counter()
    for r in packing.pack(docs, targets=targets, width=8).where("sequence_id < 20").collect():
        first[r.queue] += r.length
    assert first[at("s0")] > 150
    with pytest.raises(ValueError, match="names no source"):
        packing.pack(documents([(1, "a b", "x")]), targets={"y": 1})


def test_targets_hold_until_a_queue_ends(documents):
    rows = [(k, prose(k, 400), "abc"[k % 3]) for k in range(90)]
    _, seq = whole(packing.pack(documents(rows), targets={"a": 2, "b": 1, "c": 1}).collect())
    first = Counter()
    for _, n, q in (x for k in range(20) for x in seq[k]):
        first[q] += n
    assert abs(first["a"] - 20 * 512) < 5 and abs(first["b"] - 20 * 256) < 5


def test_schedule_is_deficit_round_robin():
    """Against queues served round by round with carried deficits."""
    rnd = random.Random(7)
    total = np.array([rnd.randint(1, 4000) for _ in range(6)], dtype=np.int64)
    share = packing.shares({str(k): int(n) for k, n in enumerate(total)}, None)
    stream, sent, deficit = [], [0] * 6, [0] * 6
    while any(s < t for s, t in zip(sent, total)):
        for k in range(6):
            deficit[k] += int(share[k]) * 64
            n = min(deficit[k] // packing.UNIT, int(total[k]) - sent[k])
            deficit[k] %= packing.UNIT
            stream += [(k, sent[k] + j) for j in range(n)]
            sent[k] += n
    place = {x: i for i, x in enumerate(stream)}
    for k in range(6):
        cuts = sorted(rnd.sample(range(1, int(total[k]) + 1), min(5, int(total[k])))) + [int(total[k])]
        begin = np.array([0] + cuts[:-1]); n = np.array(cuts) - begin  # noqa: E702
        begin, n = begin[n > 0], n[n > 0]
        d, f, s, p = packing.schedule(begin, n, np.full(len(n), k), share, total, 64)
        for a, b, c, e in zip(d, f, s, p):
            assert [place[k, int(begin[a] + b + j)] for j in range(c)] == list(range(e, e + c))
            assert e // 64 == (e + c - 1) // 64
        assert s.sum() == n.sum()


@pytest.mark.parametrize("step", [3, 16])
def test_small_queues_save_their_deficits(step):
    """Against queues that carry their deficit until a step is full."""
    rnd = random.Random(step)
    total = np.array([9000, 400, 35, 1, 700, 90], dtype=np.int64)
    share = packing.shares({str(k): int(n) for k, n in enumerate(total)}, None)
    stream, sent, due, t = [], [0] * 6, [0] * 6, 0
    while any(s < n for s, n in zip(sent, total)):
        t += 1
        for k in range(6):
            least = step if int(share[k]) * 64 < step * packing.UNIT else 1
            due[k] = t * int(share[k]) * 64 // packing.UNIT
            n = min((due[k] - sent[k]) // least * least, int(total[k]) - sent[k])
            if due[k] - sent[k] >= least:
                stream += [(k, sent[k] + j) for j in range(n)]
                sent[k] += n
            if sent[k] + least <= total[k]:
                assert 0 <= due[k] - sent[k] < least
    place = {x: i for i, x in enumerate(stream)}
    assert len(place) == total.sum()
    for k in range(6):
        cuts = sorted(rnd.sample(range(1, int(total[k]) + 1), min(9, int(total[k])))) + [int(total[k])]
        begin = np.array([0] + cuts[:-1]); n = np.array(cuts) - begin  # noqa: E702
        begin, n = begin[n > 0], n[n > 0]
        d, f, s, p = packing.schedule(begin, n, np.full(len(n), k), share, total, 64, step)
        for a, b, c, e in zip(d, f, s, p):
            assert [place[k, int(begin[a] + b + j)] for j in range(c)] == list(range(e, e + c))
        assert s.sum() == n.sum()


def test_pieces_of_a_document_are_bounded(documents):
    rows = [(k, prose(k, 300), "b" if k % 2 else "a") for k in range(60)] + [(100 + k, prose(k, 200), f"s{k}") for k in range(60)]
    for targets in ({"a": 1.0}, None):
        pieces = packing.pack(documents(rows), targets=targets).collect()
        by, _ = whole(pieces)
        n = Counter(r.doc_id for r in pieces)
        # A step may be cut by a document's ends and by a window's.
        assert all(n[r.doc_id] <= r.doc_tokens / 64 * 2 + 3 for r in pieces)
        assert all(b"".join(x for _, x in sorted(by[k])) == tokens(text) for k, text, _ in rows)


def test_defined_cases(documents):
    rows = [(1, None, None), (1, None, None), (2, "", "x"), (None, "a b c", "x"), (3, prose(3, 60_000), "y")]
    pieces = packing.pack(documents(rows)).collect()
    by, _ = whole(pieces)
    assert len(by[1]) == 2 and all(x == b"\0\0\0\0" for _, x in by[1])
    assert b"".join(x for _, x in sorted(by[None])) == tokens("a b c") and b"".join(x for _, x in sorted(by[3])) == tokens(rows[-1][1])
    assert packing.pack(documents([])).count() == 0


@pytest.mark.parametrize("names", [1, 40])
def test_more_sources_than_a_window_holds(documents, names):
    rows = [(k, prose(k, 30), f"s{k % names}") for k in range(80)]
    pieces = packing.pack(documents(rows), width=16).collect()
    got = defaultdict(list)
    for r in pieces:
        got[r.doc_id].append((r.start, bytes(r.ids)))
        assert r.offset + r.length <= 16
    assert all(b"".join(x for _, x in sorted(got[k])) == tokens(t) for k, t, _ in rows)


def test_sequences_and_digests(documents):
    pieces = packing.pack(documents([(k, prose(k, 50), "ab"[k % 2]) for k in range(40)])).cache()
    made = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    for r in packing.digests(pieces).collect():
        s = made[r.sequence_id]
        assert zlib.crc32(bytes(s.ids)[4 * r.offset:4 * (r.offset + r.length)]) == r.ids_crc32
    assert all(len(s.ids) == 4 * s.padded_length and (s.padded_length == 1024 or s.padded_length & (s.padded_length - 1) == 0) for s in made.values())
