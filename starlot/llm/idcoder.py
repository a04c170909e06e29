"""Adaptive context-mixing range coder for token ids.

Pairs of neighbours that recur in a batch become symbols of their own first, noted in its header, twice over; what is coded are
these symbols. They are cut into blocks, each a stream of its own with a checksum of its ids. All blocks of a batch advance
together, one symbol of each at a time, and teach one model, which starts afresh with the batch: a step is a few array
operations over the blocks, and the model's tables are small enough to stay near the processor. Decoding runs the same model.

Three predictions are mixed for each symbol. Order 0 is a frequency: the batch's header tells the class of every symbol, those
of a class being about equally frequent, and a symbol costs its class and its number within the class. Order 1 and order 2
are symbols, the one that followed the last and the last two when they stood before; order 1 begins with
the most frequent followers from the header. How far each of the two is believed is a mix of two adaptive
estimates, by how often the prediction held in its place and by how frequent the predicted symbol is; the mix's weights move
towards the estimate that did better. Order 0 has what they leave. A range coder (48 bits, in words of 16) codes
"order 2 is right", "order 1 is right" or the class; numbers within classes follow as bits of their own.

What follows is learnt at each step; where blocks meet in a place, the last of them is noted. Estimates and
weights are brought up to date every ``PERIOD`` steps, from counts over all blocks. Everything is whole numbers (a division in
floating point is exact to its floor), so machines agree. Memory is bounded by ``LANES`` blocks.

Layout of a batch, little-endian: magic, number of ids, symbols, symbols a block, blocks, different ids, pairs, bytes of the tables;
the tables, deflated (steps between the different ids, the pairs' halves, the symbols' classes, whether each has a follower, the
followers); for each block its checksum (CRC-32 of its ids as unsigned 32 bits), the number of its 16-bit words and
that of its bits; then all 16-bit words, then all bits in 32-bit words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Fixed values of the format.
MAGIC = b"SIDC0003"
HEAD = struct.Struct("<8sQQIIIIQ")
BLOCK = 1024
LANES = 16384

# Rounds in which pairs become symbols, how often such a pair is found at least, and the bits of its hash.
ROUNDS, PAIRED, HASHED = 2, 32, 17
MULTIPLIER = 0x9E3779B97F4A7C15
# Places of order 2, 2 ** this; order 1 has one for each symbol. A place holds a symbol, its class and a trust.
PLACED = 19
TRUST, CLASSES = 16, 64
# A place is its symbol, class, trust and one bit that is 0; what stands below the symbol, with a bit for whether both orders agree, is its kind.
TAG_BITS, HELD = 11, 2 * TRUST
TAG = 1 << TAG_BITS
# Probabilities have 16 bits, order-0 classes 12 of them; order 0 keeps at least 2 ** 12 of 2 ** 16.
ONE, SCALE = 1 << 16, 12
MOST = ONE - (3 << 11)
# Steps between two looks at the counts, and how many counts an estimate keeps.
PERIOD, KEPT = 32, 1 << 12
MIX_RATE, MIX = 16, 256
FOLLOWS = (4, 8)
DENSE = 1 << 22
TOGETHER, COUNTED = 1 << 18, 1 << 20
SPAN, FULL, LOW = np.uint64((1 << 48) - 1), np.uint64(1 << 32), np.uint64((1 << 32) - 1)
WORD, TAKEN = np.uint64(16), np.uint64(32)


def _moves() -> np.ndarray:
    """How a place changes, by its kind and one more if its prediction held; ``PASS`` if it passes to what was met."""
    trust, held = np.arange(TAG) // 2 % TRUST, np.arange(TAG) % 2 == 1
    moved = np.where(held, np.minimum(trust + 1, TRUST - 1), trust >> 1) - trust
    return np.tile(np.where(held | (trust > 1), 2 * moved, PASS), 2).astype(np.int32)


PASS = -HELD
MOVES = _moves()


class Tables:
    """Order 0 and the followers of a batch."""

    def __init__(self, classes: np.ndarray, followers: np.ndarray):
        self.classes = classes.astype(np.int64)
        self.followers = followers.astype(np.int32)
        size = np.bincount(self.classes, minlength=CLASSES)
        first = np.cumsum(size) - size
        members = np.argsort(self.classes, kind="stable")
        number = np.empty(len(classes), dtype=np.int64)
        number[members] = np.arange(len(classes)) - first[self.classes[members]]
        # A class is worth its symbols times about what each is found, 2 ** (class / 2).
        weight = size * ((1 << np.arange(CLASSES) // 2) * (2 + np.arange(CLASSES) % 2))
        exact = weight * ((1 << SCALE) - CLASSES) // max(1, int(weight.sum()))
        width = np.where(size > 0, exact + 1, 0)
        width[int(width.argmax())] += (1 << SCALE) - int(width.sum())
        self.upto = np.concatenate([[0], np.cumsum(width)]).astype(np.int32)
        self.of = np.repeat(np.arange(CLASSES), width)
        # Numbers of a class of n take k bits or, from 2 ** (k + 1) - n on, one more, which stands above the others.
        least = np.array([max(1, int(n)).bit_length() - 1 for n in size], dtype=np.int64)
        bits = least[self.classes]
        moved = number + (2 << bits) - size[self.classes]
        long = number >= (2 << bits) - size[self.classes]
        self.bits = (bits + long).astype(np.uint8)
        self.value = np.where(long, (moved >> 1) | ((moved & 1) << bits), number).astype(np.uint32)
        # The symbol that a class and its next bits, as many as its longest numbers have, say.
        self.mask = (2 << least) - 1
        self.first = np.cumsum(2 << least) - (2 << least)
        self.says = np.zeros(int((2 << least).sum()), dtype=np.int64)
        place = self.first[self.classes] + self.value
        self.says[place] = np.arange(len(classes))
        self.says[(place + (1 << bits))[~long]] = np.flatnonzero(~long)

    @staticmethod
    def fitted(at: np.ndarray, different: int) -> Tables:
        counts = np.maximum(1, np.bincount(at, minlength=different))
        octave = np.floor(np.log2(counts)).astype(np.int64)
        classes = np.minimum(2 * octave + (2 * counts >= 3 << octave), CLASSES - 1)
        followers = np.full(different, -1)
        wide = np.uint32 if different < 1 << 16 else np.uint64
        pairs = at[:-1].astype(wide) * wide(different)
        pairs += at[1:].astype(wide)
        pairs.sort()
        edge = np.flatnonzero(np.concatenate([np.ones(min(1, len(pairs)), dtype=bool), pairs[1:] != pairs[:-1]]))
        n = np.diff(edge, append=len(pairs))
        # Only pairs that recur are looked at further.
        often = n >= FOLLOWS[0]
        if often.any():
            pairs, n = pairs[edge[often]].astype(np.int64), n[often]
            before, after = pairs // different, pairs % different
            groups = np.flatnonzero(np.diff(before, prepend=-1))
            best = np.maximum.reduceat((n << 32) | after, groups)
            who = before[groups]
            worth = (best >> 32) * FOLLOWS[1] >= counts[who]
            followers[who[worth]] = (best & 0xFFFFFFFF)[worth]
        return Tables(classes, followers)


class Belief:
    """How far one order is believed, by the class and trust of its place and whether both orders agree."""

    def __init__(self, alone: bool):
        # Order 1 is asked only where it does not say what order 2 does.
        self.alone = alone
        # Estimates by agreement and trust, and by class: how often a prediction held, and how often it was asked.
        trust = np.tile(np.arange(TRUST), 2)
        self.by_trust = np.stack([(trust + 1) * 8, (trust + 4) * 8]).astype(np.int64)
        self.by_class = np.stack([np.full(CLASSES, 8), np.full(CLASSES, 24)]).astype(np.int64)
        self.mix = np.full(2 * TRUST, MIX // 2, dtype=np.int64)
        self._settle()

    def _settle(self) -> None:
        self.a, self.b = (self.by_trust[0] * ONE // self.by_trust[1]).reshape(2, 1, TRUST), (self.by_class[0] * ONE // self.by_class[1]).reshape(1, CLASSES, 1)
        mix = self.mix.reshape(2, 1, TRUST)
        said = np.clip((self.a * mix + self.b * (MIX - mix)) // MIX, 64, MOST)
        if self.alone:
            said[1] = 0
        self.said = np.repeat(said.ravel().astype(np.int32), 2)

    def learn(self, met: np.ndarray) -> None:
        """``met``: for each block and step the kind of its place, and one more where the prediction held; what is beyond does not count."""
        n = np.bincount(met, minlength=2 * TAG)[:2 * TAG].reshape(2, CLASSES, TRUST, 2)
        asked, held = n.sum(axis=3), n[..., 1]
        by = asked.sum(axis=1).ravel()
        better = ((self.a - self.b) * (2 * held - asked)).sum(axis=1).ravel()
        self.mix = np.clip(self.mix + better * MIX_RATE // (ONE * np.maximum(by, 1)), 16, MIX - 16)
        for kept, new in ((self.by_trust, (held.sum(axis=1).ravel(), by)), (self.by_class, (held.sum(axis=(0, 2)), asked.sum(axis=(0, 2))))):
            kept += new
            much = kept[1] > KEPT
            kept[:, much] = np.maximum(1, kept[:, much] * KEPT // kept[1, much])
        self._settle()


class Model:
    """The model of a batch, whose blocks advance together; the same for both directions.

    Symbols are tags here: their number, their class and no trust, as places hold them.
    """

    def __init__(self, lanes: int, tables: Tables):
        n = len(tables.classes)
        self.tags = (np.arange(n) * TAG + tables.classes * HELD).astype(np.int32 if n * TAG < 1 << 31 else np.int64)
        known = tables.followers >= 0
        self.one = np.zeros(n, dtype=self.tags.dtype)
        self.one[known] = self.tags[tables.followers[known]] + 4
        self.two = np.zeros(1 << PLACED, dtype=self.tags.dtype)
        self.beliefs = (Belief(False), Belief(True))
        self.last, self.mixed = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.uint32)
        self.at = np.zeros(lanes, dtype=np.int64)
        self.met = np.zeros((2, PERIOD, lanes), dtype=np.int32)
        self.step = 0

    def look(self) -> tuple[np.ndarray, np.ndarray]:
        """Where order 1 begins and where order 0 begins in 2 ** 16; order 2 begins at 0."""
        two, one = self.two.take(self.at), self.one.take(self.last)
        self.says_two, self.says_one = two & -HELD, one & -HELD
        agree = (self.says_one == self.says_two) * np.int32(TAG)
        self.held_two, self.held_one = two, one
        self.kind_two, self.kind_one = (two & TAG - 1) + agree, (one & TAG - 1) + agree
        first = self.beliefs[0].said.take(self.kind_two)
        left = ONE - first
        share = np.minimum(left * (self.beliefs[1].said.take(self.kind_one) >> 1) >> 15, left - (1 << SCALE))
        return first, first + share

    def learn(self, now: np.ndarray, two: np.ndarray, one: np.ndarray) -> None:
        """``two`` and ``one`` tell where the orders are right."""
        row = self.step % PERIOD
        met_two, met_one = self.kind_two + two, self.kind_one + one
        for places, at, held, met in ((self.two, self.at, self.held_two, met_two), (self.one, self.last, self.held_one, met_one)):
            move = MOVES.take(met)
            places[at] = np.where(move == PASS, now + 2, held + move)
        self.met[0, row] = met_two
        self.met[1, row] = met_one + two * np.int32(2 * TAG)
        self.last = (now >> TAG_BITS).astype(np.int64)
        mixed = self.last.astype(np.uint32) * np.uint32(0x9E3779B1)
        self.at = ((mixed ^ (self.mixed >> np.uint32(5))) >> np.uint32(32 - PLACED)).astype(np.int64)
        self.mixed = mixed
        self.step += 1
        if row == PERIOD - 1:
            for belief, met in zip(self.beliefs, self.met):
                belief.learn(met.ravel())


def _parts(n: int) -> list[slice]:
    return [slice(i, min(i + TOGETHER, n)) for i in range(0, n, TOGETHER)]


def _numbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids in ascending order, and the place among them of each id."""
    top = int(ids.max())
    if top >= DENSE:
        different, at = np.unique(ids, return_inverse=True)
        return different, at.astype(np.int32)
    found, at = np.zeros(top + 1, dtype=bool), np.empty(len(ids), dtype=np.int32)
    for part in _parts(len(ids)):
        found[ids[part]] = True
    different = np.flatnonzero(found)
    place = np.zeros(top + 1, dtype=np.int32)
    place[different] = np.arange(len(different))
    for part in _parts(len(ids)):
        at[part] = place.take(ids[part])
    return different.astype(np.uint32), at


def _pairs(at: np.ndarray, part: slice, wide: type) -> np.ndarray:
    """Pairs of neighbours as numbers of the unsigned type ``wide``."""
    out = at[part].astype(wide)
    out <<= wide(4 * out.itemsize)
    out |= at[part.start + 1:part.stop + 1].astype(wide)
    return out


def _paired(at: np.ndarray, different: int) -> tuple[np.ndarray, np.ndarray]:
    """``at`` with symbols for pairs that recur, from ``different`` on, and the halves of those pairs (pairs x 2)."""
    halves, n = [np.zeros((0, 2), dtype=np.uint32)], different
    for _ in range(ROUNDS):
        # Of the pairs of one hash the last stands; only pairs equal to it are counted.
        wide = np.uint32 if n <= 1 << 16 else np.uint64
        size = 8 * wide().itemsize
        stands, count = np.zeros(1 << HASHED, dtype=wide), np.zeros((1 << HASHED) + 1, dtype=np.int64)
        hashes = np.empty(max(0, len(at) - 1), dtype=np.int32)
        for part in _parts(len(hashes)):
            pair = _pairs(at, part, wide)
            place = ((pair * wide(MULTIPLIER >> 64 - size | 1)) >> wide(size - HASHED)).astype(np.int32)
            hashes[part] = place
            stands[place] = pair
        for part in _parts(len(hashes)):
            place = hashes[part]
            place[stands.take(place) != _pairs(at, part, wide)] = 1 << HASHED
        for i in range(0, len(hashes), COUNTED):
            count += np.bincount(hashes[i:i + COUNTED], minlength=len(count))
        often = np.flatnonzero(count[:-1] >= PAIRED)
        if not len(often):
            break
        symbol = np.full(len(count), -1, dtype=np.int32)
        symbol[often] = np.arange(n, n + len(often))
        at = _replaced(at, hashes, symbol)
        pair = stands[often]
        halves.append(np.column_stack([pair >> wide(size // 2), pair & wide((1 << size // 2) - 1)]).astype(np.uint32))
        n += len(often)
    return at, np.concatenate(halves)


def _replaced(at: np.ndarray, hashes: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """``at`` with a symbol for each pair that has one; of pairs that overlap in a row every other one is taken."""
    out, used = [], False
    for part in _parts(len(at)):
        own = at[part].copy()
        found = symbol.take(hashes[part])
        if used:
            # The half of a pair of the part before.
            found[:1] = -1
        where = np.flatnonzero(found >= 0)
        first = np.ones(len(where), dtype=bool)
        np.not_equal(where[1:], where[:-1] + 1, out=first[1:])
        rows = np.flatnonzero(first)
        nth = np.arange(len(where)) - np.repeat(rows, np.diff(rows, append=len(where)))
        where = where[nth & 1 == 0]
        own[where] = found.take(where)
        keep = np.ones(len(own) + 1, dtype=bool)
        keep[0] = not used
        keep[where + 1] = False
        out.append(own[keep[:-1]])
        used = not keep[-1]
    return np.concatenate(out)


class Spelling:
    """The ids of every symbol."""

    def __init__(self, different: np.ndarray, halves: np.ndarray):
        spelt = [(int(i),) for i in different.tolist()]
        for left, right in halves.tolist():
            spelt.append(spelt[left] + spelt[right])
        self.size = np.fromiter(map(len, spelt), dtype=np.int64, count=len(spelt))
        self.begin = np.cumsum(self.size) - self.size
        self.ids = np.fromiter((i for s in spelt for i in s), dtype=np.uint32, count=int(self.size.sum()))

    def spell(self, symbols: np.ndarray) -> np.ndarray:
        size = self.size.take(symbols)
        ends = np.cumsum(size)
        return self.ids.take(np.repeat(self.begin.take(symbols) - (ends - size), size) + np.arange(int(size.sum())))


def _code(grid: np.ndarray, tables: Tables) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (steps x blocks) symbols: 16-bit words of all blocks one after another, the number of each block's, and which symbols order 0 codes."""
    steps, lanes = grid.shape
    model = Model(lanes, tables)
    low, span = np.zeros(lanes, dtype=np.uint64), np.full(lanes, SPAN)
    # A step narrows a span to a 2 ** 16th at least: one word a step at most. A word of 17 bits carries into the one before.
    room = steps + 3
    out = np.zeros(lanes * room, dtype=np.uint32)
    begin = np.arange(lanes) * room
    end = begin.copy()
    plain = np.zeros((steps, lanes), dtype=bool)
    lower, upper = tables.upto[:-1].take(tables.classes), tables.upto[1:].take(tables.classes)
    for step in range(steps):
        symbols = grid[step]
        now = model.tags.take(symbols)
        one, zero = model.look()
        two_right, one_right = now == model.says_two, now == model.says_one
        np.logical_not(two_right | one_right, out=plain[step])
        rest = ONE - zero
        start = np.where(two_right, 0, np.where(one_right, one, zero + (rest * lower.take(symbols) >> SCALE)))
        high = np.where(two_right, one, np.where(one_right, zero, zero + (rest * upper.take(symbols) >> SCALE)))
        unit = span >> WORD
        low += unit * start.astype(np.uint64)
        span = unit * (high - start).astype(np.uint64)
        which = np.flatnonzero(span < FULL)
        at, passed = end.take(which), low.take(which)
        out[at] = passed >> TAKEN
        end[which] = at + 1
        low[which] = (passed & LOW) << WORD
        span[which] = span.take(which) << WORD
        model.learn(now, two_right, one_right)
    for _ in range(3):
        out[end] = low >> TAKEN
        low = (low & LOW) << WORD
        end += 1
    words = np.concatenate([out[b:e] for b, e in zip(begin.tolist(), end.tolist())])
    while len(carried := np.flatnonzero(words >> 16)):
        words[carried] &= 0xFFFF
        words[carried - 1] += 1
    return words.astype("<u2"), end - begin, plain


def _numbers(symbols: np.ndarray, plain: np.ndarray, tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the numbers within classes, all blocks (blocks x symbols) one after another, in 32-bit words, and the number of bits of each."""
    width = np.where(plain, tables.bits.take(symbols), 0)
    counts = width.sum(axis=1, dtype=np.int64)
    out, done = np.zeros(int(counts.sum()) // 32 + 2, dtype=np.uint32), 0
    some = max(1, TOGETHER // symbols.shape[1])
    for k in range(0, len(symbols), some):
        coded = np.flatnonzero(plain[k:k + some])
        own = width[k:k + some].ravel().take(coded).astype(np.int64)
        ends = done + np.cumsum(own)
        at = ends - own
        shifted = tables.value.take(symbols[k:k + some].ravel().take(coded)).astype(np.uint64) << (at & 31).astype(np.uint64)
        place = (at >> 5) - (done >> 5)
        # Bits of different symbols never overlap, so sums are unions; below 2 ** 53 they are exact.
        n = int(place[-1]) + 2 if len(place) else 0
        low = np.bincount(place, weights=(shifted & LOW).astype(np.float64), minlength=n)
        high = np.bincount(place + 1, weights=(shifted >> TAKEN).astype(np.float64), minlength=n)
        out[done >> 5:(done >> 5) + n] += (low[:n] + high[:n]).astype(np.uint32)
        done = int(ends[-1]) if len(ends) else done
    return out[:-(-done // 32)], counts


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """The coded batches of ``ids``, one after another."""
    ids = np.ascontiguousarray(ids, dtype=np.uint32)
    step = block * LANES
    return b"".join(_encode_batch(ids[i:i + step], block) for i in range(0, len(ids), step))


def _encode_batch(ids: np.ndarray, block: int) -> bytes:
    different, at = _numbered(ids)
    at, halves = _paired(at, len(different))
    blocks = -(-len(at) // block)
    n = len(different) + len(halves)
    tables, spelling = Tables.fitted(at, n), Spelling(different, halves)
    whole = np.zeros((blocks, block), dtype=np.int32)
    whole.ravel()[:len(at)] = at
    coded, lengths, plain = _code(np.ascontiguousarray(whole.T), tables)
    words, counts = _numbers(whole, np.ascontiguousarray(plain.T), tables)
    follows = tables.followers >= 0
    noted = zlib.compress(b"".join([
        np.diff(different, prepend=np.uint32(0)).astype("<u4").tobytes(), halves.astype("<u4").tobytes(), tables.classes.astype("u1").tobytes(),
        np.packbits(follows).tobytes(), tables.followers[follows].astype("<u4").tobytes(),
    ]), 1)
    sums = _checksums(ids, at, spelling, block)
    table = np.column_stack([np.array(sums, dtype=np.uint32), lengths.astype(np.uint32), counts.astype(np.uint32)]).astype("<u4")
    parts = [HEAD.pack(MAGIC, len(ids), len(at), block, blocks, len(different), len(halves), len(noted)), noted, table.tobytes()]
    return b"".join([*parts, coded.tobytes(), words.astype("<u4").tobytes()])


def _checksums(ids: np.ndarray, symbols: np.ndarray, spelling: Spelling, block: int) -> list[int]:
    """The checksum of each block's ids."""
    ends = np.cumsum(np.add.reduceat(spelling.size.take(symbols), np.arange(0, len(symbols), block)))
    whole = ids.astype("<u4", copy=False)
    return [zlib.crc32(whole[b:e]) for b, e in zip([0, *ends[:-1].tolist()], ends.tolist())]


def decode(data: bytes) -> np.ndarray:
    """The ids of all batches; a block whose ids do not have its checksum is an error."""
    view, out, at = memoryview(data), [], 0
    while at < len(view):
        ids, used = _decode_batch(view[at:])
        out.append(ids)
        at += used
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)


def _noted(data: bytes, n: int, pairs: int) -> tuple[Spelling, Tables]:
    try:
        plain = zlib.decompress(data)
    except zlib.error as error:
        raise ValueError("the tables of a batch are damaged") from error
    different = np.cumsum(np.frombuffer(plain, dtype="<u4", count=n), dtype=np.uint32)
    halves = np.frombuffer(plain, dtype="<u4", count=2 * pairs, offset=4 * n).reshape(pairs, 2)
    at, both = 4 * n + 8 * pairs, n + pairs
    classes = np.frombuffer(plain, dtype="u1", count=both, offset=at)
    follows = np.unpackbits(np.frombuffer(plain, dtype="u1", count=-(-both // 8), offset=at + both), count=both).astype(bool)
    followers = np.full(both, -1)
    followers[follows] = np.frombuffer(plain, dtype="<u4", offset=at + both + -(-both // 8))
    return Spelling(different, halves), Tables(classes, followers)


def _decode_batch(view: memoryview) -> tuple[np.ndarray, int]:
    magic, total, total_symbols, block, blocks, n, pairs, noted = HEAD.unpack(view[:HEAD.size])
    if magic != MAGIC:
        raise ValueError("no coded ids here")
    at = HEAD.size
    spelling, tables = _noted(bytes(view[at:at + noted]), n, pairs)
    at += noted
    table = np.frombuffer(view[at:at + 12 * blocks], dtype="<u4").reshape(blocks, 3).astype(np.int64)
    at += 12 * blocks
    lengths, counts = table[:, 1], table[:, 2]
    size = 2 * int(lengths.sum())
    # Zeros behind the last block, as a damaged block's decoder may read on.
    coded = np.concatenate([np.frombuffer(view[at:at + size], dtype="<u2"), np.zeros(4, dtype=np.uint16)])
    at += size
    size = -(-int(counts.sum()) // 32)
    words = np.concatenate([np.frombuffer(view[at:at + 4 * size], dtype="<u4"), np.zeros(2, dtype=np.uint32)]).astype(np.int64)
    at += 4 * size
    # From every word on 62 bits, of which a number takes at most 31 behind the first 31.
    bits = words[:-1] | ((words[1:] & 0x3FFFFFFF) << 32)
    grid = _decoded(block, blocks, tables, coded, lengths, bits, counts)
    symbols = np.ascontiguousarray(grid.T).ravel()[:total_symbols]
    ids = spelling.spell(symbols)
    if len(ids) != total or _checksums(ids, symbols, spelling, block) != table[:, 0].tolist():
        raise ValueError("a block does not have its checksum")
    return ids, at


def _decoded(steps: int, lanes: int, tables: Tables, coded: np.ndarray, lengths: np.ndarray, bits: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The symbols (steps x blocks) of coded blocks."""
    model = Model(lanes, tables)
    place = np.cumsum(lengths) - lengths
    bit = np.cumsum(counts) - counts
    span, code = np.full(lanes, SPAN), np.zeros(lanes, dtype=np.uint64)
    for _ in range(3):
        code = (code << WORD) | coded.take(place, mode="clip")
        place += 1
    out = np.zeros((steps, lanes), dtype=np.int32)
    says, width = model.tags.take(tables.says), tables.bits.take(tables.says)
    for step in range(steps):
        one, zero = model.look()
        unit = span >> WORD
        # Both are below 2 ** 53 and the quotient is below 2 ** 16, so its floor is exact.
        target = np.minimum(code / np.maximum(unit, 1), ONE - 1).astype(np.int32)
        two_right, plain = target < one, np.flatnonzero(target >= zero)
        start, high = np.where(two_right, 0, one), np.where(two_right, one, zero)
        now = np.where(two_right, model.says_two, model.says_one)
        base = zero.take(plain)
        rest = ONE - base
        # The last place of 2 ** 12 whose share of the rest begins at or before the target.
        kind = tables.of.take((((target.take(plain) - base + 1) << SCALE) - 1) // rest)
        start[plain] = base + (rest * tables.upto.take(kind) >> SCALE)
        high[plain] = base + (rest * tables.upto.take(kind + 1) >> SCALE)
        code -= unit * start.astype(np.uint64)
        span = unit * (high - start).astype(np.uint64)
        which = np.flatnonzero(span < FULL)
        at = place.take(which)
        code[which] = (code.take(which) << WORD) | coded.take(at, mode="clip")
        place[which] = at + 1
        span[which] = span.take(which) << WORD
        at = bit.take(plain)
        number = tables.first.take(kind) + (bits.take(at >> 5, mode="clip") >> (at & 31) & tables.mask.take(kind))
        bit[plain] = at + width.take(number)
        now[plain] = says.take(number)
        model.learn(now, two_right, now == model.says_one)
        out[step] = model.last
    return out
