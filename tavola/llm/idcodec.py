"""Token ids in compressed files: an adaptive context-mixing range coder over independent, checksummed blocks.

A file holds documents' ids in order. Its header has the documents' names and
lengths, the ids' frequencies in the file (the order-0 prior) and, per block,
its size in bytes and the CRC-32 of its ids. A block has up to BLOCK ids; coder
and models start afresh in each, so any block can be decoded alone.

An id is predicted by order 2 (the id last seen after the two ids before it),
order 1 (after the one before it) and order 0 (adaptive counts of groups of
ids, the prior inside a group). How much of the probability each prediction
gets is learned while coding, for every state of confidence of the two higher
orders. The mixture drives a range coder with 64-bit low and carry.

Blocks do not depend on each other, so a task codes many side by side: every
array here has one entry per block (a lane), and the loop runs over positions.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TVIDS1"
BLOCK, LANES = 2048, 3072   # a lane takes about 42 kB
PRIOR_BITS, GROUP_BITS, MIX_BITS = 18, 8, 14
TABLE_BITS, CONFIDENCE = 12, 7
FREQ_BITS = PRIOR_BITS + 1   # a frequency may be all of 2 ** PRIOR_BITS
BUCKET_BITS = 6   # targets of the decoder's search share their first guess in buckets of this size
NONE = 0xFFFF
RATE, COUNT_STEP = 5, 24
TOP, LOW_LIMIT = np.uint64(1 << 63), np.uint64(1 << 31)
U = np.uint64
W = U(32)


class Prior:
    """Frequencies of the ids present, summing to 2 ** PRIOR_BITS; the most frequent ids first, cut into groups."""

    def __init__(self, present, freq):
        self.present, self.freq = present.astype(np.int64), freq.astype(np.int64)
        order = np.lexsort((self.present, -self.freq))
        ids, f = self.present[order], self.freq[order]
        start = np.cumsum(f) - f
        group = np.unique(start >> (PRIOR_BITS - GROUP_BITS), return_inverse=True)[1]
        self.groups = int(group[-1]) + 1 if len(group) else 1
        self.base = np.zeros(self.groups, np.int64)
        self.mass = np.ones(self.groups, np.int64)
        if len(ids):
            first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            self.base, self.mass = start[first], np.add.reduceat(f, first)
        size = int(self.present.max()) + 1 if len(ids) else 1
        self.group_of, self.inside, self.of = (np.zeros(size, np.int64) for _ in range(3))
        self.group_of[ids], self.inside[ids], self.of[ids] = group, start - self.base[group], f
        self.at = np.repeat(ids, f).astype(np.uint16)
        # Group, place in it and frequency of an id in one number.
        self.packed = (self.group_of << 2 * FREQ_BITS | self.inside << FREQ_BITS | self.of).astype(U)

    @classmethod
    def counted(cls, ids):
        counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
        present = np.flatnonzero(counts)
        if not len(present):
            return cls(present, present)
        if len(present) >= 1 << PRIOR_BITS - 1:
            raise ValueError("too many different ids")
        c = counts[present].astype(object if counts.sum() > 1 << 44 else np.int64)
        freq = np.maximum(1, c * ((1 << PRIOR_BITS) - len(present)) // int(counts.sum())).astype(np.int64)
        freq[freq.argmax()] += (1 << PRIOR_BITS) - freq.sum()
        return cls(present, freq)


class Lanes:
    """The adaptive models of many blocks, one lane each, for at most ``length`` ids."""

    def __init__(self, n: int, prior: Prior, length: int, guess: bool = False):
        self.prior = prior
        self.two = np.full(n << TABLE_BITS, NONE << 8, np.uint32)
        self.one = np.full(n << TABLE_BITS, NONE << 8, np.uint32)
        # A state is the two confidences and whether both orders name the same id; it holds the chances (16 bits) that
        # order 2 and, if it fails, order 1 names the right one.
        states = 2 * (CONFIDENCE + 1) ** 2
        state = np.arange(states)
        chance = np.where(state >> 4, 1 << 15, 400) << 16 | np.where(state >> 1 & CONFIDENCE, 1 << 15, 400)
        self.hits = np.tile(chance.astype(np.uint32), n)
        self.states = np.arange(n) * states
        self.table = np.arange(n) << TABLE_BITS
        # Counts of groups, brought up to date from the groups seen when the frequencies are made anew.
        self.counts = np.tile((prior.mass >> 6) + 1, (n, 1)).astype(np.float64)
        self.seen, self.counted, self.step = np.zeros((length, n), np.uint8), 0, 0
        self.spans = np.empty((n, prior.groups), np.uint32)   # start and size of every group's frequencies in one number
        buckets = (1 << MIX_BITS - BUCKET_BITS) + 1
        self.guesses = np.empty((n, buckets), np.uint8) if guess else None
        self.span_rows, self.guess_rows = np.arange(n) * prior.groups, np.arange(n) * buckets
        self.h1 = self.h2 = np.zeros(n, np.uint16)   # their lower bits are all that is used
        self.rebuild()

    def rebuild(self):
        """Cumulative group frequencies, scaled to 2 ** MIX_BITS, each at least 1; for the decoder's search also the group
        that every bucket's first target lies in."""
        g = self.prior.groups
        for k in range(0, len(self.counts), 256):   # few lanes at once stay in the cache
            counts = self.counts[k:k + 256]
            n = len(counts)
            if self.counted < self.step:
                seen = np.arange(n) * g + self.seen[self.counted:self.step, k:k + n]
                counts += COUNT_STEP * np.bincount(seen.ravel(), minlength=n * g).reshape(n, g)
            cum = np.cumsum(counts, axis=1)
            cum *= ((1 << MIX_BITS) - g) / cum[:, -1:]
            end = cum.astype(np.int32) + np.arange(1, g + 1, dtype=np.int32)
            end[:, -1] = 1 << MIX_BITS
            start = np.zeros_like(end)
            start[:, 1:] = end[:, :-1]
            self.spans[k:k + n] = start << 15 | end - start
            if self.guesses is not None:
                buckets = self.guesses.shape[1]
                first = -(-start[:, 1:] >> BUCKET_BITS) + np.arange(n)[:, None] * buckets   # where a group begins to count
                passed = np.bincount(first.ravel(), minlength=n * buckets).reshape(n, buckets)
                np.cumsum(passed, axis=1, out=self.guesses[k:k + n], dtype=np.uint8)
        self.counted = self.step
        self.flat = self.spans.reshape(-1)
        self.flat_guesses = self.guesses.reshape(-1) if self.guesses is not None else None

    def predict(self):
        """Shares of the mixture that the candidates of order 2 and 1 get."""
        mask = np.uint16((1 << TABLE_BITS) - 1)
        self.i1 = self.table + (self.h1 >> np.uint16(3) & mask)
        self.i2 = self.table + ((self.h1 ^ self.h2) & mask)
        self.e2, self.e1 = self.two.take(self.i2, mode="clip"), self.one.take(self.i1, mode="clip")
        self.s2, self.s1 = self.e2 >> 8, self.e1 >> 8
        self.c2, self.c1 = self.e2 & 255, self.e1 & 255
        self.state = self.states + ((self.c2 << 4) + (self.c1 << 1) + (self.s1 == self.s2))
        chances = self.hits.take(self.state)
        self.p2, self.p1 = (chances >> 16).view(np.int32), (chances & 0xFFFF).view(np.int32)
        f2 = self.p2 >> 2 | 1
        return f2, np.maximum(((1 << MIX_BITS) - f2) * (self.p1 >> 2) >> MIX_BITS, 1)

    def update(self, x32, group, is2, same1):
        """Learn the id that came: it is order 2's candidate, else order 1's, or neither (same1: order 1 named it)."""
        p2 = self.p2 + (is2 * np.int32(65535) - self.p2 >> RATE)
        p1 = self.p1 + (same1 * np.int32(65535) - self.p1 >> RATE)
        p1 = np.where(is2, self.p1, p1)
        self.hits[self.state] = p2.view(np.uint32) << 16 | p1.view(np.uint32)
        fresh = (x32 << 8) | 1
        some2, some1 = self.c2 > 0, self.c1 > 0
        self.two[self.i2] = np.where(is2 | some2, self.e2 + (is2 & (self.c2 < CONFIDENCE)) - (some2 & ~is2), fresh)
        self.one[self.i1] = np.where(same1 | some1, self.e1 + (same1 & (self.c1 < CONFIDENCE)) - (some1 & ~same1), fresh)
        self.seen[self.step, :len(group)] = group
        self.step += 1
        self.h2, self.h1 = self.h1 * np.uint16(5) + np.uint16(7), x32.astype(np.uint16) * np.uint16(40503) + np.uint16(12345)
        if self.step in (64, 128, 256) or self.step % 512 == 0:
            self.rebuild()

    def drop(self, keep: int):
        """Lanes from ``keep`` on have ended."""
        for name in ("states", "table", "span_rows", "guess_rows", "h1", "h2", "counts"):
            setattr(self, name, getattr(self, name)[:keep])


def encode_blocks(blocks: list, prior: Prior) -> list[bytes]:
    """Code blocks (arrays of ids, longest first) side by side."""
    n = len(blocks)
    sizes = np.array([len(b) for b in blocks])
    ids = np.zeros((n, int(sizes.max())), np.uint16)
    for k, b in enumerate(blocks):
        ids[k, :len(b)] = b
    ids = np.ascontiguousarray(ids.T)
    low, wide, pos = np.zeros(n, U), np.full(n, TOP), np.zeros(n, np.int64)
    lanes = Lanes(n, prior, int(sizes.max()))
    total, low_bits = 1 << MIX_BITS, U((1 << FREQ_BITS) - 1)
    shift = U(MIX_BITS)
    mass = prior.mass.astype(U)
    wrote: list = []     # (lanes, words)
    carries: list = []   # (lanes, how many words a lane had written: 1 is to be added to the last of them)

    def add(low, more):
        new = low + more
        over = new < low
        if over.any():
            over = np.flatnonzero(over)
            carries.append((over, pos[over]))
        return new

    def renormalise(low, wide):
        m = np.flatnonzero(wide < LOW_LIMIT)
        if len(m):
            part = low[m]
            wrote.append((m.astype(np.uint16), (part >> W).astype(np.uint32)))
            pos[m] += 1
            low[m] = part << W
            wide[m] <<= W

    live, shortest = n, int(sizes.min())
    for step in range(int(sizes.max())):
        if step >= shortest:
            live = int(np.searchsorted(-sizes, -step, side="left"))   # lanes longer than step
            lanes.drop(live)
        x = ids[step, :live]
        x32 = x.astype(np.uint32)
        f2, f1 = lanes.predict()
        is2, same1 = lanes.s2 == x32, lanes.s1 == x32
        hit = np.flatnonzero(is2 | same1)
        by2 = is2[hit]
        start = f2 + f1
        size = total - start
        start[hit] = np.where(by2, 0, f2[hit])
        size[hit] = np.where(by2, f2[hit], f1[hit])
        lo, w = low[:live], wide[:live]
        r = w >> shift
        more = r * start.astype(U)
        w = r * size.astype(U)
        known = prior.packed.take(x)
        group = (known >> U(2 * FREQ_BITS)).view(np.int64)
        span = lanes.flat.take(lanes.span_rows + group)
        start, size = span >> 15, span & 0x7FFF
        start[hit], size[hit] = 0, total
        r = w >> shift
        lo = add(lo, more + r * start)
        w = r * size
        renormalise(lo, w)
        parts, inside, of = mass.take(group), known >> U(FREQ_BITS) & low_bits, known & low_bits
        parts[hit], inside[hit], of[hit] = 1, 0, 1
        r = w // parts
        lo = add(lo, r * inside)
        w = r * of
        renormalise(lo, w)
        low[:live], wide[:live] = lo, w
        lanes.update(x32, group, is2, same1)
    for _ in range(2):
        wrote.append((np.arange(n, dtype=np.uint16), (low >> W).astype(np.uint32)))
        low <<= W
    # The words in order of their lanes, each lane's in the order they were written, then the carries.
    order = np.argsort(np.concatenate([m for m, _ in wrote]), kind="stable")
    words = np.concatenate([part for _, part in wrote])[order].astype(U)
    ends = np.cumsum(pos + 2)
    begin = ends - pos - 2
    at = np.concatenate([np.empty(0, np.int64), *(begin[over] + count - 1 for over, count in carries)])
    np.add.at(words, at, U(1))
    over = np.unique(at)
    while len(over := over[words[over] >> W > 0]):
        words[over] &= U(0xFFFFFFFF)
        over = over - 1
        words[over] += U(1)
    data = words.astype("<u4")
    return [data[x:y].tobytes() for x, y in zip(begin.tolist(), ends.tolist())]


def decode_blocks(coded: list[bytes], sizes, prior: Prior) -> list:
    """The ids of blocks coded side by side (longest first)."""
    n, sizes = len(coded), np.asarray(sizes)
    length = max(map(len, coded)) // 4 + 2
    words = np.zeros((n, length), np.uint32)
    for k, c in enumerate(coded):
        words[k, :len(c) // 4] = np.frombuffer(c, "<u4")
    flat_words, word_rows = words.ravel(), np.arange(n) * length
    code = words[:, 0].astype(U) << W | words[:, 1]
    wide, pos = np.full(n, TOP), np.full(n, 2)
    lanes = Lanes(n, prior, int(sizes.max()), guess=True)
    out = np.zeros((int(sizes.max()), n), np.uint16)
    total, shift, low_bits = 1 << MIX_BITS, U(MIX_BITS), U((1 << FREQ_BITS) - 1)
    last = U(total - 1)
    mass = prior.mass.astype(U)

    def renormalise(code, wide):
        m = np.flatnonzero(wide < LOW_LIMIT)
        if len(m):
            p = pos[m]
            code[m] = code[m] << W | flat_words[word_rows[m] + np.minimum(p, length - 1)]
            pos[m] = p + 1
            wide[m] <<= W

    live, shortest = n, int(sizes.min())
    for step in range(int(sizes.max())):
        if step >= shortest:
            live = int(np.searchsorted(-sizes, -step, side="left"))
            lanes.drop(live)
        f2, f1 = lanes.predict()
        c, w = code[:live], wide[:live]
        r = w >> shift
        v = np.minimum(c // r, last).astype(np.int32)
        start = f2 + f1
        size = total - start
        hit = np.flatnonzero(v < start)
        by2 = v[hit] < f2[hit]
        start[hit] = np.where(by2, 0, f2[hit])
        size[hit] = np.where(by2, f2[hit], f1[hit])
        c = c - r * start.astype(U)
        w = r * size.astype(U)
        r = w >> shift
        v = np.minimum(c // r, last).astype(np.uint32)
        # The last group whose start is at most v.
        at = lanes.span_rows + lanes.flat_guesses.take(lanes.guess_rows + (v >> BUCKET_BITS))
        span = lanes.flat.take(at)
        more = np.flatnonzero((span >> 15) + (span & 0x7FFF) <= v)
        while len(more):
            at[more] += 1
            span[more] = next_span = lanes.flat.take(at[more])
            more = more[(next_span >> 15) + (next_span & 0x7FFF) <= v[more]]
        start, size = span >> 15, span & 0x7FFF
        start[hit], size[hit] = 0, total
        c = c - r * start
        w = r * size
        renormalise(c, w)
        group = at - lanes.span_rows
        parts = mass.take(group)
        parts[hit] = 1
        r = w // parts
        v = np.minimum(c // r, parts - U(1)).view(np.int64)
        x32 = prior.at.take(prior.base.take(group) + v, mode="clip").astype(np.uint32)
        x32[hit] = np.where(by2, lanes.s2[hit], lanes.s1[hit])
        known = prior.packed.take(x32)
        inside, of = known >> U(FREQ_BITS) & low_bits, known & low_bits
        inside[hit], of[hit] = 0, 1
        c = c - r * inside
        w = r * of
        renormalise(c, w)
        code[:live], wide[:live] = c, w
        out[step, :live] = x32
        lanes.update(x32, known >> U(2 * FREQ_BITS), lanes.s2 == x32, lanes.s1 == x32)
    out = np.ascontiguousarray(out.T)
    return [out[k, :sizes[k]] for k in range(n)]


def _section(data: bytes) -> bytes:
    return struct.pack("<I", len(data)) + data


def side_by_side(n: int) -> list[slice]:
    """The groups that ``n`` blocks are coded in, of at most LANES and about one size."""
    groups = -(-n // LANES)
    return [slice(k * n // groups, (k + 1) * n // groups) for k in range(groups)]


def narrow(ids):
    """Ids as files hold them, two bytes each."""
    if len(ids) and (ids.min() < 0 or ids.max() >= NONE):
        raise ValueError("ids must be from 0 to 65,534")
    return ids.astype(np.uint16, copy=False)


def encode_file(names: list, documents: list) -> bytes:
    """A file of documents (name: int or None; ids: arrays of numbers under 65,535)."""
    ids = narrow(np.concatenate(documents)) if documents else np.empty(0, np.uint16)
    prior = Prior.counted(ids)
    blocks = [ids[i:i + BLOCK] for i in range(0, len(ids), BLOCK)]
    coded = [c for part in side_by_side(len(blocks)) for c in encode_blocks(blocks[part], prior)]
    known = np.array([n is not None for n in names], bool)
    values = np.array([n if n is not None else 0 for n in names], "<i8")
    sizes = np.array([len(d) for d in documents], "<i8")
    directory = np.array([(len(c), zlib.crc32(b.astype("<u4"))) for c, b in zip(coded, blocks)], "<u4")
    head = b"".join(_section(zlib.compress(part, 6)) for part in (
        known.tobytes(), values.tobytes(), sizes.tobytes(), prior.present.astype("<u4").tobytes(), prior.freq.astype("<u4").tobytes(),
        directory.tobytes()))
    return b"".join([MAGIC, struct.pack("<II", len(head), zlib.crc32(head)), head, *coded])


def decode_file(data: bytes) -> tuple[list, list]:
    """(names, documents) of a file, ids of two bytes; every checksum is verified."""
    if data[:len(MAGIC)] != MAGIC:
        raise ValueError("not a file of ids")
    n, crc = struct.unpack_from("<II", data, len(MAGIC))
    at = len(MAGIC) + 8
    head = data[at:at + n]
    if zlib.crc32(head) != crc:
        raise ValueError("damaged header")
    body, parts, k = at + n, [], 0
    while k < len(head):
        size, = struct.unpack_from("<I", head, k)
        parts.append(zlib.decompress(head[k + 4:k + 4 + size]))
        k += 4 + size
    known, values = np.frombuffer(parts[0], bool), np.frombuffer(parts[1], "<i8")
    sizes, directory = np.frombuffer(parts[2], "<i8"), np.frombuffer(parts[5], "<u4").reshape(-1, 2)
    prior = Prior(np.frombuffer(parts[3], "<u4"), np.frombuffer(parts[4], "<u4"))
    total = int(sizes.sum())
    ends = body + np.cumsum(directory[:, 0].astype(np.int64)) if len(directory) else np.empty(0, np.int64)
    if len(directory) != -(-total // BLOCK) or (len(ends) and ends[-1] != len(data)):
        raise ValueError("file cut short")
    starts = ends - directory[:, 0]
    places = list(zip(starts.tolist(), ends.tolist()))
    lengths = np.minimum(BLOCK, total - BLOCK * np.arange(len(places)))
    ids = np.empty(total, np.uint16)
    for part in side_by_side(len(places)):
        try:
            with np.errstate(divide="ignore"):
                blocks = decode_blocks([data[a:b] for a, b in places[part]], lengths[part], prior)
        except IndexError as e:
            raise ValueError("damaged block") from e
        for k, block in enumerate(blocks, part.start):
            if zlib.crc32(block.astype("<u4")) != directory[k, 1]:
                raise ValueError(f"block {k} does not match its checksum")
            ids[k * BLOCK:k * BLOCK + len(block)] = block
    names = [int(v) if ok else None for ok, v in zip(known.tolist(), values.tolist())]
    return names, np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else []
