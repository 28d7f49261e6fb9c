"""A range coder for blocks of token ids that mixes predictions of order 0, 1 and 2.

Every block starts with an empty model and can be decoded by itself. The model sees dense slots instead
of ids: slot 0 announces an id that is new in the block (its 16 bits follow), slot k the k-th distinct id.

* Order 0: adaptive counts of all slots. Their running sums are renewed after 8, 16, 32 and 64 tokens and then
  every 128; an id that is new since the last renewal is announced again, with its 16 bits.
* Order 1 and 2: the slot that last followed the same one (two) slots, with a confidence of 0 to 7.
* Mixing: for each confidence the coder learns how often that prediction holds. These rates split the
  probability mass among the order-2 prediction, the order-1 prediction and the order-0 counts, so one
  interval of the mixture is coded per token.

Blocks are coded in lockstep: each numpy operation advances every block of a batch by one token.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4096
#: Most tokens of a block. A block with more than SLOTS - 1 distinct ids is cut in two.
BLOCK = 2 * (SLOTS - 1)
_ALL, _RAW = 26, 16  # bits of the total of a mixture and of a new id
_TOP, _BOT = np.uint64(1 << 32), np.uint64(1 << 31)
_U32 = np.uint64(32)
_CAP = 64512  # 63/64 of 2^16: some mass always stays with order 0


def cut_blocks(ids: np.ndarray) -> list[np.ndarray]:
    """Consecutive blocks of at most BLOCK ids and SLOTS - 1 distinct ids."""
    out = []
    for at in range(0, ids.size, BLOCK):
        block = ids[at : at + BLOCK]
        if block.size >= SLOTS and np.unique(block).size >= SLOTS:
            out += [block[: SLOTS - 1], block[SLOTS - 1 :]]
        else:
            out.append(block)
    return out


def _renews(t: int) -> bool:
    """Whether the running sums are renewed behind token t."""
    n = t + 1
    return n % 128 == 0 or n in (8, 16, 32, 64)


class _Model:
    """The state of all lanes; ``a`` is the number of lanes that are still active (a prefix)."""

    def __init__(self, lanes: int) -> None:
        self.f = np.zeros(lanes * SLOTS, np.uint16)
        self.f[::SLOTS] = 1
        self.lane = np.arange(lanes)
        self.base = (self.lane << 15).astype(np.int32)
        #: Running sums of f as of the last renewal, each lane above those before it, so that one search serves all.
        self.sum = np.empty((lanes, SLOTS + 1), np.int32)
        #: Slots that the running sums know, and slots in use.
        self.ready, self.known = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        # Slot that came last, times eight, plus its confidence.
        self.p1, self.p2 = np.zeros(lanes * SLOTS, np.uint16), np.zeros(lanes * SLOTS, np.uint16)
        start = (np.arange(8) * 7000 + 6000).astype(np.int64)
        self.w1, self.w2 = np.tile(start, lanes), np.tile(start, lanes)
        self.prev, self.prev2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.renew(lanes)

    def renew(self, a: int) -> None:
        used = int(self.known[:a].max()) + 1
        counts = self.f.reshape(-1, SLOTS)[:a, :used]
        self.sum[:a, 0] = self.base[:a]
        np.cumsum(counts, axis=1, dtype=np.int32, out=self.sum[:a, 1 : used + 1])
        self.sum[:a, 1 : used + 1] += self.base[:a, None]
        self.sum[:a, used + 1 :] = self.sum[:a, used, None]
        self.total = (self.sum[:, used] - self.base).astype(np.int64) if a == self.lane.size else np.r_[
            (self.sum[:a, used] - self.base[:a]).astype(np.int64), self.total[a:]
        ]
        self.ready[:a] = self.known[:a]

    def predict(self, a: int) -> None:
        lane = self.lane[:a]
        base = lane * SLOTS
        self.at1 = base + self.prev[:a]
        self.at2 = base + ((self.prev[:a] * 1031 + self.prev2[:a] * 2719) & (SLOTS - 1))
        g1, g2 = self.p1[self.at1].astype(np.int64), self.p2[self.at2].astype(np.int64)
        self.c1, self.c2, self.k1, self.k2 = g1 >> 3, g2 >> 3, g1 & 7, g2 & 7
        self.i1, self.i2 = lane * 8 + self.k1, lane * 8 + self.k2
        self.r1, self.r2 = self.w1[self.i1], self.w2[self.i2]
        self.m2 = (self.r2 << (_ALL - 16)) * (self.c2 > 0)
        self.m1 = ((((1 << _ALL) - self.m2) * self.r1) >> 16) * (self.c1 > 0)
        self.m0 = (1 << _ALL) - self.m2 - self.m1

    def sums(self, a: int, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scaled order-0 sum below ``slot`` and through it."""
        at = self.lane[:a] * (SLOTS + 1) + slot
        flat, total = self.sum.ravel(), self.total[:a]
        below = (flat[at] - self.base[:a]).astype(np.int64)
        through = (flat[at + 1] - self.base[:a]).astype(np.int64)
        return self.m0 * below // total, self.m0 * through // total

    def interval(self, a: int, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of ``slot`` in the mixture."""
        low, high = self.sums(a, slot)
        start = low + self.m1 * (self.c1 < slot) + self.m2 * (self.c2 < slot)
        return start, high - low + self.m1 * (self.c1 == slot) + self.m2 * (self.c2 == slot)

    def find(self, a: int, v: np.ndarray) -> np.ndarray:
        """The slot whose interval holds ``v``."""
        s1, n1 = self.interval(a, self.c1)
        s2, n2 = self.interval(a, self.c2)
        in1, in2 = (v >= s1) & (v < s1 + n1), (v >= s2) & (v < s2 + n2)
        rest = v - np.where(v >= s1 + n1, self.m1, 0) - np.where(v >= s2 + n2, self.m2, 0)
        rest = np.clip(rest, 0, self.m0 - 1)
        u = ((rest + 1) * self.total[:a] - 1) // self.m0
        lane = self.lane[:a]
        found = np.searchsorted(self.sum[:a].ravel(), (u + self.base[:a]).astype(np.int32), "right") - 1 - lane * (SLOTS + 1)
        return np.where(in1, self.c1, np.where(in2, self.c2, found))

    def announce(self, lane: np.ndarray, fresh: np.ndarray) -> None:
        """Count announcements, and the slots that they bring into use."""
        self.f[lane * SLOTS] += 1
        self.known[lane] += fresh

    def learn(self, a: int, slot: np.ndarray) -> None:
        """Take in the slot just coded (the announced one after an announcement)."""
        self.f[self.lane[:a] * SLOTS + slot] += 1
        for guess, at, p, sure, index, rate, w in (
            (self.c1, self.at1, self.p1, self.k1, self.i1, self.r1, self.w1),
            (self.c2, self.at2, self.p2, self.k2, self.i2, self.r2, self.w2),
        ):
            hit = guess == slot
            w[index] = np.minimum(rate + ((((hit * 65536) - rate) >> 5) * (guess > 0)), _CAP)
            p[at] = slot * 8 + np.minimum(sure + 1, 7) * hit
        self.prev2[:a] = self.prev[:a]
        self.prev[:a] = slot


class _Encoder:
    def __init__(self, lanes: int, words: int) -> None:
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, ~np.uint64(0))
        self.out = np.zeros((lanes, words), np.uint32)
        self.pos = np.zeros(lanes, np.int64)

    def put(self, at: np.ndarray | slice, start: np.ndarray, width: np.ndarray, bits: int) -> None:
        step = self.range[at] >> np.uint64(bits)
        low = self.low[at] + start.astype(np.uint64) * step
        size = width.astype(np.uint64) * step
        self.low[at], self.range[at] = low, size
        todo = np.flatnonzero(((low ^ (low + size)) < _TOP) | (size < _BOT))
        if todo.size:
            self.shift(todo if isinstance(at, slice) else at[todo])

    def shift(self, at: np.ndarray) -> None:
        while at.size:
            low, size = self.low[at], self.range[at]
            settled = (low ^ (low + size)) < _TOP
            size = np.where(settled, size, (~low + np.uint64(1)) & (_BOT - np.uint64(1)))
            self.emit(at, low)
            low, size = low << _U32, size << _U32
            self.low[at], self.range[at] = low, size
            at = at[((low ^ (low + size)) < _TOP) | (size < _BOT)]

    def emit(self, at: np.ndarray, low: np.ndarray) -> None:
        if int(self.pos[at].max()) >= self.out.shape[1]:
            self.out = np.concatenate([self.out, np.zeros_like(self.out)], axis=1)
        self.out[at, self.pos[at]] = (low >> _U32).astype(np.uint32)
        self.pos[at] += 1

    def finish(self) -> list[bytes]:
        every = np.arange(self.low.size)
        for _ in range(2):
            self.emit(every, self.low)
            self.low = self.low << _U32
        return [self.out[i, :n].astype("<u4").tobytes() for i, n in enumerate(self.pos.tolist())]


class _Decoder:
    def __init__(self, payloads: list[bytes]) -> None:
        sizes = np.array([len(p) // 4 for p in payloads])
        self.words = np.frombuffer(b"".join(payloads) + bytes(16), "<u4").astype(np.uint64)
        self.at = np.cumsum(sizes) - sizes
        self.low = np.zeros(sizes.size, np.uint64)
        self.range = np.full(sizes.size, ~np.uint64(0))
        self.code = np.zeros(sizes.size, np.uint64)
        for _ in range(2):
            self.code = (self.code << _U32) | self.words[np.minimum(self.at, self.words.size - 1)]
            self.at = self.at + 1

    def target(self, at: np.ndarray | slice, bits: int) -> np.ndarray:
        step = self.range[at] >> np.uint64(bits)
        v = (self.code[at] - self.low[at]) // step
        return np.minimum(v, np.uint64((1 << bits) - 1)).astype(np.int64)

    def take(self, at: np.ndarray | slice, start: np.ndarray, width: np.ndarray, bits: int) -> None:
        step = self.range[at] >> np.uint64(bits)
        low = self.low[at] + start.astype(np.uint64) * step
        size = width.astype(np.uint64) * step
        self.low[at], self.range[at] = low, size
        todo = np.flatnonzero(((low ^ (low + size)) < _TOP) | (size < _BOT))
        at = todo if isinstance(at, slice) else at[todo]
        while at.size:
            low, size = self.low[at], self.range[at]
            settled = (low ^ (low + size)) < _TOP
            size = np.where(settled, size, (~low + np.uint64(1)) & (_BOT - np.uint64(1)))
            low, size = low << _U32, size << _U32
            self.low[at], self.range[at] = low, size
            self.code[at] = (self.code[at] << _U32) | self.words[np.minimum(self.at[at], self.words.size - 1)]
            self.at[at] += 1
            at = at[((low ^ (low + size)) < _TOP) | (size < _BOT)]


def _slots(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot of each id (first come, first numbered, from 1) and whether it is new; ``first`` is scratch of 65536."""
    here = np.arange(ids.size)
    first[ids[::-1]] = here[::-1]
    new = first[ids] == here
    number = np.cumsum(new)
    return number[first[ids]], new


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """One payload per block of ids below 65536."""
    if not blocks:
        return []
    lengths = np.array([b.size for b in blocks])
    if lengths.max() > BLOCK or min(int(b.min(initial=0)) for b in blocks) < 0 or max(int(b.max(initial=0)) for b in blocks) > 65535:
        raise ValueError("blocks hold at most BLOCK ids of 0 to 65535")
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    longest = int(lengths[0])
    slots, raw = np.zeros((longest, order.size), np.uint16), np.zeros((longest, order.size), np.uint16)
    fresh = np.zeros((longest, order.size), bool)
    first = np.zeros(65536, np.int64)
    for i, j in enumerate(order.tolist()):
        ids = blocks[j].astype(np.int64)
        if ids.size:
            slots[: ids.size, i], fresh[: ids.size, i] = _slots(ids, first)
            raw[: ids.size, i] = ids
    if int(slots.max(initial=0)) >= SLOTS:
        raise ValueError(f"a block holds at most {SLOTS - 1} distinct ids")
    model, coder = _Model(order.size), _Encoder(order.size, longest // 2 + 64)
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    for t in range(longest):
        a = int(active[t])
        lanes = slice(0, a)
        slot = slots[t, :a].astype(np.int64)
        model.predict(a)
        unknown = slot > model.ready[:a]
        # A slot that the sums do not know can still be the order-1 or order-2 prediction, but is announced all the same.
        coder.put(lanes, *model.interval(a, np.where(unknown, 0, slot)), _ALL)
        who = np.flatnonzero(unknown)
        if who.size:
            coder.put(who, raw[t, who].astype(np.int64), np.ones(who.size, np.int64), _RAW)
            model.announce(who, fresh[t, who])
        model.learn(a, slot)
        if _renews(t):
            model.renew(a)
    payloads = coder.finish()
    out: list[bytes] = [b""] * order.size
    for i, j in enumerate(order.tolist()):
        out[j] = payloads[i]
    return out


def decode(payloads: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The ids of each payload, as unsigned 32-bit integers."""
    if not payloads:
        return []
    sizes = np.array(lengths)
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    longest, lanes = int(sizes[0]), order.size
    model, coder = _Model(lanes), _Decoder([payloads[j] for j in order.tolist()])
    ids = np.zeros((longest, lanes), np.uint16)
    names = np.zeros((lanes, SLOTS), np.uint16)
    active = np.searchsorted(-sizes, -np.arange(longest), "left")
    for t in range(longest):
        a = int(active[t])
        every = slice(0, a)
        model.predict(a)
        slot = model.find(a, coder.target(every, _ALL))
        coder.take(every, *model.interval(a, slot), _ALL)
        who = np.flatnonzero(slot == 0)
        if who.size:
            raw = coder.target(who, _RAW)
            coder.take(who, raw, np.ones(who.size, np.int64), _RAW)
            # The id may have come since the last renewal: look among the slots that the sums do not know yet.
            first, last = model.ready[who], model.known[who]
            waiting = first[:, None] + 1 + np.arange(int((last - first).max()))
            same = (names[who[:, None], np.minimum(waiting, SLOTS - 1)] == raw[:, None]) & (waiting <= last[:, None])
            seen = same.any(axis=1)
            at = np.where(seen, first + 1 + (same.argmax(axis=1) if same.shape[1] else 0), last + 1)
            if int(at.max()) >= SLOTS:
                raise ValueError("damaged block")
            names[who, at] = raw
            model.announce(who, ~seen)
            slot[who] = at
        ids[t, :a] = names[model.lane[:a], slot]
        model.learn(a, slot)
        if _renews(t):
            model.renew(a)
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * lanes
    for i, j in enumerate(order.tolist()):
        out[j] = np.ascontiguousarray(ids[: sizes[i], i]).astype(np.uint32)
    return out
