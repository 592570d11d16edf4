"""Arithmetic coding of token ids with mixed order-0 to order-2 predictions.

Ids are cut into blocks; every block starts from an empty model and carries a
crc32 of its ids, so it can be decoded alone. Inside a block two tables predict
the next id, one from the last id (order 1) and one from the last two (order
2); order 0 gives every id a share by how often the block had it. The shares of
the three orders are weights that adapt by how sure the two predictions are;
the mixture drives a range coder. Many blocks are coded side by side as numpy
lanes, one id of each per step."""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 4096          # ids in a block
GAIN = 48             # order-0 weight of one occurrence, against 1 for every possible id
H1, H2 = 10, 12       # bits of the order-1 and order-2 tables
LIMIT = 4000          # total of a mixing context above which its weights are halved
RESCALE = 64          # steps between two looks at the totals
MAX_ALPHABET = 500_000  # keeps both intervals of a step inside one renormalisation
_TOP, _BOT = np.uint64(1 << 48), np.uint64((1 << 32) - 1)
_S16, _S48 = np.uint64(16), np.uint64(48)
_FIELD = np.int64(0xFFFF)
# A mixing context holds its weights as running sums in 16-bit fields: 0, order 2, order 2 + 1, all.
_START = np.int64((2 << 16) | (4 << 32) | (8 << 48))
_GROW = np.array([12 << 16 | 12 << 32 | 12 << 48, 12 << 32 | 12 << 48, 12 << 48], np.int64)
# Change of a table entry (id << 2 | confidence) by confidence + 4 * hit; 0 means that the id is replaced.
_CHANGE = np.array([0, -1, -1, -1, 1, 1, 1, 0], np.int32)


def _refresh_points(n: int) -> list[int]:
    """Steps at which order-0 counts are taken over (doubling); the first is 0."""
    out, t = [0], 16
    while t < n:
        out.append(t)
        t = t * 2
    return out


class _Mixer:
    """Order-1 and order-2 tables and the mixing weights of all lanes; encoder
    and decoder drive it alike."""

    def __init__(self, lanes: int):
        lane = np.arange(lanes)
        self.base = np.stack([(lanes << H1) + (lane << H2), lane << H1])  # order 2, order 1
        self.mask = np.array([[(1 << H2) - 1], [(1 << H1) - 1]])
        self.table = np.zeros((lanes << H1) + (lanes << H2), np.int32)
        self.sums = np.full(lanes * 32, _START, np.int64)
        self.context = lane * 32
        self.hash = np.zeros((2, lanes), np.int64)
        self.last = np.zeros(lanes, np.int64)
        self.step = 0

    def predict(self) -> None:
        self.at = ((self.hash >> 4) & self.mask) + self.base
        self.entry = self.table.take(self.at)
        self.guess, self.sure = self.entry >> 2, self.entry & 3
        self.w = self.context + ((self.guess[0] == self.guess[1]) * np.int64(16) + (self.sure[0] << 2) + self.sure[1])
        self.p = self.sums.take(self.w)
        self.total = (self.p >> 48).astype(np.uint64)

    def interval(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of the share of ``order`` (0: order 2, 1: order 1, 2: order 0)."""
        p = self.p >> (order << 4)
        start = p & _FIELD
        return start.astype(np.uint64), (((p >> 16) & _FIELD) - start).astype(np.uint64)

    def learn(self, x: np.ndarray, order: np.ndarray) -> None:
        self.sums[self.w] = self.p + _GROW.take(order)
        state = self.sure + ((self.guess == x) << 2)
        entry = self.entry + _CHANGE.take(state)
        np.copyto(entry, (x << 2).astype(np.int32), where=state == 0)
        self.table[self.at] = entry
        self.hash[1] = x * 40503
        self.hash[0] = self.last * (31337 * 40503) + self.hash[1]
        self.last = x
        self.step += 1
        if self.step % RESCALE == 0:
            self.halve()

    def halve(self) -> None:
        big = np.flatnonzero((self.sums >> 48) > LIMIT)
        s = [(self.sums[big] >> k) & _FIELD for k in (0, 16, 32, 48)]
        a, b, c = [((y - x) >> 1) + 1 for x, y in zip(s, s[1:])]
        self.sums[big] = (a << 16) | ((a + b) << 32) | ((a + b + c) << 48)


def _ranks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every id its order-0 interval, as start and width: the counts are
    those of the lane's ids before the last refresh point. Steps x lanes."""
    lanes, n = x.shape
    start, width = np.empty((n, lanes), np.uint32), np.ones((n, lanes), np.uint32)
    points = _refresh_points(n)
    for t, end in zip(points, [*points[1:], n]):
        for i in range(lanes):
            s, q = np.sort(x[i, :t]), x[i, t:end]
            lo = np.searchsorted(s, q)
            start[t:end, i] = q + GAIN * lo  # lo is 64 bits wide
            if t:
                new = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
                run = np.zeros(t, np.int64)
                run[new] = np.diff(np.r_[new, t])
                lo = np.minimum(lo, t - 1)
                width[t:end, i] = 1 + GAIN * run[lo] * (s[lo] == q)
    return start, width


class _Order0:
    """Order-0 counts for the decoder, taken over at refresh points."""

    def __init__(self, ids: np.ndarray, alphabet: int):
        lanes, self.seen = ids.shape
        if not self.seen:
            return
        s = np.sort(ids, axis=1).astype(np.int64)
        j = np.arange(self.seen)
        total = alphabet + GAIN * self.seen
        kind = np.int32 if lanes * (total + 1) < 1 << 31 else np.int64
        # The j-th smallest occurrence lies at s + GAIN * j on the scale of order 0.
        self.grid = (s + GAIN * j + np.arange(lanes)[:, None] * (total + 1)).astype(kind).ravel()
        self.lane_at, self.kind = np.arange(lanes) * (total + 1), kind
        first = np.where(np.c_[np.ones(lanes, bool), s[:, 1:] != s[:, :-1]], j, 0)
        last = np.where(np.c_[s[:, 1:] != s[:, :-1], np.ones(lanes, bool)], j + 1, self.seen)
        self.first = np.maximum.accumulate(first, axis=1).ravel()
        self.last = np.minimum.accumulate(last[:, ::-1], axis=1)[:, ::-1].ravel()
        self.ids = s.ravel()

    def find(self, lane: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Id, start and width of the interval that holds v."""
        if not self.seen:
            return v, v, np.ones_like(v)
        i = np.searchsorted(self.grid, (v + self.lane_at[lane]).astype(self.kind), "right")
        n = i - lane * self.seen
        at = np.maximum(i - 1, lane * self.seen)
        x = self.ids[at]
        known = (n > 0) & (v <= x + GAIN * n)
        lo = self.first[at]
        return (np.where(known, x, v - GAIN * n), np.where(known, x + GAIN * lo, v),
                np.where(known, GAIN * (self.last[at] - lo) + 1, 1))


def _settle(low: np.ndarray, rng: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Lanes (of ``at``, else all) whose first word is settled or whose range is
    too small; the latter's range ends at the next multiple of 2^32."""
    l, q = (low, rng) if at is None else (low[at], rng[at])
    settled = (l ^ (l + q)) < _TOP
    go = np.flatnonzero(settled | (q <= _BOT))
    cut = np.where(settled[go], q[go], (~l[go] + np.uint64(1)) & _BOT)
    return (go if at is None else at[go]), cut


def _lengths(n: int) -> np.ndarray:
    return np.minimum(BLOCK, n - np.arange(0, n, BLOCK)) if n else np.zeros(0, np.int64)


def encode(ids: np.ndarray, alphabet: int) -> tuple[list[bytes], list[int]]:
    """Payload and crc32 of each block of BLOCK ids. A last block that is
    shorter than others before it is coded with zeros behind its ids."""
    if alphabet > MAX_ALPHABET:
        raise ValueError(f"more than {MAX_ALPHABET} ids")
    n = len(ids)
    if not n:
        return [], []
    size = _lengths(n)
    lanes, steps = len(size), int(size.max())
    x_all = np.zeros(lanes * steps, np.int32)
    x_all[:n] = ids
    x_all = x_all.reshape(lanes, steps)
    start0, width0 = _ranks(x_all)
    columns = np.ascontiguousarray(x_all.T)
    del x_all
    m = _Mixer(lanes)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    kind = np.uint16 if lanes < 1 << 16 else np.int64
    out_lane, out_word = [], []
    refresh = set(_refresh_points(steps))
    for t in range(steps):
        if t in refresh:
            total0 = np.uint64(alphabet + GAIN * t)
        x = columns[t].astype(np.int64)
        m.predict()
        other = x != m.guess[0]
        order = other.astype(np.int64) + (other & (x != m.guess[1]))
        start, width = m.interval(order)
        r = rng // m.total
        low, rng = low + start * r, width * r
        miss = np.flatnonzero(order == 2)
        if len(miss):
            r = rng[miss] // total0
            low[miss] += start0[t, miss] * r
            rng[miss] = width0[t, miss] * r
        go, q = _settle(low, rng)
        while len(go):
            l = low[go]
            out_lane.append(go.astype(kind))
            out_word.append((l >> _S48).astype(np.uint16))
            low[go], rng[go] = l << _S16, q << _S16
            go, q = _settle(low, rng, go)
        m.learn(x, order)
    for _ in range(4):  # flush
        out_lane.append(np.arange(lanes).astype(kind))
        out_word.append((low >> _S48).astype(np.uint16))
        low = low << _S16
    lane, word = np.concatenate(out_lane), np.concatenate(out_word)
    word = word[np.argsort(lane, kind="stable")]
    ends = np.cumsum(np.r_[0, np.bincount(lane, minlength=lanes)])
    payload = [word[a:b].astype("<u2").tobytes() for a, b in zip(ends[:-1], ends[1:])]
    raw = ids.astype("<u4")
    return payload, [zlib.crc32(raw[i * BLOCK: i * BLOCK + size[i]].tobytes()) for i in range(lanes)]


def decode(payload: list[bytes], crcs: list[int], n: int, alphabet: int) -> np.ndarray:
    """The n ids of consecutive blocks; raises if a block's checksum differs."""
    if not n:
        return np.zeros(0, np.uint32)
    size = _lengths(n)
    lanes, steps = len(size), int(size.max())
    at = np.cumsum([0] + [len(p) // 2 for p in payload[:-1]])
    words = np.concatenate([np.frombuffer(b"".join(payload), "<u2").astype(np.uint64), np.zeros(8, np.uint64)])
    last = len(words) - 1
    m = _Mixer(lanes)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    code = np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = (code << _S16) | words[at]
        at = at + 1
    columns = np.zeros((steps, lanes), np.int32)
    refresh = set(_refresh_points(steps))
    for t in range(steps):
        if t in refresh:
            counts, total0 = _Order0(columns[:t].T, alphabet), np.uint64(alphabet + GAIN * t)
        m.predict()
        r = rng // m.total
        v = np.minimum((code - low) // r, m.total - np.uint64(1)).astype(np.int64)
        order = (v >= ((m.p >> 16) & _FIELD)).astype(np.int64) + (v >= ((m.p >> 32) & _FIELD))
        start, width = m.interval(order)
        low, rng = low + start * r, width * r
        x = np.where(order == 0, m.guess[0], m.guess[1]).astype(np.int64)
        miss = np.flatnonzero(order == 2)
        if len(miss):
            r = rng[miss] // total0
            v = np.minimum((code[miss] - low[miss]) // r, total0 - np.uint64(1)).astype(np.int64)
            x[miss], start, width = counts.find(miss, v)
            low[miss] += start.astype(np.uint64) * r
            rng[miss] = width.astype(np.uint64) * r
        go, q = _settle(low, rng)
        while len(go):
            low[go], rng[go] = low[go] << _S16, q << _S16
            code[go] = (code[go] << _S16) | words[np.minimum(at[go], last)]
            at[go] += 1
            go, q = _settle(low, rng, go)
        columns[t] = x
        m.learn(x, order)
    ids = np.ascontiguousarray(columns.T).astype("<u4").ravel()[:n]
    for i, crc in enumerate(crcs):
        if zlib.crc32(ids[i * BLOCK: i * BLOCK + size[i]].tobytes()) != crc:
            raise ValueError(f"block {i}: checksum differs")
    return ids
