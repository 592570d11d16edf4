"""Byte-pair encoding as a deterministic transducer that counts tokens.

Read left to right, the encoding of a prefix of a word ends in exactly one
token, and that token is the only one ending there that can stand after the
token before it. So a state needs, for every earlier place from which a token
may still be under way, the bytes since then, the token that ended there and
how many tokens fewer there were. Reading a byte ends one token; the transition
is annotated with the change of the token count (which may be zero or negative,
when a longer token takes over). States are compiled when first reached."""

from __future__ import annotations

import json

import numpy as np

MAX_STATES = 400_000   # compiled states; beyond that the tables are dropped and compiled anew


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: visible
    Latin-1 characters for themselves, the other bytes in order from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Lazily compiled transition table: an open-addressing hash table from
    (state, byte) to (next state, change of the count), looked up by arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_letters()
        added = {t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(letter[c] for c in t) for t, i in spec["model"]["vocab"].items() if i not in added}
        self.token = {b: i for i, b in self.bytes_of.items()}
        self.merge = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            x, y = (spec["model"]["vocab"][k] for k in (a, b))
            self.merge[x, y] = (rank, spec["model"]["vocab"][a + b])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.prefix = {b[:k] for b in self.token for k in range(1, len(b))}
        self.follows: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.root = self._state(((b"", -1, 0),))
        self.bits, self.used = 16, 0
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.to = np.zeros(1 << self.bits, np.int64)  # next state * 256 + count change + 128

    def _state(self, entries: tuple) -> int:
        n = self.number.setdefault(entries, len(self.states))
        if n == len(self.states):
            self.states.append(entries)
        return n

    def encode(self, raw: bytes) -> list[int]:
        """Plain byte-pair encoding of a short word."""
        ids = [self.token[raw[i:i + 1]] for i in range(len(raw))]
        while len(ids) > 1:
            found = [(self.merge[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merge]
            if not found:
                break
            _, i = min(found)
            ids[i: i + 2] = [self.merge[ids[i], ids[i + 1]][1]]
        return ids

    def _can_follow(self, a: int, b: int) -> bool:
        if b not in self.whole:
            self.whole[b] = self.encode(self.bytes_of[b]) == [b]
        if not self.whole[b]:
            return False
        if a < 0:
            return True
        if (a, b) not in self.follows:
            if len(self.follows) > 1_000_000:
                self.follows.clear()
            self.follows[a, b] = self.encode(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return self.follows[a, b]

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """Compile one transition: (next state, change of the token count)."""
        b, last, change, under_way = bytes([byte]), None, 0, []
        for since, token, fewer in self.states[state]:
            since = since + b
            t = self.token.get(since)
            if t is not None and last is None and self._can_follow(token, t):
                last, change = t, fewer + 1
            if since in self.prefix:
                under_way.append((since, token, fewer))
        if last is None:
            raise AssertionError("no token ends here")
        return self._state((*((s, t, f - change) for s, t, f in under_way), (b"", last, 0))), change

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        if 2 * (self.used + len(keys)) > len(self.key):
            old = self.key >= 0
            k, v = np.concatenate([self.key[old], keys]), np.concatenate([self.to[old], values])
            while 2 * len(k) > (1 << self.bits):
                self.bits += 1
            self.key, self.to, self.used = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64), 0
            keys, values = k, v
        slot, mask, todo = self._slots(keys), len(self.key) - 1, np.arange(len(keys))
        self.used += len(keys)
        while len(todo):
            free = todo[self.key[slot[todo]] < 0]
            self.key[slot[free]] = keys[free]  # of several for one slot the last stays
            done = self.key[slot[todo]] == keys[todo]
            self.to[slot[todo[done]]] = values[todo[done]]
            todo = todo[~done]
            slot[todo] = (slot[todo] + 1) & mask

    def look_up(self, states: np.ndarray, read: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and count changes for arrays of states and bytes."""
        keys = states * 256 + read
        slot = self._slots(keys)
        got = self.key[slot]
        value = self.to[slot]
        todo = np.flatnonzero(got != keys)
        mask = len(self.key) - 1
        missing = []
        while len(todo):
            missing.append(todo[got[todo] < 0])
            todo = todo[got[todo] >= 0]
            slot[todo] = (slot[todo] + 1) & mask
            got[todo] = self.key[slot[todo]]
            hit = got[todo] == keys[todo]
            value[todo[hit]] = self.to[slot[todo[hit]]]
            todo = todo[~hit]
        todo = np.concatenate(missing) if missing else todo
        if len(todo):
            new, back = np.unique(keys[todo], return_inverse=True)
            made = [self.step(int(k) >> 8, int(k) & 255) for k in new]
            packed = np.array([(s << 8) + c + 128 for s, c in made], np.int64)
            self._insert(new, packed)
            value[todo] = packed[back]
        return value >> 8, (value & 255) - 128
