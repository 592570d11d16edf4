"""Token counts by finite-state tokenization.

Word boundaries of the byte-level pre-tokenizer follow from the classes of
neighbouring characters, so they are found for a whole batch at once. Between
boundaries the byte-pair encoding runs as a transducer (:mod:`bpe_transducer`)
whose transitions carry changes of the token count. The bytes of a batch are
cut into chunks that are read side by side: a chunk with a boundary maps every
entry state to one exit state, a chunk without one (inside a very long word)
maps its entry state by reading on; composing the maps from left to right gives
every chunk its entry state, and then the bytes before its first boundary are
read. A document's count is the sum of the changes over its bytes."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.bpe_transducer import MAX_STATES, Transducer
from wardflow.llm.common import slices, table

CHUNK = 512
_OTHER, _LETTER, _NUMBER, _BLANK = range(4)
# White space as in the pre-tokenizer's \s.
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _classes() -> np.ndarray:
    kind = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))[0]
        if k in "LN":
            kind[c] = _LETTER if k == "L" else _NUMBER
    kind[_WHITE] = _BLANK
    return kind


def word_starts(cp: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pre-tokenizer starts a word. ``cp``: characters of all
    segments, ``first``: true at the first character of a segment. The pattern:
    's 't 're 've 'm 'll 'd | blank? letters | blank? digits | blank? others |
    white space but its last character before a word | white space."""
    n = len(cp)
    prev = np.concatenate([[255], kind[:-1]])
    prev[first] = 255
    prev_cp = np.concatenate([[0], cp[:-1]])
    ends = np.concatenate([first[1:], [True]])          # last character of a segment
    after = np.concatenate([kind[1:], [255]])
    white = kind == _BLANK
    start = first | (kind != prev)
    start[white & (prev == _BLANK)] = False
    start[white & (prev == _BLANK) & ~ends & (after != _BLANK)] = True
    start[~white & (prev == _BLANK) & (prev_cp == 32)] = False
    # Contractions: an apostrophe that starts a word, with its letters.
    at = np.flatnonzero((cp == 39) & start)
    if len(at):
        room = np.minimum(np.searchsorted(np.flatnonzero(ends), at), ends.sum() - 1)
        last = np.flatnonzero(ends)[room]
        a = np.where(at + 1 <= last, cp[np.minimum(at + 1, n - 1)], 0)
        b = np.where(at + 2 <= last, cp[np.minimum(at + 2, n - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        length = np.where(one, 1, np.where(two, 2, 0))
        hit = length > 0
        start[at[hit] + 1] = False
        end = at[hit] + 1 + length[hit]
        start[end[(end < n)]] = True
    return start


class Counter:
    def __init__(self, path: str):
        self.transducer = Transducer(path)
        self.special = re.compile("|".join(map(re.escape, self.transducer.special))) if self.transducer.special else None
        self.kind = _classes()

    def _read(self, columns, changes, lanes, state, begin, end, starts):
        """Read bytes begin[i] .. end[i] of the given lanes, from ``state``."""
        t, root = self.transducer, self.transducer.root
        for k in range(int(begin.min()), int(end.max())):
            go = (begin <= k) & (k < end)
            if not go.any():
                continue
            who = lanes[go]
            state[go] = np.where(starts[k, who], root, state[go])
            state[go], c = t.look_up(state[go], columns[k, who])
            changes[k, who] = c
        return state

    def count(self, texts: list) -> list[int]:
        """Tokens of each text (null as empty)."""
        if len(self.transducer.states) > MAX_STATES:
            self.transducer.clear()
        counts = [0] * len(texts)
        segments, owner = [], []
        for i, t in enumerate(texts):
            parts = self.special.split(t) if t and self.special else [t or ""]
            counts[i] += len(parts) - 1  # a special string is one token
            for p in parts:
                if p:
                    segments.append(p)
                    owner.append(i)
        if not segments:
            return counts
        joined = "".join(segments)
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        first = np.zeros(len(cp), bool)
        at = np.cumsum([0] + [len(s) for s in segments])
        first[at[:-1]] = True
        width = 1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000)
        place = np.concatenate([[0], np.cumsum(width)])
        raw = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        lanes = -(-len(raw) // CHUNK)
        starts = np.zeros(lanes * CHUNK, bool)
        starts[place[:-1][word_starts(cp, self.kind[cp], first)]] = True
        size = np.minimum(CHUNK, len(raw) - np.arange(lanes) * CHUNK)
        data = np.zeros(lanes * CHUNK, np.int64)
        data[: len(raw)] = raw
        columns = np.ascontiguousarray(data.reshape(lanes, CHUNK).T)
        starts = np.ascontiguousarray(starts.reshape(lanes, CHUNK).T)
        changes = np.zeros((CHUNK, lanes), np.int16)
        known = starts.any(0)                       # chunks whose map is constant
        head = np.where(known, starts.argmax(0), size)
        leave = np.full(lanes, self.transducer.root)
        k = np.flatnonzero(known)
        leave[k] = self._read(columns, changes, k, leave[k], head[k], size[k], starts)
        # Compose from left to right: a chunk without a boundary passes its
        # entry state on by reading; the j-th of a row of them goes in turn j.
        lane = np.arange(lanes)
        turn = lane - np.maximum.accumulate(np.where(known, lane, 0))
        for j in range(1, int(turn.max()) + 1):
            k = np.flatnonzero(turn == j)
            leave[k] = self._read(columns, changes, k, leave[k - 1], np.zeros(len(k), np.int64), size[k], starts)
        k = np.flatnonzero(known & (head > 0))
        if len(k):
            self._read(columns, changes, k, leave[k - 1], np.zeros(len(k), np.int64), head[k], starts)
        total = np.concatenate([[0], np.cumsum(changes.T.ravel()[: len(raw)].astype(np.int64))])
        edge = place[at]
        for i, n in zip(owner, (total[edge[1:]] - total[edge[:-1]]).tolist()):
            counts[i] += n
        return counts


_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    Null and empty text has no bytes and no tokens; null ids and repeated rows
    are counted like any other; an empty table gives none. A whole text is read
    in one task, in batches of at most two million characters or one text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches):
        if tokenizer not in _COUNTERS:
            _COUNTERS[tokenizer] = Counter(tokenizer)
        counter = _COUNTERS[tokenizer]
        for batch in batches:
            for i, j, texts in slices(batch.column(1)):
                n = counter.count(texts)
                yield pa.record_batch([batch.column(0).slice(i, j - i).cast(pa.int64()),
                                       pa.array([len((t or "").encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                                       pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every document under the 50k byte-level vocabulary."""
    import public_tokenizers
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
