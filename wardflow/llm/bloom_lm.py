"""Language-model scores from a log-frequency Bloom filter.

Counts of word pairs are quantised on a log scale; a pair of level q is put
into a Bloom filter as (pair, 1) .. (pair, q), so repeated membership probes
find its level. The filter and the exact word counts are built in blocks by
hash (one task each). A model of at most ``SHARD_BYTES`` is broadcast, and the
texts are read once. A larger one stays where it is: the texts are dealt into
chunks, each chunk sends its distinct words and pairs to their blocks, and the
answers (a count, a mass or a level each) come back to the chunk, so the work
grows with the texts, whatever the model's size. A pair lies in the block of its
second word; pairs of frequent second words are spread over all blocks by their
own hash, and the counts of these words (at most ``HOT``) go along.

The probability of a word after another mixes the pair's dequantised count with
the smoothed word probability (Dirichlet smoothing). It is divided by the mass of
the word before: the sum of what the probes give for all pairs that begin with
it, plus what false positives are expected to give for all other words, so that
the probabilities after a word are expected to add up to 1 over the known words
and one unknown. The probes of level 1 grow with the logarithm of the training
text, and with it of its words, so false positives stay a few counts a word."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import encoded, fold, forget_files, mix64, slices, table, trimmed, word_hashes
from wardflow.session import materialize, shuffles_dropped

PROBES = 6             # probes of every level above 1
HOT = 2000             # a word of at least 1 / HOT of the sampled tokens is frequent, so there are at most HOT
SAMPLE_BYTES = 4 << 20     # text sampled for frequent words, which only places pairs and changes no result
BLOCK_BYTES = 6 << 20      # training text per block of n-grams
SHARD_BYTES = 32 << 20     # largest model that is broadcast
TEXT_BYTES = 4 << 20       # text of a chunk that asks a larger model at once (one text at least)
ROUNDS = 2                 # parts of a larger model that are asked one after another, which halves the hashes on the disk
FLUSH = 1_000_000          # n-grams gathered in a task before they are sorted and sent
MU = 40.0                  # weight of the word probability
ADD = 0.1
END = np.uint64(0x51ED270B0A1F39C1)   # the end token
_PAIR = np.uint64(0xA24BAED4963EE407)
_MIDDLE = np.array([0, 1, 2] + [3 * 2.0 ** (q - 3) + 0.5 for q in range(3, 64)])
DROPPED = 3            # probes after each of which absent pairs are dropped


def token_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens (words, then the end) of all texts, and bounds."""
    h, at = word_hashes(encoded(texts))
    n = np.diff(at) + 1
    bounds = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(int(bounds[-1]), np.uint64)
    last = np.zeros(len(out), bool)
    last[bounds[1:] - 1] = True
    out[last], out[~last] = END, h
    return out, bounds


def before(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The token before every place; before the first token stands the end token."""
    out = np.concatenate([[END], tokens[:-1]]).astype(np.uint64)
    out[bounds[:-1]] = END
    return out


def pair_hashes(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hash of (token before, token) at every place."""
    return mix64(before(tokens, bounds) * _PAIR + tokens)


def levels(count: np.ndarray) -> np.ndarray:
    """Log-scale level of a count: 1, 2, 3-4, 5-8, ... are 1, 2, 3, 4, ..."""
    return 1 + np.ceil(np.log2(count)).astype(np.int64)


def dequantised(level: np.ndarray) -> np.ndarray:
    """Middle count of a level (0 for none)."""
    return _MIDDLE[level]


def _probes(h: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and step of the probes of (pair, level)."""
    x = mix64(h + np.uint64((level + 1) * 0x9FB21C651E98DF25 % (1 << 64)))
    return x, (x << np.uint64(29)) ^ (x * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)


def _place(x: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """A place below ``bits`` (under 2 ** 32) from the upper half of x."""
    p = x >> np.uint64(32)
    p *= bits
    p >>= np.uint64(32)
    return p.view(np.int64)


def first_probes(size: int) -> int:
    """Probes of level 1 for ``size`` bytes of training text: nearly all of its words
    never follow a given one, so the more there are, the fewer may pass by chance."""
    return max(16, int(size // 256).bit_length())


def _order(h: np.ndarray) -> np.ndarray:
    """Places of hashes in order, equal ones by place. Numbers sort far faster than places,
    so a place is put into the lowest bits; if these were needed, places are sorted."""
    low = np.uint64((1 << max(1, len(h).bit_length())) - 1)
    by = (np.sort((h & ~low) | np.arange(len(h), dtype=np.uint64)) & low).view(np.int64)
    in_order = h[by]
    return by if (in_order[1:] >= in_order[:-1]).all() else np.argsort(h, kind="stable")


def _runs(h: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of a sorted array begin."""
    return np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)


def _cut(blocks: int, at: np.ndarray, *columns: np.ndarray):
    """(block, its part of every column) of all blocks met; ``at``: blocks by place."""
    by, ends = _by_block(at, blocks)
    for k in np.flatnonzero(ends[1:] > ends[:-1]):
        here = by[ends[k]: ends[k + 1]]
        yield int(k), *[c[here] for c in columns]


def _block(h: np.ndarray, blocks: int) -> np.ndarray:
    return (h % np.uint64(blocks)).astype(np.int32)


def _among(h: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Place in the sorted ``hot`` by hash, -1 if it is not there."""
    if not len(hot):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
    return np.where(hot[at] == h, at, -1)


def pair_blocks(pairs: np.ndarray, words: np.ndarray, hot: np.ndarray, blocks: int) -> np.ndarray:
    """Block of a pair: of its second word, or of the pair where that is frequent."""
    return np.where(_among(words, hot) >= 0, _block(pairs, blocks), _block(words, blocks))


def _gather(blocks: int, hot: np.ndarray):
    """Distinct n-grams of each task with counts, cut by block; pairs (ord 2) with
    the hash of their first word."""
    def run(batches):
        held = {1: [], 2: [], 0: []}

        def send(order):
            h = np.concatenate(held[order])
            by = _order(h)
            at = _runs(h[by])
            n, by = np.diff(at, append=len(h)).astype(np.uint32), by[at]
            u = h[by]
            first, place = u, None
            if order == 2:
                first, place = np.concatenate(held[0])[by], pair_blocks(u, np.concatenate(held[1])[by], hot, blocks)
                by = _order(first)  # equal neighbours are packed by the shuffle's compression
                u, n, first, place = u[by], n[by], first[by], place[by]
            for k, u, c, f in _cut(blocks, _block(u, blocks) if place is None else place, u, n, first):
                yield pa.record_batch([pa.array([k], pa.int32()), pa.array([order], pa.int32()), pa.array([u.tobytes()], pa.binary()), pa.array([c.tobytes()], pa.binary()),
                                       pa.array([f.tobytes() if order == 2 else None], pa.binary())], names=["block", "ord", "h", "c", "first"])

        n = 0
        for batch in batches:
            for _, _, texts in slices(batch.column(0)):
                t, bounds = token_hashes(texts)
                held[1].append(t)
                held[2].append(pair_hashes(t, bounds))
                held[0].append(before(t, bounds))
                n += len(t)
                if n > FLUSH:
                    yield from send(1)
                    yield from send(2)
                    held, n = {1: [], 2: [], 0: []}, 0
        if n:
            yield from send(1)
            yield from send(2)
    return run


def _column(pdf: pd.DataFrame, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(pdf[name]), kind)


def _summed(h: np.ndarray, *values: np.ndarray) -> tuple:
    """Distinct hashes in order, the place of one of each, and sums."""
    by = _order(h)
    at = _runs(h[by])
    return h[by][at], by[at], *[np.add.reduceat(v[by], at) if len(at) else v for v in values]


def _parts(blocks: int, probes: int):
    """One block of n-grams: its filter (kind 0), its words with counts (kind 1),
    and for the words its pairs begin with, by these words' blocks, the sum of the
    pairs' counts as probes give them and the number of pairs (kind 2)."""
    def run(key, pdf):
        def rows():
            words, pairs = pdf[pdf["ord"] == 1], pdf[pdf["ord"] == 2]
            h, _, c = _summed(_column(words, "h", np.uint64), _column(words, "c", np.uint32).astype(np.int64))
            yield int(key[0]), 1, h.tobytes(), c.tobytes(), None, int(c.sum()), len(h), 0.0
            h = _column(pairs, "h", np.uint64)
            u, at, c = _summed(h, _column(pairs, "c", np.uint32).astype(np.int64))
            first = _column(pairs, "first", np.uint64)[at]
            bits, chance = filter_bits(u, levels(c), probes)
            yield int(key[0]), 0, None, None, bits.tobytes(), 0, 0, chance
            found = dequantised(Block(b"", b"", b"", bits.tobytes(), probes).level(u))
            u, _, found, n = _summed(first, found, np.ones(len(first), np.uint32))
            for k, f, mass, m in _cut(blocks, _block(u, blocks), u, found, n):
                yield k, 2, f.tobytes(), mass.tobytes(), m.tobytes(), 0, 0, 0.0
        return pd.DataFrame(list(rows()), columns=["block", "kind", "h", "a", "b", "n_tokens", "n_words", "chance"])
    return run


def filter_bits(pairs: np.ndarray, q: np.ndarray, probes: int) -> tuple[np.ndarray, float]:
    """Filter of pairs of levels ``q``, about half full, and the count that an
    absent pair is expected to get from it."""
    bits = max(64, int(1.443 * (probes * len(q) + PROBES * (q.sum() - len(q)))) // 8 * 8 + 8)
    on = np.zeros(bits, bool)
    for level in range(1, int(q.max(initial=0)) + 1):
        x, step = _probes(pairs[q >= level], level)
        for _ in range(probes if level == 1 else PROBES):
            on[_place(x, np.uint64(bits))] = True
            x = x + step
    full = float(on.mean())
    steps = np.diff(dequantised(np.arange(40)))
    return np.packbits(on), float((steps * full ** (probes + PROBES * np.arange(39))).sum())


def _mass(n_words: int, chance: float, hot: np.ndarray):
    """The words of a block with counts, and the mass of every word as the one
    before; the frequent words and their counts once more."""
    def run(key, pdf):
        words, rest = pdf[pdf["kind"] == 1], pdf[pdf["kind"] == 2]
        h, c = _column(words, "h", np.uint64), _column(words, "a", np.int64)
        u, _, mass, n = _summed(_column(rest, "h", np.uint64), _column(rest, "a", np.float64), _column(rest, "b", np.uint32).astype(np.int64))
        total = np.zeros(len(h))
        total[np.searchsorted(h, u)] = mass + chance * (n_words - n)
        return pd.DataFrame({"block": [int(key[0])], "words": [h.tobytes()], "counts": [c.astype(np.uint32 if c.max(initial=0) < 1 << 32 else np.int64).tobytes()],
                             "mass": [total.astype(np.float32).tobytes()],
                             "hot": [h[mine := _among(h, hot) >= 0].tobytes()], "n_hot": [c[mine].tobytes()]})
    return run


class Block:
    """One block of the model: exact word counts, masses and the pairs' filter."""

    def __init__(self, words: bytes, counts: bytes, mass: bytes, bits: bytes, probes: int, absent: float = 0.0):
        self.probes, self.absent = probes, absent  # of level 1; mass of words that were never seen
        self.mass = np.frombuffer(mass, np.float32)
        self.words, self.counts = np.frombuffer(words, np.uint64), np.frombuffer(counts, np.uint32 if len(counts) < len(words) else np.int64)
        self.filter, self.size = np.frombuffer(bits, np.uint8), np.uint64(8 * len(bits))
        # Where the hashes with given leading bits begin (about one each).
        self.shift = np.uint64(64 - max(1, len(self.words).bit_length()))
        self.index = np.searchsorted(self.words, np.arange(1 << int(64 - self.shift), dtype=np.uint64) << self.shift).astype(np.int32)

    def count(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact counts (0 if unseen) and masses of words."""
        out, mass = np.zeros(len(h), np.int64), np.full(len(h), self.absent, np.float32)
        if not len(self.words):
            return out, mass
        at, todo, last = self.index[h >> self.shift].astype(np.int64), np.arange(len(h)), len(self.words) - 1
        while len(todo):
            at = np.minimum(at, last)
            found, want = self.words[at], h[todo]
            hit = found == want
            out[todo[hit]], mass[todo[hit]] = self.counts[at[hit]], self.mass[at[hit]]
            on = (found < want) & (at < last)
            todo, at = todo[on], at[on] + 1
        return out, mass

    def _found(self, x: np.ndarray) -> np.ndarray:
        """Bytes whose highest bit is the filter's at :func:`_place` of ``x``."""
        p = x >> np.uint64(32)
        p *= self.size
        found = self.filter.take((p >> np.uint64(35)).view(np.int64), mode="wrap")  # always inside
        p >>= np.uint64(32)
        found <<= p.astype(np.uint8) & np.uint8(7)
        return found

    def level(self, h: np.ndarray) -> np.ndarray:
        """Levels of pairs: probe (pair, 1), (pair, 2), .. until one is absent."""
        out, todo = np.zeros(len(h), np.uint8), np.arange(len(h))
        level = 1
        while len(todo) and level < 255:
            x, step = _probes(h[todo], level)
            here = np.full(len(x), 255, np.uint8)
            for k in range(self.probes if level == 1 else PROBES):
                here &= self._found(x)
                if k < DROPPED or k % 8 == 0:  # later most that are left are there, and stay in place
                    on = np.flatnonzero(here & 128)
                    if len(on) < len(x):
                        todo, x, step, here = todo[on], x[on], step[on], here[on]
                x += step
            todo = todo[here >= 128]
            out[todo] = level
            level += 1
        return out


def _by_block(b: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Places ordered by their block ``b``, and the bounds of each block."""
    if blocks <= 1 << 16:
        b = b.astype(np.uint16)  # sorted by radix
    return np.argsort(b, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(b, minlength=blocks))])


class Model(NamedTuple):
    """A stored model: its blocks and what is known of all of them."""
    words_of: DataFrame     # block, words, counts, mass
    bits_of: DataFrame      # block, bits; where they were built, as they need not move again
    blocks: int
    tokens: int
    words: int
    probes: int             # of level 1
    absent: float           # mass of a word never seen
    hot: np.ndarray         # frequent words in order
    hot_counts: np.ndarray


def _frequent(train: DataFrame, size: int) -> np.ndarray:
    """Words that are frequent in a sample of about ``SAMPLE_BYTES``, in order."""
    def count(batches):
        for batch in batches:
            for _, _, texts in slices(batch.column(0)):
                u, c = np.unique(token_hashes(texts)[0], return_counts=True)
                yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(c)], names=["w", "c"])

    some = train.select("text").sample(min(1.0, SAMPLE_BYTES / max(1, size)), seed=7)
    words = some.mapInArrow(count, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))
    top = words.orderBy(F.desc("c"), "w").limit(HOT).toPandas()
    tokens = words.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    return np.sort(top["w"][top["c"] * HOT >= tokens].to_numpy(np.int64).view(np.uint64))


def build(train: DataFrame) -> Model:
    """The model of the texts in ``train`` (column text), its blocks stored in the shared folder."""
    size = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, probes, hot = max(1, -(-size // BLOCK_BYTES)), first_probes(size), _frequent(train, size)
    grams = train.select("text").mapInArrow(trimmed(_gather(blocks, hot)), "block int, ord int, h binary, c binary, first binary")
    with shuffles_dropped(train.sparkSession):
        parts = materialize(grams.groupBy("block").applyInPandas(
            _parts(blocks, probes), "block int, kind int, h binary, a binary, b binary, n_tokens long, n_words long, chance double"), "llm-lm-parts")
    total = lambda f, c: F.coalesce(f(c), F.lit(0))
    n, v, chance = parts.agg(total(F.sum, "n_tokens"), total(F.sum, "n_words"), total(F.avg, F.when(F.col("kind") == 0, F.col("chance")))).first()
    with shuffles_dropped(train.sparkSession):
        rows = materialize(parts.where("kind > 0").groupBy("block").applyInPandas(
            _mass(v, chance, hot), "block int, words binary, counts binary, mass binary, hot binary, n_hot binary"), "llm-lm-words")
    found = rows.where(F.octet_length("hot") > 0).select("hot", "n_hot").toPandas()  # at most HOT words
    h, c = _column(found, "hot", np.uint64), _column(found, "n_hot", np.int64)
    by = np.argsort(h)
    return Model(rows, parts.where("kind = 0").select("block", F.col("b").alias("bits")), blocks, n, v, probes, chance * v, h[by], c[by])


def _size(model: Model) -> int:
    """Bytes of the model's arrays."""
    size = lambda *c: sum((F.octet_length(x) for x in c[1:]), F.octet_length(c[0])).alias("n")
    rows = model.words_of.select(size("words", "counts", "mass")).union(model.bits_of.select(size("bits")))
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_blocks(model: Model, numbers: list[int]):
    """(number, :class:`Block`) of the blocks asked for, one at a time but for their words."""
    chosen = F.col("block").isin(numbers)
    words = {r[0]: r[1:] for r in model.words_of.where(chosen).select("block", "words", "counts", "mass").toLocalIterator()}
    for r in model.bits_of.where(chosen).toLocalIterator():
        yield r[0], Block(*map(bytes, (*words.pop(r[0]), r[1])), model.probes, model.absent)


def _summed_up(bounds: np.ndarray, tokens: int, columns: list, names: list[str], base: np.ndarray, score: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
    """Rows of scored texts: their columns, and the sums over their tokens."""
    base, score, known = (np.add.reduceat(x, bounds[:-1]) for x in (base, score, known.astype(np.int64)))
    return pa.record_batch([*columns, pa.array(np.diff(bounds)), pa.array(known), pa.array(np.full(len(known), tokens, np.int64)), pa.array(base), pa.array(score)],
                           names=[*names, *SCORES])


SCORES = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def score_texts(docs: DataFrame, train: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of every row of ``docs`` with ``n_tokens, n_known,
    train_tokens, base_score, score`` (log10 probabilities; base: words alone).

    Null text is empty: its only token is the end. With no training token the
    word probability is 0.1 / 0.1 = 1 for the only type, so scores are 0.
    Repeated rows score alike; an empty table gives none. A very long text is read
    whole, as a run of its own, in one task."""
    columns = [c for c in columns if c not in SCORES]  # replaced
    model = build(train)
    d = docs.select(*columns, F.col("text").alias("__text"))
    ddl = ", ".join([*(f"`{c.name}` {c.dataType.simpleString()}" for c in docs.select(*columns).schema), "n_tokens long, n_known long, train_tokens long, base_score double, score double"])
    return (_by_broadcast if _size(model) <= SHARD_BYTES else _by_shuffle)(d, model, columns, ddl)


def _by_broadcast(d: DataFrame, model: Model, columns: list[str], ddl: str) -> DataFrame:
    """Scores by a model that every worker holds."""
    blocks, n, hot, hot_counts, base_total = model.blocks, model.tokens, model.hot, model.hot_counts, model.tokens + ADD * (model.words + 1)
    nothing = Block(b"", b"", b"", bytes(8), model.probes, model.absent)  # for blocks that no n-gram fell into
    sent: list = [nothing] * blocks
    for number, block in read_blocks(model, list(range(blocks))):
        sent[number] = d.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        for batch in batches:
            for i, j, texts in slices(batch.column("__text")):
                t, bounds = token_hashes(texts)
                p = pair_hashes(t, bounds)
                part = batch.slice(i, j - i)
                frequent = _among(t, hot)
                base, score, known = np.zeros(len(t)), np.zeros(len(t)), np.zeros(len(t), bool)
                home = _block(t, blocks)
                by, ends = _by_block(home, blocks)
                by2, ends2 = _by_block(np.where(frequent >= 0, _block(p, blocks), home), blocks)
                count = np.zeros(len(t), np.int64)
                for number, block in enumerate(sent):
                    block = getattr(block, "value", block)
                    k = by[ends[number]: ends[number + 1]]
                    count[k], mass = block.count(t[k])
                    known[k], base[k] = count[k] > 0, np.log10((count[k] + ADD) / base_total)
                    # Every token stands once before another: the end before the first.
                    score[k] -= np.log10(mass.astype(np.float64) + MU)
                    k = by2[ends2[number]: ends2[number + 1]]
                    f = frequent[k]
                    c = np.where(f >= 0, hot_counts[f], count[k]) if len(hot) else count[k]
                    pair = np.zeros(len(k))
                    pair[c > 0] = dequantised(block.level(p[k][c > 0]))
                    score[k] += np.log10(pair + MU * (c + ADD) / base_total)
                yield _summed_up(bounds, n, [part.column(x) for x in columns], columns, base, score, known)

    return d.mapInArrow(trimmed(run), ddl)


def _chunks(limit: int):
    """Rows with the number of their chunk, a run of rows of about ``limit`` bytes of text, and their place in the task."""
    def run(batches):
        at = row = 0
        first = TaskContext.get().partitionId() << 33
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column("__text")), 0).to_numpy().astype(np.int64) + 1
            begin = at + np.cumsum(size) - size
            rows = np.arange(row, row + len(size))
            at, row = at + int(size.sum()), row + len(size)
            yield pa.record_batch([*batch.columns, pa.array(first + begin // limit), pa.array(rows)], names=[*batch.schema.names, "__chunk", "__row"])
    return run


def _numbered(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, the place of one of each, and the number of its hash for every place."""
    by = _order(h)
    at = _runs(h[by])
    number = np.empty(len(h), np.int64)
    number[by] = np.repeat(np.arange(len(at)), np.diff(at, append=len(h)))
    return h[by[at]], by[at], number


def _asked(h: np.ndarray, block: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes by their blocks, the bounds of the blocks, and the place of every hash among them."""
    u, one, number = _numbered(h)
    by, ends = _by_block(block[one], blocks)
    place = np.empty(len(u), np.int64)
    place[by] = np.arange(len(u))
    return u[by], ends, place[number]


def _pieces(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The values between neighbouring ``ends`` as bytes."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _joined(table: pa.Table | pa.RecordBatch, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _by_shuffle(d: DataFrame, model: Model, columns: list[str], ddl: str) -> DataFrame:
    """Scores by a model that stays in its blocks: distinct words and pairs of every chunk of text
    meet them there, in ``ROUNDS`` that take turns on the disk, and the answers meet the chunk again."""
    blocks, n, hot, probes, absent, base_total = model.blocks, model.tokens, model.hot, model.probes, model.absent, model.tokens + ADD * (model.words + 1)
    schema = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in d.schema)
    # Stored, as the rows of a chunk must be the same when it asks and when it is scored.
    texts = materialize(d.mapInArrow(trimmed(_chunks(TEXT_BYTES)), f"{schema}, __chunk long, __row long"), "llm-lm-texts")

    def hashed(texts):
        t, bounds = token_hashes(texts)
        p = pair_hashes(t, bounds)
        return bounds, ((t, _block(t, blocks)), (p, pair_blocks(p, t, hot, blocks)))

    def ask(turn):
        def asked(chunk, row, texts):
            _, both = hashed(texts)
            (words, ends, _), (pairs, ends2, _) = (_asked(h[mine := block % ROUNDS == turn], block[mine], blocks) for h, block in both)
            out = pa.record_batch([pa.array(np.full(blocks, chunk)), pa.array(np.full(blocks, row)), pa.array(np.arange(blocks, dtype=np.int32)), _pieces(words, ends), _pieces(pairs, ends2)],
                                  names=["chunk", "row", "block", "words", "pairs"])
            return out.filter(pa.array((ends[1:] > ends[:-1]) | (ends2[1:] > ends2[:-1])))

        def run(batches):
            """A chunk may lie in two tasks; what each reads of it asks by itself, under the place of its first row."""
            at, held = None, []
            for batch in batches:
                chunk, row = (batch.column(c).to_numpy() for c in ("__chunk", "__row"))
                cuts = [0, *(np.flatnonzero((chunk[1:] != chunk[:-1]) | (row[1:] != row[:-1] + 1)) + 1).tolist(), len(chunk)]
                for i, j in zip(cuts, cuts[1:]):
                    if at is not None and (chunk[i], row[i]) != (at[0], at[1] + len(held)):
                        yield asked(*at, held)
                        at = None
                    if at is None:
                        at, held = (chunk[i], row[i]), []
                    held += batch.column("__text").slice(i, j - i).to_pylist()
            if at is not None:
                yield asked(*at, held)
        return run

    def answer(key, asked, known):
        read = {c: b"".join(x for x in known.column(c).to_pylist() if x) for c in ("words", "counts", "mass", "bits")}
        block = Block(read["words"], read["counts"], read["mass"], read["bits"] or bytes(8), probes, absent)
        ends = [np.concatenate([[0], np.cumsum(pc.binary_length(asked.column(c)).to_numpy() // 8)]) for c in ("words", "pairs")]
        counts, mass = block.count(_joined(asked, "words", np.uint64))
        return pa.table([*(asked.column(c) for c in ("chunk", "row", "block")), _pieces(counts, ends[0]), _pieces(mass, ends[0]), _pieces(block.level(_joined(asked, "pairs", np.uint64)), ends[1])],
                        names=["chunk", "row", "block", "counts", "mass", "levels"])

    def score(key, chunk, answers):
        chunk = chunk.take(pc.sort_indices(chunk, [("__row", "ascending")])).combine_chunks()
        answers = answers.take(pc.sort_indices(answers, [("block", "ascending")]))
        turn, first, row = answers.column("block").to_numpy() % ROUNDS, answers.column("row").to_numpy(), chunk.column("__row").to_numpy()
        bounds, ((t, home), (p, place)) = hashed(chunk.column("__text").to_pylist())
        count, mass, level = np.zeros(len(t), np.int64), np.zeros(len(t), np.float32), np.zeros(len(t), np.uint8)
        for k in range(ROUNDS):
            parts = np.unique(first[turn == k])
            ends = bounds[np.append(np.searchsorted(row, parts), len(row))]
            for part, i, j in zip(parts, ends, ends[1:]):
                mine = answers.filter(pa.array((turn == k) & (first == part)))
                for h, block, found in ((t, home, {"counts": count, "mass": mass}), (p, place, {"levels": level})):
                    at = i + np.flatnonzero(block[i:j] % ROUNDS == k)
                    u, _, number = _asked(h[at], block[at], blocks)
                    for name, out in found.items():
                        got = _joined(mine, name, out.dtype)
                        if len(got) != len(u):
                            raise ValueError("What a chunk asked differs from what it is told")
                        out[at] = got[number]
        smooth = (count + ADD) / base_total
        score = np.log10(np.where(count > 0, dequantised(level), 0) + MU * smooth) - np.log10(mass.astype(np.float64) + MU)
        return pa.Table.from_batches([_summed_up(bounds, n, [chunk.column(x).combine_chunks() for x in columns], columns, np.log10(smooth), score, count > 0)])

    nothing, answers = F.lit(None).cast("binary"), None
    known = model.words_of.select("block", "words", "counts", "mass", nothing.alias("bits")).union(
        model.bits_of.select("block", nothing, nothing, nothing, "bits"))
    for turn in range(ROUNDS):
        asked = texts.select("__text", "__chunk", "__row").mapInArrow(trimmed(ask(turn)), "chunk long, row long, block int, words binary, pairs binary")
        met = asked.groupBy("block").cogroup(known.where(F.col("block") % ROUNDS == turn).groupBy("block"))
        with shuffles_dropped(d.sparkSession):
            told = materialize(met.applyInArrow(answer, "chunk long, row long, block int, counts binary, mass binary, levels binary"), "llm-lm-told")
        answers = told if answers is None else answers.unionByName(told)
    for stored in (model.words_of, model.bits_of):  # all is answered
        forget_files(stored)
    return texts.groupBy("__chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, ddl)


def op3_bloom_lm(spark, sf_dir: str) -> DataFrame:
    """Scores of every document under the model of nine tenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    d = score_texts(docs, docs.where(fold(10) != 0), ["doc_id"])
    return d.select("doc_id", (fold(10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
