"""Secret scan: fixed patterns, and a linear-chain conditional random field.

The patterns (assignments to names such as ``password``, access keys, long hex
strings) are always reported. The field tags every token as begin, inside or
outside of a secret, from the token's shape, the tokens around it and features
of the whole text, and is decoded by Viterbi; what it finds beyond the patterns
is reported as kind ``crf``. It learns from passages around pattern matches, in
which the values are also redrawn from other alphabets, and from passages
without a match, so that it goes by shape and neighbourhood."""

from __future__ import annotations

import random
import re
import string
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import mix64, slices, table

# Fixed patterns, in the order in which spans of equal start are reported.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs of 32 and more
KINDS = ("assign", "access", "hex", "crf")
# Texts in which a pattern can match (a superset), for Spark.
MAY_MATCH = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|(?-i)AKIA[A-Z0-9]{12}|[0-9a-f]{32}"

PASSAGES = 600          # passages of each kind used for fitting, smallest hashes first
PASSAGE_CHARS = 200     # text before and after the start of a span in a passage
VARIANTS = 3            # redrawn copies of a passage with a span, and one with ordinary words in their place
MIN_CHARS = 8           # shorter runs of tags are no secret
OFFSETS = (-4, -3, -2, -1, 0, 1, 2)
MARGIN = 4              # tokens between texts, all outside
BUCKETS = 1 << 13
PIECE = 128             # tokens of a piece in decoding
CACHE = 200_000         # distinct tokens remembered in a task
FILES = 64              # values of the file feature
OUT, BEGIN, INSIDE = range(3)
_NEVER = -1e4

_TOKEN = re.compile(r"\s?(?:[^\W_]+|[^\w\s]|_)")  # a word or sign, with one blank before it if there is one


def _kinds() -> np.ndarray:
    """Class of every code unit below 256: 0 other letter, 1 lower, 2 upper, 3 digit, 4 sign, 5 white space."""
    kind = np.zeros(256, np.uint8)
    for c in map(chr, range(256)):
        kind[ord(c)] = 5 if c.isspace() else 3 if c.isdigit() else 1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 0 if c.isalnum() else 4
    return kind


_KIND = _kinds()
_VOWEL, _HEX = (np.isin(np.arange(256), [ord(c) for c in x]) for x in ("aeiouyAEIOUY", string.digits + "abcdef"))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the pattern matches, sorted by start and kind; the
    span of an assignment is the whole match."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def values(text: str) -> list[tuple[int, int]]:
    """Where the secrets themselves stand in the matches, in order, apart."""
    found = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= 16] + [m.span() for m in HEX.finditer(text)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


NEAR = 3  # the first features of a token, which its neighbours see too


def token_features(tokens: list[str]) -> np.ndarray:
    """(token, feature): hashed features. Shape (the first six runs of equal
    character classes), length and lower-cased word, which neighbours see too;
    whether it is glued to the token before it, how often its class changes,
    vowels, digits, length if hexadecimal, and shape with length."""
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    code = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.cumsum(size) - size
    wide = code > 255
    low = np.where(wide, 0, code).astype(np.uint8)
    kind = np.where(wide, 0, _KIND[low])
    loose = kind[begin] == 5
    begin, size = begin + loose, size - loose                # without the blank
    owner = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    own = np.repeat(begin, size) + at
    kind, low, wide, code = kind[own], low[own], wide[own], code[own]
    edge = np.cumsum(size) - size
    new = np.concatenate([[True], kind[1:] != kind[:-1]])
    new[edge] = True
    run = np.cumsum(new)
    run = run - run[edge][owner]
    shape = np.bincount(owner, np.where(new & (run < 6), (kind + 1.0) * 7.0 ** np.minimum(run, 6), 0), len(size))
    of = lambda x: np.bincount(owner, x, len(size))
    bits = np.ceil(np.log2(size + 1))
    lower = np.where(kind == 2, code + 32, code).astype(np.uint64)
    word = np.add.reduceat(mix64(lower + (at.astype(np.uint64) << np.uint64(32)) + np.uint64(1)), edge)
    values = [shape, bits, np.where(size <= 16, word, np.uint64(0)), loose, np.minimum(of(new), 12), 8 * of(_VOWEL[low] & ~wide) // size,
              8 * of(kind == 3) // size, np.where(of(_HEX[low] & ~wide) == size, bits, 0), shape * 64 + bits]
    return np.stack([(mix64(np.asarray(v).astype(np.uint64) * np.uint64(16) + np.uint64(i)) % np.uint64(BUCKETS)).astype(np.int64)
                     for i, v in enumerate(values)], 1)


def _places(text: str) -> list[tuple[int, int]]:
    """(start, end) of the tokens, without the blank."""
    return [(m.start() + text[m.start()].isspace(), m.end()) for m in _TOKEN.finditer(text)]


def file_feature(text: str, tokens: list[str]) -> int:
    """One of FILES values: how many of the tokens are signs, how long lines
    are, and whether brackets and equals signs abound as in code and settings."""
    if not tokens:
        return 0
    marks = sum(map(text.count, string.punctuation))
    code = sum(map(text.count, "={}[];"))
    lines = text.count("\n") + 1
    return min(3, 10 * marks // len(tokens)) * 16 + min(3, (len(text) // lines).bit_length() // 3) * 4 + min(3, (100 * code // len(tokens)).bit_length() // 2)


def viterbi(e: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The best labels of one chain: ``e`` (tokens x labels) and ``move``
    (label before, label) are log scores. The chain is cut into pieces that are
    worked side by side: each piece's best score from every label before it to
    every label at its end, composed from left to right, gives the state it is
    entered with, and back pointers are followed the same way from the right."""
    n, k = e.shape
    lanes = -(-n // PIECE)
    e = np.concatenate([e, np.zeros((lanes * PIECE - n, k))]).reshape(lanes, PIECE, k).transpose(1, 2, 0)  # (step, label, lane)
    step = lambda v, t: (v[..., :, None, :] + move[:, :, None]).max(-3) + e[t]  # noqa: E731  v: (..., label, lane)
    m = np.where(np.eye(k, dtype=bool)[:, :, None], 0.0, _NEVER * PIECE) + np.zeros((k, k, lanes))
    for t in range(PIECE):
        m = step(m, t)
    entry = np.zeros((k, lanes))
    entry[BEGIN:, 0] = _NEVER  # before the first token: outside
    for i in range(1, lanes):
        v = (entry[:, i - 1, None] + m[:, :, i - 1]).max(0)
        entry[:, i] = v - v.max()
    back = np.empty((PIECE, k, lanes), np.int8)
    v = entry
    for t in range(PIECE):
        s = v[:, None, :] + move[:, :, None]
        back[t] = s.argmax(0)
        new = s.max(0) + e[t]
        if t >= n - (lanes - 1) * PIECE:  # behind the end of the chain nothing moves
            back[t, :, -1], new[:, -1] = np.arange(k), v[:, -1]
        v = new
    # From every label at a piece's end to the label before the piece.
    lane = np.arange(lanes)
    at = np.repeat(np.arange(k)[:, None], lanes, 1)
    for t in range(PIECE - 1, -1, -1):
        at = back[t][at, lane]
    end = np.empty(lanes, np.int64)
    end[-1] = v[:, -1].argmax()
    for i in range(lanes - 1, 0, -1):
        end[i - 1] = at[end[i], i]
    out = np.empty((PIECE, lanes), np.int8)
    now = end
    for t in range(PIECE - 1, -1, -1):
        out[t] = now
        now = back[t][now, lane]
    return out.T.ravel()[:n]


def likelihood(e: np.ndarray, y: np.ndarray, some: np.ndarray, move: np.ndarray):
    """(minus log likelihood, its gradients by ``e`` and ``move``) of chains side
    by side: ``e`` (chain, token, label), ``y`` labels, ``some`` true where a
    chain has a token. Every chain is entered from outside."""
    lanes, steps, k = e.shape
    x, trans = np.exp(np.clip(e, -50, 50)), np.exp(move)
    alpha, scale = np.zeros((steps + 1, lanes, k)), np.ones((steps + 1, lanes))
    alpha[0, :, OUT] = 1
    for t in range(steps):
        a = np.where(some[:, t, None], alpha[t] @ trans * x[:, t], alpha[t])
        scale[t + 1] = a.sum(1)
        alpha[t + 1] = a / scale[t + 1][:, None]
    beta = np.ones((lanes, k))
    d_e, d_move = np.zeros_like(e), np.zeros_like(move)
    for t in range(steps - 1, -1, -1):
        here = some[:, t, None]
        d_e[:, t] = np.where(here, alpha[t + 1] * beta, 0)
        out = x[:, t] * beta / scale[t + 1][:, None]      # emission and message of token t
        d_move += trans * (np.where(here, alpha[t], 0).T @ out)
        beta = np.where(here, out @ trans.T, beta)
    before = np.concatenate([np.full((lanes, 1), OUT), y[:, :-1]], 1)
    row, col = np.nonzero(some)
    loss = np.log(scale).sum() - np.clip(e, -50, 50)[row, col, y[row, col]].sum() - move[before[row, col], y[row, col]].sum()
    d_e[row, col, y[row, col]] -= 1
    np.subtract.at(d_move, (before[row, col], y[row, col]), 1)
    return loss, d_e, d_move


class Tagger:
    """Weights per offset (bucket x label), file weights and label changes."""

    def __init__(self):
        self.w = np.zeros((len(OFFSETS), BUCKETS, 3), np.float32)
        self.file = np.zeros((FILES, 3), np.float32)
        self.move = np.array([[0, 0, _NEVER], [0, 0, 0], [0, 0, 0]], float)  # nothing goes on inside that has not begun
        self.forget()

    def __getstate__(self):
        return self.w, self.file, self.move

    def __setstate__(self, state):
        self.w, self.file, self.move = state
        self.forget()

    def forget(self) -> None:
        self.row = {"": 0}  # the token between texts
        self.table = np.zeros((len(OFFSETS), 1, 3), np.float32)

    def scores(self, tokens: list[str], features: np.ndarray) -> np.ndarray:
        """(offset, token, label): what a token adds to the token it stands OFFSETS
        after. No secret goes on behind a blank."""
        out = np.stack([self.w[i][features if o == 0 else features[:, :NEAR]].sum(1) for i, o in enumerate(OFFSETS)])
        out[OFFSETS.index(0), [t[0].isspace() for t in tokens], INSIDE] = _NEVER
        return out

    def _rows(self, split: list[list[str]]) -> np.ndarray:
        new = list({t for s in split for t in s} - self.row.keys())
        if len(self.row) + len(new) > CACHE:
            self.forget()
            new = list({t for s in split for t in s})
        for a in range(0, len(new), 20_000):
            part = new[a: a + 20_000]
            at = len(self.row)
            self.row.update((t, at + i) for i, t in enumerate(part))
            self.table = np.concatenate([self.table, self.scores(part, token_features(part))], 1)
        return np.fromiter(map(self.row.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))

    def tags(self, texts: list[str]) -> list[np.ndarray]:
        """Labels of the tokens of every text."""
        split = [_TOKEN.findall(t) for t in texts]
        size = np.array([len(s) for s in split])
        ids = self._rows(split)
        begin = MARGIN + np.concatenate([[0], np.cumsum(size + MARGIN)])[:-1]
        at = np.arange(len(ids)) + np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        line = np.zeros(int(size.sum()) + MARGIN * (len(size) + 1), np.int64)
        line[at] = ids
        e = np.zeros((len(line), 3))
        for i, o in enumerate(OFFSETS):
            e[max(0, -o): len(e) - max(0, o)] += self.table[i][line[max(0, o): len(line) + min(0, o)]]
        e[at] += np.repeat(self.file[[file_feature(t, s) for t, s in zip(texts, split)]], size, axis=0)
        between = np.ones(len(line), bool)
        between[at] = False
        e[between] = [0, _NEVER, _NEVER]
        found = viterbi(e, self.move)
        return [found[b: b + n] for b, n in zip(begin.tolist(), size.tolist())]

    def spans(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """(start, end) of the tagged runs of at least MIN_CHARS code points."""
        out = []
        for text, tags in zip(texts, self.tags(texts) if texts else []):
            runs: list[tuple[int, int]] = []
            if tags.any():
                place = _places(text)
                for i in np.flatnonzero(tags).tolist():
                    if tags[i] == BEGIN:
                        runs.append(place[i])
                    else:
                        runs[-1] = (runs[-1][0], place[i][1])
            out.append([r for r in runs if r[1] - r[0] >= MIN_CHARS])
        return out

    def fit(self, passages: list[tuple[str, int, list[tuple[int, int]]]], rounds: int = 60, rate: float = 0.3, l2: float = 1e-4) -> Tagger:
        """AdaGrad on the likelihood of all (text, file feature, spans)."""
        split, labels = [], []
        for text, _, spans in passages:
            place = _places(text)
            split.append(_TOKEN.findall(text))
            y = np.zeros(len(place), np.int64)
            for a, b in spans:
                inside = [i for i, (s, t) in enumerate(place) if s < b and t > a]
                y[inside] = INSIDE
                y[inside[:1]] = BEGIN
            labels.append(y)
        steps = max(map(len, split)) + 2 * MARGIN
        names = ["", *sorted({t for s in split for t in s})]
        number = {t: i for i, t in enumerate(names)}
        line, y = np.zeros((len(split), steps), np.int64), np.zeros((len(split), steps), np.int64)
        some = np.zeros(line.shape, bool)
        for i, (s, own) in enumerate(zip(split, labels)):
            line[i, MARGIN: MARGIN + len(s)] = [number[t] for t in s]
            y[i, MARGIN: MARGIN + len(s)] = own
            some[i, MARGIN: MARGIN + len(s)] = True
        features = token_features(names[1:])
        file = np.array([p[1] for p in passages])
        g_w, g_f, g_m = (np.full(x.shape, 1e-2) for x in (self.w, self.file, self.move))
        for _ in range(rounds):
            lookup = np.concatenate([np.zeros((len(OFFSETS), 1, 3)), self.scores(names[1:], features)], 1)
            e = np.repeat(self.file[file][:, None], steps, 1).astype(float)
            for i, o in enumerate(OFFSETS):
                e += lookup[i][np.roll(line, -o, 1)]  # the margins are as wide as the largest offset
            _, d_e, d_move = likelihood(e, y, some, self.move)
            grads = np.empty(self.w.shape, np.float32)
            for i, o in enumerate(OFFSETS):
                token = np.roll(line, -o, 1).ravel()
                bucket = features if o == 0 else features[:, :NEAR]
                for j in range(3):
                    per_token = np.bincount(token, d_e[:, :, j].ravel(), len(names))[1:]
                    grads[i, :, j] = np.bincount(bucket.ravel(), np.repeat(per_token, bucket.shape[1]), BUCKETS)
            d_file = np.stack([np.bincount(file, d_e[:, :, j].sum(1), FILES) for j in range(3)], 1)
            d_move[OUT, INSIDE] = 0
            for w, g, d in ((self.w, g_w, grads + l2 * self.w), (self.file, g_f, d_file + l2 * self.file), (self.move, g_m, d_move)):
                g += d ** 2
                w -= (rate * d / np.sqrt(g)).astype(w.dtype)
        self.forget()
        return self


def passages(text: str) -> list[tuple[str, list[tuple[int, int]]]]:
    """(passage, spans in it): around up to three values, or one passage of a
    text without any, at a place drawn from the text's checksum."""
    spans = values(text)
    if not spans:
        a = zlib.crc32(text.encode("utf-8", "surrogatepass")) % max(1, len(text) - 2 * PASSAGE_CHARS)
        return [(text[a: a + 2 * PASSAGE_CHARS], [])]
    out = []
    for a, b in spans[:3]:
        lo, hi = max(0, a - PASSAGE_CHARS), min(len(text), a + PASSAGE_CHARS)
        out.append((text[lo:hi], [(max(s, lo) - lo, min(t, hi) - lo) for s, t in spans if s < hi and t > lo]))
    return out


_NAMES = ("password", "passwd", "pwd", "secret", "client_secret", "token", "access_token", "auth", "auth_key", "api_key", "apikey",
          "private_key", "access_key", "credential", "passphrase")
_SIGNS = (" = ", "=", ": ", ":", " => ", " is ", " := ", " ")
_LEAD = re.compile(r"""\w+["']?\s*[:=]\s*["']?$""")


def redrawn(text: str, spans: list[tuple[int, int]], seed: int, words: list[str] | None = None) -> tuple[str, list[tuple[int, int]]]:
    """The passage with every value redrawn from another alphabet, of 10 to 40
    characters, and the name and sign before it from the lists above; with
    ``words`` the values become one of these words, and are no spans."""
    r = random.Random(seed)
    letters = string.ascii_letters + string.digits
    out, moved, at = "", [], 0
    for a, b in spans:
        alphabet = r.choice([letters, letters, letters + "-_", letters + "+/", string.ascii_uppercase + string.digits, string.digits + "abcdef", letters + "!$%&*#@"])
        value = r.choice(words) if words else "".join(r.choice(alphabet) for _ in range(r.randint(10, 40)))
        head = text[at:a]
        lead = _LEAD.search(head[-60:])
        if lead:
            head = head[: len(head) - len(lead[0])] + r.choice(_NAMES) + r.choice(_SIGNS) + r.choice(("", "'", '"'))
        out += head
        if not words:
            moved.append((len(out), len(out) + len(value)))
        out += value
        at = b
    return out + text[at:], moved


def fit(docs: DataFrame, limit: int = PASSAGES) -> Tagger | None:
    """Fit on at most ``limit`` passages around pattern matches and as many from
    texts without, chosen by hash over all of ``docs``; None where no text
    holds a match. Only passages (at most 2 * PASSAGE_CHARS characters) leave the tasks."""
    schema = pa.schema([("key", pa.int64()), ("text", pa.string()), ("file", pa.int32()), ("spans", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for i, j, texts in slices(batch.column(1)):
                rows = [(k, p, file_feature(t, _TOKEN.findall(t)), [x for s in spans for x in s])
                        for k, t in zip(batch.column(0).slice(i, j - i).to_pylist(), texts) for p, spans in passages(t)]
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    d = docs.select(F.xxhash64("text").alias("key"), "text").where("length(text) > 0")
    may = F.col("text").rlike(MAY_MATCH)
    share = min(1.0, 4 * limit / max(1, docs.count()))  # more than enough; the smallest hashes of these are taken
    ddl = "key long, text string, file int, spans array<long>"
    with_span = d.where(may).mapInArrow(run, ddl).where(F.size("spans") > 0)
    without = d.where(F.pmod("key", F.lit(1 << 20)) < max(1, int(share * (1 << 20)))).mapInArrow(run, ddl).where(F.size("spans") == 0)
    # Copies count once.
    picked = [x.dropDuplicates(["key", "text"]).orderBy(F.pmod("key", F.lit((1 << 61) - 1)), "key", "text").limit(limit).collect() for x in (with_span, without)]
    if not picked[0]:
        return None
    sample = []
    words = [w for r in picked[1] for w in r.text.split()] or ["none"]
    for r in chain.from_iterable(picked):
        spans = list(zip(r.spans[::2], r.spans[1::2]))
        sample.append((r.text, r.file, spans))
        for v in range(VARIANTS if spans else 0):
            text, moved = redrawn(r.text, spans, r.key + v)
            sample.append((text, r.file, moved))
        if spans:
            sample.append((redrawn(r.text, spans, r.key - 1, words)[0], r.file, []))
    return Tagger().fit([s for s in sample if _TOKEN.search(s[0])])


def find_secrets(docs: DataFrame, model: Tagger | None = None) -> DataFrame:
    """Every row of ``docs`` with ``secrets``: an array of (kind, start, end,
    value), by start and then kind (KINDS), in code points, end exclusive.

    Pattern matches are all reported; a run that the field tags is added where
    it touches none of them. Null and empty text has none; where no text holds a
    pattern match nothing can be learned and only patterns are reported.
    Repeated rows are scanned alike, a column ``secrets`` is replaced, an empty
    table gives no rows. A text is scanned whole in one task, its chain in pieces."""
    sent = docs.sparkSession.sparkContext.broadcast(model or fit(docs))  # len(OFFSETS) * BUCKETS * 3 numbers
    columns = [c for c in docs.columns if c != "secrets"]
    kept = docs.select(*columns)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def run(batches):
        tagger = sent.value
        for batch in batches:
            for i, j, texts in slices(batch.column("__text")):
                texts = [t or "" for t in texts]
                rows = []
                for t, runs in zip(texts, tagger.spans(texts) if tagger else [[]] * len(texts)):
                    spans = base_spans(t)
                    more = [("crf", a, b) for a, b in runs if not any(a < y and x < b for _, x, y in spans)]
                    spans = sorted(spans + more, key=lambda s: (s[1], KINDS.index(s[0])))
                    rows.append([{"kind": k, "start": a, "end": b, "value": t[a:b]} for k, a, b in spans])
                yield pa.record_batch([*(batch.column(c).slice(i, j - i) for c in columns), pa.array(rows, kind)], names=[*columns, "secrets"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.withColumn("__text", F.col("text")).mapInArrow(run, f"{ddl}, secrets array<struct<kind string, start long, end long, value string>>")


def op12_crf_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document: pattern matches per kind, their digest, and all spans."""
    d = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return d.select("doc_id", *(of(k).alias(f"n_{k}") for k in KINDS[:3]),
                    F.sha2(joined(F.filter("secrets", lambda s: s["kind"] != "crf")), 256).alias("base_sha256"),
                    joined(F.col("secrets")).alias("spans"), of("crf").alias("n_crf"))
