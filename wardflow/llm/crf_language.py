"""Language identification by a linear-chain conditional random field.

Every word of a text gets a language: its emission scores are sums of learned
weights of its beginnings, endings, letter n-grams and the word itself, and
learned transition scores say how likely the language changes between words.
Forward-backward gives each word's language probabilities; a text gets the
language with the largest mean. All words of a batch are one chain that starts
anew at every text; it is cut into pieces that are worked side by side, and
the pieces' transfer matrices carry the state across their borders."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import fold, mix64, slices, table

SAMPLE_ROWS = 375      # labelled rows of each language used for fitting, smallest id hashes first
SAMPLE_CHARS = 20_000  # of a longer one, a passage of this length at a place drawn from the hash
BUCKETS = 1 << 16      # hashed features
PIECE = 256            # words of a chain piece
CACHE = 200_000
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_FACTOR = mix64(np.arange(1, 17, dtype=np.uint64)) | np.uint64(1)
_DROP = re.compile(r"[^\w'’-]|[\d_]")


def letter_words(text: str) -> list[str]:
    """The words of a text that have a letter, in linear time."""
    return [w for w in text.split() if w.isalpha() or _LETTER.search(w)]


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature, owner): hashed features of every word, and the word they
    belong to. A word is lower-cased, without digits and signs but hyphens and
    apostrophes, between marks for its ends; its features are all its n-grams
    of two to four characters (those with a mark are its affixes) and itself."""
    marked = ["^^" + _DROP.sub("", w.lower()) + "$" for w in words]
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(marked)), size)
    place = np.arange(len(code)) - np.repeat(end - size, size)
    features, owners = [], []
    gram = code * _FACTOR[0]
    for n in (2, 3, 4):
        gram = gram[:-1] + code[n - 1:] * _FACTOR[n - 1]
        inside = np.flatnonzero(place[: len(gram)] + n <= size[owner[: len(gram)]])
        features.append(mix64(gram[inside] + _FACTOR[n + 4]))
        owners.append(owner[inside])
    features.append(mix64(np.add.reduceat(mix64(code + (place.astype(np.uint64) << np.uint64(32))), end - size)))
    owners.append(np.arange(len(marked)))
    return (np.concatenate(features) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(owners)


def _emissions(w: np.ndarray, feature: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owner, w[feature, j], n) for j in range(w.shape[1])], 1)


def _normal(a: np.ndarray) -> np.ndarray:
    return a / np.maximum(a.sum(-1, keepdims=True), 1e-300)


def marginals(e: np.ndarray, begin: np.ndarray, first: np.ndarray, move: np.ndarray, filtered: bool = False):
    """Label probabilities of every word (with ``filtered`` also those given only
    the words up to it). ``e``: positive emissions (words x
    labels), ``begin``: true at the first word of a text, ``first`` and
    ``move``: positive scores of the first label and of label changes."""
    n, k = e.shape
    lanes = -(-n // PIECE)
    pad = lanes * PIECE - n
    e = np.concatenate([_normal(e), np.full((pad, k), 1.0 / k)]).reshape(lanes, PIECE, k).transpose(1, 0, 2)
    begin = np.concatenate([begin, np.ones(pad, bool)]).reshape(lanes, PIECE).T
    last = np.concatenate([begin.T.ravel()[1:], [True]]).reshape(lanes, PIECE).T

    def forward(a, t):
        """a: (lanes, ..., labels); the scale of a row does not matter."""
        s = begin[t].reshape((lanes,) + (1,) * (a.ndim - 1))
        x = e[t].reshape((lanes,) + (1,) * (a.ndim - 2) + (k,))
        return np.where(s, a.sum(-1, keepdims=True) * first, a @ move) * x

    def backward(b, t):
        """From after word t to before it; b holds emission times message."""
        s = last[t].reshape((lanes,) + (1,) * (b.ndim - 1))
        return np.where(s, 1.0, b @ move.T) if b.ndim == 2 else np.where(s, b.sum(-1, keepdims=True), b @ move.T)

    # Transfer of every piece for each entry label, scaled as a whole.
    m = np.broadcast_to(np.eye(k), (lanes, k, k)).copy()
    for t in range(PIECE):
        m = forward(m, t)
        m /= m.sum((1, 2), keepdims=True)
    entry = np.full((lanes, k), 1.0 / k)
    for i in range(1, lanes):
        entry[i] = entry[i - 1] @ m[i - 1]
        entry[i] /= entry[i].sum()
    alpha = np.empty_like(e)
    a = entry
    for t in range(PIECE):
        a = _normal(forward(a, t))
        alpha[t] = a
    # The same from the right: message after the last word of every piece.
    m = np.broadcast_to(np.eye(k), (lanes, k, k)).copy()
    for t in range(PIECE - 1, -1, -1):
        m = backward(m, t) * e[t][:, None]
        m /= m.sum((1, 2), keepdims=True)
    right = np.full((lanes, k), 1.0 / k)  # emission times message of the next word
    for i in range(lanes - 2, -1, -1):
        right[i] = right[i + 1] @ m[i + 1]
        right[i] /= right[i].sum()
    out = np.empty_like(e)
    b = right
    for t in range(PIECE - 1, -1, -1):
        after = backward(b, t)
        out[t] = _normal(alpha[t] * after)
        b = _normal(after * e[t])
    flat = lambda x: x.transpose(1, 0, 2).reshape(-1, k)[:n]
    return (flat(out), flat(alpha)) if filtered else flat(out)


def gradient(e: np.ndarray, y: np.ndarray, begin: np.ndarray, first: np.ndarray, move: np.ndarray):
    """Gradients of minus the log likelihood of labels ``y`` by the log scores
    of words, first labels and changes. A pair of neighbours has the
    probability of its second label times that of the first, given the second
    and the words before: the filtered probability times the change's score."""
    p, before = marginals(e, begin, first, move, filtered=True)
    k = e.shape[1]
    d = p.copy()
    d[np.arange(len(y)), y] -= 1
    inner = np.flatnonzero(~begin)
    a = before[inner - 1]
    d_move = move * (a.T @ (p[inner] / np.maximum(a @ move, 1e-300)))
    np.subtract.at(d_move, (y[inner - 1], y[inner]), 1)
    return d, d[begin].sum(0), d_move.reshape(k, k)


class Crf:
    """Weights of features (BUCKETS x labels), first labels and changes."""

    def __init__(self, labels: list[str]):
        k = len(labels)
        self.labels = labels
        self.w = np.zeros((BUCKETS, k), np.float32)
        self.first, self.move = np.zeros(k), np.zeros((k, k))
        self.forget()

    def forget(self) -> None:
        self.row: dict[str, int] = {}
        self.emission = np.zeros((0, len(self.labels)), np.float32)

    def __getstate__(self):
        return self.labels, self.w, self.first, self.move

    def __setstate__(self, state):
        self.labels, self.w, self.first, self.move = state
        self.forget()

    def words(self, split: list[list[str]]) -> np.ndarray:
        """Row of ``emission`` of every word."""
        if len(self.row) > CACHE:
            self.forget()
        new = list({w for s in split for w in s} - self.row.keys())
        if new:
            at = len(self.row)
            self.row.update((w, at + i) for i, w in enumerate(new))
            e = _emissions(self.w, *word_features(new), len(new)).astype(np.float32)
            self.emission = np.concatenate([self.emission, e])
        return np.fromiter(map(self.row.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))

    def probabilities(self, texts: list) -> np.ndarray:
        """Mean label probabilities of the words with a letter, per text; a row
        of nan for a text without any."""
        split = [letter_words(t or "") for t in texts]
        out = np.full((len(texts), len(self.labels)), np.nan)
        size = np.array([len(s) for s in split])
        some = np.flatnonzero(size)
        if len(some):
            p, at = self.word_probabilities(split)
            out[some] = np.add.reduceat(p, at, axis=0) / size[some][:, None]
        return out

    def word_probabilities(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities of all words, and where the texts with words begin."""
        size = np.array([len(s) for s in split])
        ids = self.words(split)
        at = np.concatenate([[0], np.cumsum(size[size > 0])[:-1]])
        begin = np.zeros(len(ids), bool)
        begin[at] = True
        e = self.emission[ids].astype(np.float64)
        return marginals(np.exp(e - e.max(1, keepdims=True)), begin, np.exp(self.first), np.exp(self.move)), at

    def fit(self, texts: list[str], labels: list[int], epochs: int = 2, rate: float = 0.3, l2: float = 1e-6) -> Crf:
        """Stochastic gradient (AdaGrad) of the chain likelihood. A word carries
        its text's label; every fourth text goes on, from its middle, with the
        second half of another one, so that changes of language are learned too."""
        k = len(self.labels)
        g_w, g_f, g_m = np.full((BUCKETS, k), 1e-2), np.full(k, 1.0), np.full((k, k), 1.0)
        order = np.random.default_rng(5)
        for _ in range(epochs):
            for part in np.array_split(order.permutation(len(texts)), max(1, len(texts) // 16)):
                split = [letter_words(texts[i]) for i in part]
                own = [[labels[i]] * len(s) for i, s in zip(part, split)]
                for i in range(0, len(part) - 1, 4):
                    h, j = len(split[i]) // 2, len(split[i + 1]) // 2
                    split[i], own[i] = split[i][:h] + split[i + 1][j:], own[i][:h] + own[i + 1][j:]
                y = np.fromiter(chain.from_iterable(own), np.int64)
                size = np.array([len(s) for s in split])
                if not len(y):
                    continue
                words, ids = np.unique([w for s in split for w in s], return_inverse=True)
                flat, owner = word_features(words.tolist())
                e = _emissions(self.w, flat, owner, len(words))[ids]
                at = np.concatenate([[0], np.cumsum(size[size > 0])[:-1]])
                begin = np.zeros(len(ids), bool)
                begin[at] = True
                d, d_f, d_m = gradient(np.exp(e - e.max(1, keepdims=True)), y, begin, np.exp(self.first), np.exp(self.move))
                per_word = np.stack([np.bincount(ids, d[:, j], len(words)) for j in range(k)], 1)
                grad = np.stack([np.bincount(flat, per_word[owner, j], BUCKETS) for j in range(k)], 1) / len(y) ** 0.5 + l2 * self.w
                g_w += grad ** 2
                self.w -= (rate * grad / np.sqrt(g_w)).astype(np.float32)
                d_f = d_f / len(at)
                g_f += d_f ** 2
                self.first -= rate * d_f / np.sqrt(g_f)
                d_m = d_m / len(at)
                g_m += d_m ** 2
                self.move -= rate * d_m / np.sqrt(g_m)
        return self


def fit(docs: DataFrame, sample: int = SAMPLE_ROWS) -> Crf:
    """Fit on at most ``sample`` documents of every language (smallest id hashes)
    outside the held-out fold that have a language, an id and a text; of a
    long one, on a passage."""
    first = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("h", "doc_id"))
    known = (docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & (fold(4) != 2))
             .select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).distinct()
             # A language may hold most rows: first among those of equal hash remainder, then of these.
             .withColumn("part", F.pmod("h", F.lit(64))).withColumn("n", first("lang", "part")).where(F.col("n") <= sample)
             .withColumn("n", first("lang")).where(F.col("n") <= sample))
    keep = F.broadcast(known.select("doc_id").distinct())  # at most ``sample`` ids a language
    start = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS)).cast("int")
    rows = docs.select("doc_id", "lang", F.substring("text", start + 1, F.lit(SAMPLE_CHARS)).alias("text")).join(keep, "doc_id", "left_semi")
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL").dropDuplicates(["doc_id"]).orderBy("doc_id").toPandas()
    labels = sorted(rows["lang"].unique())
    if not labels:
        return Crf([UNKNOWN])
    number = {x: i for i, x in enumerate(labels)}
    return Crf(labels).fit(rows["text"].tolist(), [number[x] for x in rows["lang"]])


def word_languages(docs: DataFrame, columns: list[str], model: Crf | None = None) -> DataFrame:
    """``columns`` of every row with ``words``: an array of (word, lang, score),
    one for each word with a letter, in order; for code-switched text. Null and
    empty text has an empty array, repeated rows are labelled alike, and of equally
    likely languages the first in code point order is taken. A text is labelled whole in one task."""
    sent = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    columns = [c for c in columns if c != "words"]
    schema = docs.select(*columns).schema
    kind = pa.list_(pa.struct([("word", pa.string()), ("lang", pa.string()), ("score", pa.float64())]))

    def run(batches):
        crf = sent.value
        for batch in batches:
            for i, j, texts in slices(batch.column("__text")):
                split = [letter_words(t or "") for t in texts]
                p = crf.word_probabilities(split)[0] if any(split) else np.zeros((0, 1))
                best = p.argmax(1).tolist()
                rows, at = [], 0
                for s in split:
                    rows.append([{"word": w, "lang": crf.labels[best[at + n]], "score": float(p[at + n, best[at + n]])} for n, w in enumerate(s)])
                    at += len(s)
                yield pa.record_batch([*(batch.column(c).slice(i, j - i) for c in columns), pa.array(rows, kind)], names=[*columns, "words"])

    out = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in schema)
    return docs.select(*columns, F.col("text").alias("__text")).mapInArrow(run, f"{out}, words array<struct<word string, lang string, score double>>")


def languages(docs: DataFrame, columns: list[str], model: Crf | None = None) -> DataFrame:
    """``columns`` of every row with ``lang_pred`` and ``score`` (the mean
    probability of that language).

    Null text and text without a letter are ``und`` with score 0; so is
    everything if no labelled row exists. Of equally likely languages the first
    in code point order is taken. Repeated rows are predicted alike; an empty table gives
    none. A text is read whole in one task, its chain in pieces, in time linear
    in its length. Labels are only read in fitting."""
    columns = [c for c in columns if c not in ("lang_pred", "score")]  # replaced
    sent = docs.sparkSession.sparkContext.broadcast(model or fit(docs))  # BUCKETS x labels numbers
    schema = docs.select(*columns).schema

    def run(batches):
        crf = sent.value
        for batch in batches:
            for i, j, texts in slices(batch.column("__text")):
                p = crf.probabilities(texts)
                none = np.isnan(p[:, 0])
                p = np.nan_to_num(p)
                best = p.argmax(1)
                kept = [batch.column(c).slice(i, j - i) for c in columns]
                yield pa.record_batch([*kept, pa.array(np.where(none, UNKNOWN, np.array(crf.labels, object)[best]), pa.string()),
                                       pa.array(np.where(none, 0.0, np.clip(p[np.arange(len(p)), best], 0, 1)))],
                                      names=[*columns, "lang_pred", "score"])

    out = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in schema)
    return docs.select(*columns, F.col("text").alias("__text")).mapInArrow(run, f"{out}, lang_pred string, score double")


def op8_crf_language(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    d = languages(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), ["doc_id"])
    return d.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")
