"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

A lexicon of words and word beginnings with their log-odds is learned from a
part of the labelled sample, the trees (pyspark.ml) from another, the
calibration from a third. Features of a text: lexicon densities, plain and
after undoing common disguises, how often a second-person word stands near a
hit, and rates of capitals, punctuation, symbol runs and disguised words."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import fold, slices, table, trimmed
from wardflow.session import materialize

SAMPLE_ROWS = 16_000   # labelled rows used for fitting, chosen by id hash within each label
LEXICON = 400          # entries at most
NEAR = 5               # words between a hit and a second-person word
THRESHOLD = 0.3
CACHE = 100_000
SLICE_BYTES = 1 << 20  # text split into words at once
# Second-person words (English, German, French, Spanish). Fixed values.
SECOND_PERSON = {"you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu",
                 "te", "toi", "ton", "ta", "tes", "vous", "votre", "tú", "ti", "usted", "ustedes", "vos", "vosotros"}
# Characters that stand for letters in disguised words. Fixed values.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_SIGNS = re.compile(r"\W*")
_RUN = re.compile(r"([^\w\s])\1\1")
_INNER = re.compile(r"[^\W\d_][^\w\s'’-]+[^\W\d_]|[^\W\d_]\d+[^\W\d_]|(\w)\1\1")
_TRIPLE = re.compile(r"(\w)\1\1")
_NO_LETTER = re.compile(r"[^\w]|[\d_]")
_REPEATED = re.compile(r"(\w)\1+")
_PLAIN = (False, 0.0, False, False, False, False, False, 0, 0, False)
NAMES = ["hits", "weight", "hidden", "disguised", "second", "caps", "initials", "punctuation", "exclaims", "runs",
         "log_hits", "top", "near", "log_words", "distinct"]


def _core(word: str) -> str:
    """The word without signs at its ends, in linear time."""
    if word[0].isalnum() and word[-1].isalnum():
        return word
    a = _SIGNS.match(word).end()
    return word[a: len(word) - _SIGNS.match(word[::-1]).end()] if a < len(word) else ""


def _terms(word: str):
    yield word + "$"
    for n in range(3, min(len(word), 10) + 1):
        yield word[:n]


def learn_lexicon(texts: list, toxic: list[int], size: int = LEXICON) -> dict[str, float]:
    """Words (ending in $) and word beginnings that mark label 1: log-odds of
    the document frequencies, at least 2, from five documents on. A longer
    beginning is taken only if it says clearly more than a shorter one."""
    seen = (Counter(), Counter())
    for t, y in zip(texts, toxic):
        words = {_core(w) for w in (t or "").lower().split()}
        seen[y].update({x for w in words if len(w) >= 3 for x in _terms(w)})
    n1, n0 = sum(toxic) + 1.0, len(toxic) - sum(toxic) + 1.0
    odds = {x: np.log((a + 0.5) / n1) - np.log((seen[0][x] + 0.5) / n0) for x, a in seen[1].items() if a >= 5}
    gain = {x: v * np.sqrt(seen[1][x]) for x, v in odds.items() if v >= 2}
    best = sorted(sorted(gain, key=lambda x: (-gain[x], x))[: 5 * size], key=lambda x: (len(x), x))
    out: dict[str, float] = {}
    for x in best:
        if odds[x] > max((out[x[:k]] for k in range(3, len(x)) if x[:k] in out), default=0) + 0.5:
            out[x] = float(odds[x])
    return {x: out[x] for x in sorted(out, key=lambda x: (-gain[x], x))[:size]}


class Features:
    """Dense features of texts; what a word contributes is remembered."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.begins = {x[:3] for x in lexicon}  # every entry has three characters at least
        self.forget()

    def forget(self) -> None:
        self.row: dict[str, int] = {}     # a word's place in ``known``; words that are no hits share a place by value
        self.shared: dict[tuple, int] = {}
        self.known = np.zeros((0, 10), np.float32)

    def _weight(self, w: str) -> float:
        return max((self.lexicon[x] for x in _terms(w) if x in self.lexicon), default=0.0) if w[:3] in self.begins and len(w) >= 3 else 0.0

    def _word(self, raw: str) -> tuple:
        if raw.isalpha() and raw.islower() and raw[:3] not in self.begins and raw not in SECOND_PERSON and not _TRIPLE.search(raw):
            return _PLAIN
        low = raw.lower()
        core = low if low[0].isalnum() and low[-1].isalnum() else _core(low)
        plain = self._weight(core)
        signs = 0 if raw.isalnum() else len(raw) - sum(map(str.isalnum, raw))
        # Without signs and digits only a letter three times can make it disguised.
        inner = bool((_TRIPLE if raw.isalpha() else _INNER).search(raw))
        hidden = 0.0
        if not plain and (inner or core != low):
            undone = _NO_LETTER.sub("", low.translate(LEET))
            hidden = self._weight(undone)
            once = _REPEATED.sub(r"\1", undone)
            if once != undone:
                hidden = max(hidden, self._weight(once))
        w = plain or hidden
        return (w > 0, w, hidden > 0, inner, core in SECOND_PERSON, raw.isupper() and sum(map(str.isalpha, raw)) > 1, raw[0].isupper(), signs,
                raw.count("!"), signs > 2 and bool(_RUN.search(raw)))

    def matrix(self, texts: list) -> np.ndarray:
        """One row per text (null as empty; all zero without words)."""
        split = [(t or "").split() for t in texts]
        if len(self.row) > CACHE:
            self.forget()
        made, n = [], len(self.known)
        for word in set().union(*split) - self.row.keys():
            x = self._word(word)
            at = n + len(made) if x[0] else self.shared.setdefault(x, n + len(made))
            if at == n + len(made):
                made.append(x)
            self.row[word] = at
        known = self.known = np.concatenate([self.known, np.array(made, np.float32).reshape(-1, 10)])
        get = self.row.__getitem__
        out = np.zeros((len(texts), len(NAMES)))
        for i, s in enumerate(split):
            if not s:
                continue
            ids = np.fromiter(map(get, s), np.int64, len(s))
            x = known[ids]
            out[i, :10] = x.mean(0)
            hits, you = np.flatnonzero(x[:, 0]), np.flatnonzero(x[:, 4])
            if len(hits):
                out[i, 10], out[i, 11], out[i, 14] = np.log1p(len(hits)), x[:, 1].max(), np.log1p(len(np.unique(ids[hits])))
                if len(you):
                    at = np.searchsorted(you, hits)
                    gap = np.minimum(np.abs(you[np.minimum(at, len(you) - 1)] - hits), np.abs(you[np.maximum(at - 1, 0)] - hits))
                    out[i, 12] = (gap <= NEAR).mean()
            out[i, 13] = np.log1p(len(s))
        return out


class ToxicityModel:
    """Fitted lexicon, trees and calibration."""

    def __init__(self, lexicon, trees, isotonic, prior: float):
        self.lexicon, self.trees, self.isotonic, self.prior = lexicon, trees, isotonic, prior

    def score(self, docs: DataFrame, columns: list[str], name: str = "score") -> DataFrame:
        """``columns`` of every row with the score as ``name`` (0 to 1, higher:
        label 1 likelier); a column of that name is replaced."""
        columns = [c for c in columns if c != name]
        f = with_features(docs, columns, self.lexicon)
        if self.trees is None:
            return f.select(*columns, F.lit(self.prior).alias(name))
        p = self.trees.transform(f.withColumn("__features", array_to_vector("__features")))
        p = p.withColumn("__raw", vector_to_array("__p")[1])
        p = self.isotonic.transform(p)
        # The raw probability keeps the order inside the steps of the calibration.
        p = p.withColumn("__s", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("__calibrated") * 0.98 + F.col("__raw") * 0.02)))
        return p.select(*columns, F.col("__s").alias(name))


def with_features(docs: DataFrame, columns: list[str], lexicon: dict[str, float]) -> DataFrame:
    """``columns`` of every row and ``__features``."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most LEXICON entries
    schema = docs.select(*columns).schema

    def run(batches):
        f = Features(sent.value)
        for batch in batches:
            for i, j, texts in slices(batch.column("__text"), SLICE_BYTES):
                x = pa.array(list(f.matrix(texts)), pa.list_(pa.float64()))
                yield pa.record_batch([*[batch.column(c).slice(i, j - i) for c in columns], x], names=[*columns, "__features"])

    d = docs.select(*columns, F.col("text").alias("__text"))
    out = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in schema)
    return d.mapInArrow(trimmed(run), f"{out}, __features array<double>")


def _sample(labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, y, part, w): at most ``sample`` labelled rows, of each label
    those with the smallest id hashes. The labels share the sample as they
    share the table, but an eighth of it is kept for each as far as it has rows;
    the weight ``w`` undoes that. Parts 0 to 7 are dealt within each label."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(4) != 2))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")).withColumn("h", F.xxhash64("doc_id")))
    count = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    total = sum(count.values())
    least = {y: min(n, sample // 8) for y, n in count.items()}
    rows = []
    for y in sorted(count):  # two labels
        share = max(round(count[y] * min(1.0, sample / total)), least[y])
        take = min(count[y], share, sample - sum(n for k, n in least.items() if k != y))
        ids = [r["doc_id"] for r in known.where(F.col("y") == y).orderBy("h", "doc_id").limit(take).select("doc_id").collect()]
        # Part 7 first and parts of the trees next, so that they hold a rare label too.
        rows += [(i, y, (7, 0, 4, 1, 5, 2, 6, 3)[k % 8], count[y] / take * min(1.0, sample / total)) for k, i in enumerate(ids)]
    return labels.sparkSession.createDataFrame(rows, f"doc_id {labels.schema['doc_id'].dataType.simpleString()}, y int, part int, w double")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fit on at most ``sample`` labelled rows (smallest id hashes, both labels
    present as far as there are any) outside the held-out fold. Rows of an id
    labelled twice count once (the larger label); null ids and labels take no
    part. Without rows of both labels no classifier is fitted and the score is
    the share of label 1 (0.5 without any row)."""
    known = _sample(labels, sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"])
    rows = materialize(rows, "llm-toxic-sample")
    words = rows.where("part < 4").select("text", "y").toPandas()  # at most ``sample`` rows
    n, ones, weight, toxic_weight = rows.agg(F.count("y"), F.sum("y"), F.sum("w"), F.sum(F.col("w") * F.col("y"))).first()
    if len(words) == 0 or not ones or ones == n:
        return ToxicityModel({}, None, None, float(ones) / n if n else 0.5)
    lexicon = learn_lexicon(words["text"].tolist(), words["y"].tolist())
    f = with_features(rows, ["doc_id", "y", "part", "w"], lexicon).withColumn("__features", array_to_vector("__features"))
    f = materialize(f, "llm-toxic-features").withColumn("label", F.col("y").cast("double")).coalesce(4)

    def holding_both(part: DataFrame) -> DataFrame:
        return part if part.select("y").distinct().count() == 2 else f

    trees = GBTClassifier(maxIter=15, maxDepth=3, stepSize=0.2, maxBins=64, seed=7, featuresCol="__features", predictionCol="__pr", weightCol="w")
    trees = trees.setRawPredictionCol("__rp").setProbabilityCol("__p").fit(holding_both(f.where("part >= 4 AND part < 7")))
    raw = trees.transform(holding_both(f.where("part = 7"))).select("label", "w", vector_to_array("__p")[1].alias("__raw"))
    isotonic = IsotonicRegression(featuresCol="__raw", labelCol="label", predictionCol="__calibrated", weightCol="w").fit(raw)
    return ToxicityModel(lexicon, trees, isotonic, toxic_weight / weight)


def toxicity(docs: DataFrame, labels: DataFrame, columns: list[str], name: str = "score") -> DataFrame:
    """``columns`` of every row of ``docs`` and the score as ``name``. Null and empty texts
    are scored like any text without words; repeated rows score alike; an empty
    table gives none."""
    return fit(docs, labels).score(docs, columns, name)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    d = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return d.select("doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
