"""Ranked lexical search by hashed max-sketches.

A document's impacts (the part of a term's score that depends on the document
alone) fold into a short vector: the term's hash names a coordinate, which keeps
the largest impact that falls on it. Adding an item's term weights times these
coordinates therefore never gives less than the item's score, and a whole block
of documents and items is one matrix product. Documents are then rescored
exactly in descending order of that bound, until the worst of the best ten
found so far is above the next bound. A task keeps one list of ten an item; the
lists of all tasks are merged by Spark."""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import mix64, slices, table

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")  # the same runs in UTF-8 as the pattern over characters
_SEP = np.ones(256, bool)
_SEP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_STEP = np.uint64(0x9E3779B97F4A7C15)
WIDTH = 4096            # coordinates of a sketch
DOCS = 512              # documents in a matrix
ITEMS = 512             # items searched in one pass over the documents
ITEM_BYTES = 4 << 20    # their texts together, unless one is longer
LIMIT = 10


def terms(text) -> list[bytes]:
    """Terms of a text in UTF-8, A-Z lower-cased; null has none."""
    return TERM.findall((text or "").encode("utf-8", "surrogatepass").lower())


def impact(tf, m):
    """Share of a term in the score, without its weight (ints or int64 arrays)."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_norm(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - 90 + (90 * n * n_docs) // n_terms


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _hashes(texts: list[bytes]):
    """Hash of every term of all texts, and the text it is in."""
    raw = b" " + b" ".join(texts).lower() + b" "
    buf = np.frombuffer(raw, np.uint8)
    out = _SEP[buf]
    edge = np.flatnonzero(out[1:] != out[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # Polynomial over the term's bytes, by position inside the term.
    at = np.arange(len(buf)) - np.repeat(np.concatenate([[0], start]), np.diff(np.concatenate([[0], start, [len(buf)]])))
    value = np.where(out, np.uint64(0), mix64(buf.astype(np.uint64) + np.uint64(1) + at.astype(np.uint64) * _STEP))
    h = mix64(np.add.reduceat(value, start) + (end - start).astype(np.uint64))
    ends = 1 + np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    return h, np.searchsorted(ends, start, "right")


def coordinate(term: bytes) -> int:
    return int(_hashes([term])[0][0] % np.uint64(WIDTH))


def sketches(texts: list[bytes], n_docs: int, n_terms: int) -> np.ndarray:
    """(texts, WIDTH): the largest impact on every coordinate, 0 where none."""
    s = np.zeros((len(texts), WIDTH))
    h, owner = _hashes(texts)
    if len(h):
        size = np.bincount(owner, minlength=len(texts)).tolist()
        norm = np.array([length_norm(n, n_docs, n_terms) for n in size], np.int64)
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]))
        tf = np.diff(np.append(first, len(h)))
        doc = owner[first]
        np.maximum.at(s, (doc, (h[first] % np.uint64(WIDTH)).astype(np.int64)), impact(tf, norm[doc]))
    return s


class Search:
    """Items of one pass with their term weights; ``scan`` keeps the best of what it is shown."""

    def __init__(self, items: list[list[tuple[bytes, int]]], n_docs: int, n_terms: int):
        self.items, self.n_docs, self.n_terms = items, n_docs, n_terms
        self.vocabulary = {t for item in items for t, _ in item}
        at = {t: coordinate(t) for t in self.vocabulary}
        self.weights = np.zeros((WIDTH, len(items)))
        for i, item in enumerate(items):
            for t, w in item:
                self.weights[at[t], i] += w
        self.best: list[list[tuple]] = [[] for _ in items]  # heaps of (score, -doc_id), the worst on top
        self.rescored = 0

    def _score(self, item, found: Counter, norm: int) -> int:
        return sum(w * impact(found[t], norm) for t, w in item if t in found)

    def scan(self, ids: list, texts: list[bytes]) -> None:
        """``ids``: doc_ids, a null one comes after all others."""
        s = sketches(texts, self.n_docs, self.n_terms)
        bound = s @ self.weights
        if len(bound) and bound.max() >= 2.0 ** 52:  # beyond this sums may be rounded
            bound = np.ceil(bound * (1 + 1e-12))
        key = np.array([-math.inf if d is None else -d for d in ids], object)
        order_key = np.argsort(np.argsort([math.inf if d is None else d for d in ids], kind="stable"))
        counts: dict[int, tuple[Counter, int]] = {}
        for i, item in enumerate(self.items):
            heap, b = self.best[i], bound[:, i]
            at = np.flatnonzero(b >= heap[0][0] if len(heap) == LIMIT else b > 0)
            for d in at[np.lexsort((order_key[at], -b[at]))].tolist():
                if len(heap) == LIMIT and (b[d], key[d]) <= heap[0]:
                    if b[d] < heap[0][0]:
                        break       # neither this one nor any after it
                    continue        # equal bound, later id
                if d not in counts:
                    all_terms = TERM.findall(texts[d].lower())
                    counts[d] = (Counter(t for t in all_terms if t in self.vocabulary), length_norm(len(all_terms), self.n_docs, self.n_terms))
                score = self._score(item, *counts[d])
                self.rescored += 1
                if score <= 0:
                    continue
                if len(heap) < LIMIT:
                    heapq.heappush(heap, (score, key[d]))
                elif (score, key[d]) > heap[0]:
                    heapq.heapreplace(heap, (score, key[d]))


def _statistics(docs: DataFrame, vocabulary: set[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """Documents with a term, all their terms, and documents holding each term
    of ``vocabulary`` (the terms of one pass)."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known, df, n_docs, n_terms = sent.value, Counter(), 0, 0
        for batch in batches:
            for _, _, texts in slices(batch.column(0)):
                for t in texts:
                    found = terms(t)
                    n_docs += bool(found)
                    n_terms += len(found)
                    df.update(known.intersection(found))
        yield pa.record_batch([pa.array([None, *df], pa.binary()), pa.array([n_docs, *df.values()], pa.int64()),
                               pa.array([n_terms] + [0] * len(df), pa.int64())], names=["term", "n", "size"])

    rows = docs.select("text").mapInArrow(run, "term binary, n long, size long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("size").alias("size")).collect()
    sent.unpersist()
    total = [(r.n, r.size) for r in rows if r.term is None] or [(0, 0)]
    return *total[0], {bytes(r.term): r.n for r in rows if r.term is not None}


def rank(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ten documents with the highest
    score above 0 of every item, ties by smaller doc_id (null last).

    Items are the distinct (item_id, text) rows, searched in passes of about
    ITEMS items and ITEM_BYTES of text, each over all documents; an item
    with null or empty text, or none of whose terms occurs, has no rows. Repeated documents
    are ranked row by row; null and empty documents are in no ranking. A text is
    read whole in one task. Empty tables give no rows; further columns are ignored."""
    spark = docs.sparkSession
    items = items.select("item_id", "text").where("text IS NOT NULL").distinct()
    n, size = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    passes = max(-(-n // ITEMS), -(-(size or 0) // ITEM_BYTES))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    kind = items.schema["item_id"].dataType
    out = spark.createDataFrame([], f"item_id {kind.simpleString()}, item int, doc_id long, score long")
    for k in range(passes):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).orderBy("item_id", "text").collect()
        found = [sorted(set(terms(r.text))) for r in mine]
        n_docs, n_terms, df = _statistics(d, {t for f in found for t in f})
        weighted = [[(t, weight(n_docs, df[t])) for t in f if t in df] for f in found]
        names = [r.item_id for r in mine]
        if any(weighted):
            out = out.unionByName(_one_pass(d, names, weighted, n_docs, n_terms, kind))
    w = Window.partitionBy("item_id", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= LIMIT)
            .select("item_id", "rank", "doc_id", "score"))


def _one_pass(docs: DataFrame, names: list, weighted: list, n_docs: int, n_terms: int, kind) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    sent = docs.sparkSession.sparkContext.broadcast((names, weighted))
    arrow = to_arrow_type(kind)

    def run(batches):
        names, weighted = sent.value
        search = Search(weighted, n_docs, n_terms)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, j, texts in slices(batch.column(1)):
                for a in range(0, j - i, DOCS):
                    part = texts[a: a + DOCS]
                    search.scan(ids[i + a: i + a + len(part)], [t.encode("utf-8", "surrogatepass") for t in part])
        rows = [(names[i], i, None if k == -math.inf else -k, s) for i, heap in enumerate(search.best) for s, k in heap]
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, (arrow, pa.int32(), pa.int64(), pa.int64()))],
                              names=["item_id", "item", "doc_id", "score"])

    return docs.mapInArrow(run, f"item_id {kind.simpleString()}, item int, doc_id long, score long")


def op11_max_sketch(spark, sf_dir: str) -> DataFrame:
    """Ten best documents for every benchmark item."""
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, t, len(t) AS n FROM (SELECT doc_id, {_TERMS} AS t FROM documents WHERE text IS NOT NULL) WHERE len(t) > 0),
     s AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM d),
     q AS (SELECT DISTINCT item_id, text, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL),
     p AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, n, unnest(t) AS term FROM d)
           WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, n, term),
     f AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term), s),
     c AS (SELECT q.item_id, q.text, p.r, any_value(p.doc_id) AS doc_id,
                  sum(f.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * p.n * s.nd) // s.nt))))::BIGINT AS score
           FROM q JOIN p ON q.term = p.term JOIN f ON f.term = p.term, s GROUP BY q.item_id, q.text, p.r),
     o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank, doc_id, score FROM c WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= {LIMIT}"""
