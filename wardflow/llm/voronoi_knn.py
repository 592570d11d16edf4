"""Exact top-k inner products by a Voronoi join.

Vectors are quantised to integers, so scores are exact. Data vectors are
grouped by their nearest pivot; every group is summarised by its pivot, radius
and largest norm, and cut into blocks of bounded size. Queries are grouped the
same way. From the summaries each query gets a score that at least k
candidates reach; a data block goes only to those query groups of which some
query may find a better score in it. Each (query group, block) pair is solved
on its own and the survivors are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import table
from wardflow.session import materialize

PIVOTS = 1024         # bound on the pivots, so on the groups; 1024 x dim numbers are broadcast
BLOCK_ROWS = 2048     # vectors in one block; about as many groups as blocks, up to the bound
QUERY_ROWS = 256      # queries in one block
LEAST = 8             # groups of a small table, so that the bounds are at work there too


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component; vectors that are null
    or hold null or non-finite components, and null ids, are left out."""
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return (vectors.where(x.isNotNull() & F.col("vec_id").isNotNull()).where(fine)
            .select("vec_id", F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v")))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in column])


def _nearest(m: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and distance to the nearest pivot."""
    d = (m * m).sum(1)[:, None] - 2.0 * (m @ pivots.T) + (pivots * pivots).sum(1)[None]
    g = d.argmin(1)
    return g, np.sqrt(np.maximum(((m - pivots[g]) ** 2).sum(1), 0))


def group_count(rows: int, bound: int = PIVOTS) -> int:
    """Groups for ``rows`` vectors: one for every ``BLOCK_ROWS``, ``LEAST`` at least."""
    return min(bound, rows, max(LEAST, math.ceil(rows / BLOCK_ROWS)))


def top_k(vectors: DataFrame, k: int, is_query, pivots: int = PIVOTS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every query's k highest inner
    products with all other vectors, ties to the smaller id.

    ``vectors``: (vec_id, v) as from :func:`quantised`; ``is_query``: a Column
    over it. Shorter vectors count as filled with zeros. Fewer candidates than
    k give fewer rows; an empty table gives none; of repeated (vec_id, v) rows
    one takes part, and ids with several vectors take part with each of them
    (never against themselves); equal vectors of many ids are kept with their
    k + 1 smallest ids only, since no other can be in a result."""
    spark = vectors.sparkSession
    vectors = materialize(vectors.select("vec_id", "v", is_query.alias("q")).distinct(), "llm-vectors")
    rows, dim = vectors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = group_count(rows, pivots)
    vectors = vectors.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("v"))))
    # Equal vectors: the k + 1 smallest ids (one may be the query's own).
    # Ranked in id ranges first, so that a third of all rows sharing one
    # vector is spread over tasks.
    part = Window.partitionBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(256))).orderBy("vec_id")
    data = vectors.withColumn("r", F.row_number().over(part)).where(F.col("r") <= k + 1)
    data = data.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    data = data.select("vec_id", "v")
    # Pivots: a bounded sample by id hash.
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").select("v").limit(pivots).toPandas()
    centres = np.unique(_matrix(sample["v"]).astype(np.float64), axis=0)
    sent = spark.sparkContext.broadcast(centres)  # at most ``pivots`` vectors

    def group(batches):
        for pdf in batches:
            if len(pdf):
                g, d = _nearest(_matrix(pdf["v"]).astype(np.float64), sent.value)
                yield pdf.assign(g=g.astype(np.int32), d=d)

    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        m = _matrix(pdf["v"])
        return pd.DataFrame({"g": [int(key[0])], "block": [int(key[1])], "n": [len(pdf)], "radius": [float(pdf["d"].max())],
                             "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()], "m": [m.tobytes()]})

    def packed(df: DataFrame, rows: int, label: str) -> DataFrame:
        """Blocks of about ``rows`` vectors of one group."""
        d = df.mapInPandas(group, "vec_id long, v array<long>, g int, d double")
        d = materialize(d, f"llm-{label}")
        n = d.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("parts"))
        d = d.join(F.broadcast(n), "g")  # one row per pivot
        d = d.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
        return materialize(d.groupBy("g", "b").applyInPandas(
            lambda key, pdf: pack(key, pdf), "g int, block int, n long, radius double, ids binary, m binary"), f"llm-{label}-blocks")

    blocks = packed(data, BLOCK_ROWS, "data")
    queries = packed(vectors.where("q").select("vec_id", "v"), QUERY_ROWS, "queries")
    # One row per pivot: members and radius.
    summary = blocks.groupBy("g").agg(F.sum("n").alias("n"), F.max("radius").alias("r")).orderBy("g").toPandas()
    sum_g, sum_n, sum_r = (summary[c].to_numpy() for c in ("g", "n", "r"))

    def needed(batches):
        """The data groups every query block needs, with each query's floor."""
        p = sent.value[sum_g]
        for pdf in batches:
            for row in pdf.itertuples():
                q = np.frombuffer(row.m, np.int64).reshape(-1, dim).astype(np.float64)
                at, norm = q @ p.T, np.sqrt((q * q).sum(1))[:, None]
                low, high = at - norm * sum_r, at + norm * sum_r
                order = np.argsort(-low, axis=1)
                reach = np.cumsum(sum_n[order], axis=1) >= k + 1  # the query itself may be among them
                first = np.where(reach.any(1), reach.argmax(1), len(sum_g) - 1)
                floor = np.where(reach.any(1), np.take_along_axis(low, order, 1)[np.arange(len(q)), first], -np.inf)
                floor = np.where(np.isfinite(floor), np.floor(floor - 1e-6 * np.abs(floor) - 1), -np.inf)
                use = (high + 1e-6 * np.abs(high) + 1 >= floor[:, None]).any(0)
                yield pd.DataFrame({"qg": row.g, "qb": row.block, "g": sum_g[use].astype(np.int32),
                                    "q_ids": row.ids, "q_m": row.m, "floor": floor.tobytes()})

    def solve(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                q = np.frombuffer(row.q_m, np.int64).reshape(-1, dim)
                x = np.frombuffer(row.m, np.int64).reshape(-1, dim)
                q_ids, ids = np.frombuffer(row.q_ids, np.int64), np.frombuffer(row.ids, np.int64)
                small = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * dim < 2.0 ** 53
                s = (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64) if small else q @ x.T
                ok = (s >= np.frombuffer(row.floor, np.float64)[:, None]) & (q_ids[:, None] != ids[None])
                out = []
                for i in np.flatnonzero(ok.any(1)):
                    j = np.flatnonzero(ok[i])
                    j = j[np.lexsort((ids[j], -s[i, j]))[:k]]
                    out.append(pd.DataFrame({"query_id": q_ids[i], "vec_id": ids[j], "score": s[i, j]}))
                if out:
                    yield pd.concat(out, ignore_index=True)

    need = materialize(queries.mapInPandas(needed, "qg int, qb int, g int, q_ids binary, q_m binary, floor binary"), "llm-need")
    pairs = need.join(blocks.select("g", "ids", "m"), "g")
    found = pairs.repartition(F.col("qg"), F.col("qb"), F.xxhash64("ids")).mapInPandas(solve, "query_id long, vec_id long, score long")
    # Equal ids cannot meet twice: every vector is in one block.
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op4_voronoi_knn(spark, sf_dir: str) -> DataFrame:
    """The 20 highest scores of every vector whose id is divisible by 20."""
    v = quantised(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return top_k(v, 20, F.col("vec_id") % 20 == 0)


SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT::DOUBLE) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score FROM e q JOIN e d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""
