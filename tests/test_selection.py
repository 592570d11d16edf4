"""k-th values by narrowing histograms, and parts by hash order, against sorting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wardflow.operators import selection as S


@pytest.fixture(scope="module")
def values(spark):
    r = random.Random(6)
    a = [r.lognormvariate(0, 4) for _ in range(4000)] + [0.0] * 900 + [-3.5] * 10
    b = [r.choice([1e308, -1e308, 5e-324, 0.0, 1.0, math.nextafter(1.0, 2)]) for _ in range(len(a))]
    rows = [(x, y if i % 3 else None, float(i % 7), None) for i, (x, y) in enumerate(zip(a, b))]
    rows += [(float("inf"), float("nan"), 1.0, None), (float("-inf"), float("nan"), 2.0, None)]
    return spark.createDataFrame(rows, "a double, b double, c double, empty double").repartition(5)


def order(v):
    return (1, 0.0) if math.isnan(v) else (0, v)


def test_every_kind_of_rank(values):
    rows = values.collect()
    wanted = lambda n: [*range(-1, 40), n // 3, n // 2, n - 2, n - 1, n]
    found = S.kth_values(values, {c: wanted for c in ("a", "b", "c", "empty")})
    for c in ("a", "b", "c", "empty"):
        v = sorted((r[c] for r in rows if r[c] is not None), key=order)
        n, at = found[c]
        assert n == len(v) and set(at) == {k for k in wanted(n) if 0 <= k < n}
        for k, (value, below) in at.items():
            assert order(value) == order(v[k]) and below == sum(order(x) < order(v[k]) for x in v)


def test_no_sort_and_no_row_shuffle(values):
    q = S.quantiles(values.select("c"), {"m": ("c", 0.5), "p": ("c", 0.99)})
    v = sorted(r.c for r in values.select("c").collect())
    h = (len(v) - 1) * 0.99
    assert q["m"] == v[(len(v) - 1) // 2] or (len(v) - 1) % 2 and q["m"] == pytest.approx((v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2)
    assert q["p"] == pytest.approx(v[int(h)] + (v[math.ceil(h)] - v[int(h)]) * (h - int(h)))
    assert S.quantiles(values.select("empty"), {"x": ("empty", 0.5)}) == {"x": None}


def test_parts_have_exact_sizes_and_follow_the_hash(spark):
    d = spark.range(5003).select(F.col("id").alias("key"), F.when(F.col("id") % 9 > 5, 1).when(F.col("id") % 9 == 5, None).otherwise(0).alias("label"))
    ends = lambda n: [0, n // 7, n // 2, n, n + 5]
    out = S.hash_parts(d, "label", "key", 3, ends)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.withColumn("h", F.xxhash64("key", F.lit(3))).collect()
    for label in (0, 1, None):
        mine = sorted((r.h, r.key, r._part) for r in rows if r.label == label)
        for i, (_, _, part) in enumerate(mine):
            assert part == sum(i >= e for e in ends(len(mine)))


def test_rows_of_equal_key_stay_together(spark):
    d = spark.createDataFrame([(k, 1) for k in (1, 2, 3) for _ in range(50)], "key long, label int")
    parts = {(r.key, r._part) for r in S.hash_parts(d, "label", "key", 1, lambda n: [n // 2]).collect()}
    assert len(parts) == 3
