"""Trees of a search that are grown together equal trees grown one by one, and move shared rows once."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.ml import search as SE
from wardflow.ml import trees as T

SPECS = [{"leaf": leaf, "impurity": kind} for leaf in (1, 2, 5, 10) for kind in ("gini", "entropy")]


def test_grown_together_as_one_by_one():
    r = np.random.default_rng(2)
    y = (r.random(3000) < 0.3).astype(int)
    x = np.stack([r.integers(0, 2, 3000), np.clip(r.integers(0, 20, 3000) + 6 * y, 0, 31), r.integers(0, 32, 3000), np.zeros(3000, int)], 1).astype("uint8")
    bins = [2, 32, 32, 1]
    for spec, got in zip(SPECS, T.grow_many(x, y, 2, SPECS, 12, bins)):
        want = T.grow(x, y, np.ones(3000), 2, spec | {"depth": 12, "bins": bins, "subset": 4, "seed": 1})
        for d in (2, 3, 5, 8, 12):
            a, b = T.walk(got, x, d), T.walk(want, x, d)
            assert np.array_equal(got["pos"][a], want["pos"][b]) and np.array_equal(got["neg"][a], want["neg"][b])
        assert (got["feature"] >= 0).sum() == (want["feature"] >= 0).sum() and got["mixed"][0] == want["mixed"][0]


@pytest.mark.parametrize("group_rows", [150, 10_000])
def test_fold_scores_as_of_single_fits(spark, monkeypatch, group_rows):
    r = random.Random(4)
    rows = []
    for k in range(1500):
        y = float(r.random() < 0.35)
        rows.append((k % 3, y + r.gauss(0, 1), float(r.randint(0, 5) + y), r.random() if r.random() < 0.9 else None, y))
    folded = spark.createDataFrame(rows, "fold int, a double, b double, c double, label double").repartition(3).cache()
    features, depths = ["a", "b", "c"], [0, 1, 3, 6, 30]
    monkeypatch.setattr(T, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(T, "PASS_NODES", 3)
    jobs = [(leaf, kind, 1) for leaf in (1, 5) for kind in ("gini", "entropy")]
    fits = []
    monkeypatch.setattr(T, "fit_trees", lambda *a, fit=T.fit_trees: fits.append(a) or fit(*a))
    got = SE._large_trees(folded, features, depths, jobs, 2)
    assert not fits  # before: a fit and a join of the held-out rows per (leaf size, impurity, fold)
    train, held = folded.where("fold <> 1"), folded.where("fold = 1")
    ready = T.binned(train, features)
    for (leaf, kind, _), scores in zip(jobs, got):
        long = T.fit_trees(*ready, features, 30, leaf, kind).probabilities(held, depths).select(
            F.col("label").cast("int").alias("y"), F.posexplode("__p").alias("depth", "p"))
        want = {x.depth: x.score for x in SE.score_groups(long, ["depth"]).collect()}
        assert scores == pytest.approx([want[i] for i in range(len(depths))], abs=1e-12)


def test_a_forest_counts_only_the_features_that_nodes_drew(monkeypatch):
    r = np.random.default_rng(6)
    y = (r.random(2000) < 0.4).astype(int)
    x = np.concatenate([r.integers(0, 2, (2000, 14)), r.integers(0, 32, (2000, 6))], 1).astype("uint8")
    x[:, 0] |= y.astype("uint8")
    w = r.poisson(1, 2000).astype("float64")
    calls = []
    monkeypatch.setattr(T.np, "bincount", lambda *a, count=np.bincount, **k: calls.append(1) or count(*a, **k))
    spec = {"leaf": 1, "impurity": "gini", "depth": 9, "bins": [2] * 14 + [32] * 6, "subset": 5, "seed": 1}
    t = T.grow(x, y, w, 0, spec, 3)
    assert len(calls) <= 5 * 9  # before: two for every feature that some node of the level drew
    at = T.walk(t, x)
    assert np.array_equal(np.bincount(at, w * y, len(t["pos"])), np.where(t["feature"] < 0, t["pos"], 0))
