"""Trees and forests whose nodes stay with the rows, for tables where a tree has too many nodes for the driver.

Spark's learner keeps every node on the driver, and a tree of full depth has about
one node per three rows. Here nodes of more than :data:`GROUP_ROWS` rows are
split by jobs over all rows (a histogram per partition and node, added up per
node), so the driver holds a number of nodes that follows the rows divided by
GROUP_ROWS. The rows of each smaller node are shuffled together, and a task
grows the rest below it; these subtrees are rows of a stored table.

Growth follows Spark's learner: at most 32 bins per feature with thresholds from a
sample of about 10,000 rows, the split of largest gain (first feature, first bin among
equals), all rows counted, and subtrees whose leaves agree on the class merged.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.session import materialize

BINS = 32
GROUP_ROWS = 25_000
SAMPLE_ROWS = 10_000
MOST_TASKS = 4000
PASS_NODES = 512  # nodes counted in one pass over the rows
NEVER = 1 << 20  # "mixed" of a node whose leaves all have one class
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def thresholds(df: DataFrame, features: Sequence[str], n: int, seed: int) -> list[list[float]]:
    """Per feature at most 31 split points, chosen from a sample as Spark does."""
    rows = df.select(*[F.col(f"`{f}`").cast("double").alias(f"f{i}") for i, f in enumerate(features)])
    if n > SAMPLE_ROWS:
        rows = rows.sample(False, SAMPLE_ROWS / n, seed)
    sample = np.array([tuple(np.nan if v is None else v for v in r) for r in rows.collect()], "float64").reshape(-1, len(features))
    out = []
    for f in range(len(features)):
        v, counts = np.unique(sample[:, f][np.isfinite(sample[:, f])], return_counts=True)
        middle = (v[:-1] + v[1:]) / 2
        if len(middle) >= BINS:
            stride = counts.sum() / BINS
            target, upto, chosen = stride, np.cumsum(counts), []
            for i in range(1, len(v)):
                if abs(upto[i - 1] - target) < abs(upto[i] - target):
                    chosen.append(middle[i - 1])
                    target += stride
            middle = np.array(chosen[:BINS - 1])
        out.append([float(x) for x in middle])
    return out


def _coder(cuts: list[list[float]]):
    """Feature array -> one byte per feature: the number of split points below the value."""
    @F.pandas_udf("binary")
    def code(x: pd.Series) -> pd.Series:
        m = np.array([np.asarray(r, "float64") for r in x]).reshape(len(x), len(cuts))
        b = np.empty(m.shape, "uint8")
        for f, c in enumerate(cuts):
            b[:, f] = np.searchsorted(c, m[:, f])
        return pd.Series([r.tobytes() for r in b])
    return code


def _with_bins(df: DataFrame, features: Sequence[str], cuts: list[list[float]]) -> DataFrame:
    x = F.array(*[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(float("nan"))) for f in features])
    return df.withColumn("__bins", _coder(cuts)(x))


def _matrix(bins: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bins), "uint8").reshape(len(bins), -1)


def _weights(u: np.ndarray, tree: int, bootstrap: bool) -> np.ndarray:
    """Times a tree sees each row: 1, or drawn from Poisson(1) by the row's stored random number."""
    if not bootstrap:
        return np.ones(len(u))
    with np.errstate(over="ignore"):
        z = u.astype("uint64") + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
        for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(mul)
        z ^= z >> np.uint64(31)
    return np.searchsorted(_POISSON, (z >> np.uint64(11)) / 2.0**53).astype("float64")


def _impurity(neg: np.ndarray, n: np.ndarray, kind: str) -> np.ndarray:
    p = neg / np.maximum(n, 1)
    if kind == "gini":
        return 2 * p * (1 - p)
    q = np.array([p, 1 - p])
    return -(q * np.log2(np.where(q > 0, q, 1))).sum(0)


def _best(hist0: np.ndarray, hist1: np.ndarray, spec: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per row of (nodes, bins) counts of one feature: gain, bin, and both counts left of the split."""
    l0, l1 = hist0.cumsum(1), hist1.cumsum(1)
    t0, t1 = l0[:, -1:], l1[:, -1:]
    n, nl = t0 + t1, l0 + l1
    nr = n - nl
    gain = _impurity(t0, n, spec["impurity"]) - (nl * _impurity(l0, nl, spec["impurity"]) + nr * _impurity(t0 - l0, nr, spec["impurity"])) / np.maximum(n, 1)
    gain[(nl < spec["leaf"]) | (nr < spec["leaf"]) | (nl == 0) | (nr == 0)] = 0
    at = gain.argmax(1)
    i = np.arange(len(at))
    return gain[i, at], at, l0[i, at], l1[i, at]


def _subset(spec: dict, n_features: int, *where: int) -> np.ndarray:
    """The features a node may split on, drawn per node where the forest asks for fewer."""
    if spec["subset"] >= n_features:
        return np.arange(n_features)
    return np.sort(np.random.default_rng([spec["seed"], *where]).choice(n_features, spec["subset"], replace=False))


def _mixed(feature, left, right, neg, pos, level, below=None) -> list[int]:
    """Per node: the least depth limit at which its leaves differ in class. ``below``
    gives it for nodes that are grown elsewhere."""
    out = [NEVER] * len(feature)
    for i in range(len(feature) - 1, -1, -1):  # children come after their parent
        if feature[i] >= 0:
            a, b = left[i], right[i]
            out[i] = level[i] + 1 if (pos[a] > neg[a]) != (pos[b] > neg[b]) else min(out[a], out[b])
        elif below:
            out[i] = below.get(i, NEVER)
    return out


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, level: int, spec: dict, *where: int) -> dict[str, np.ndarray]:
    """The subtree over the given rows (bytes per feature, label, weight), grown level
    by level; its root is at ``level`` of the whole tree."""
    cols, bins = np.ascontiguousarray(x.T), spec["bins"]
    w0, w1 = w * (1 - y), w * y
    feature, cut, left, right, gain = [-1], [0], [-1], [-1], [0.0]
    neg, pos, depth = [w0.sum()], [w1.sum()], [level]
    node, active = np.zeros(len(y), "int64"), [0] if level < spec["depth"] and neg[0] and pos[0] else []
    while active:
        k, ids = len(active), np.array(active)
        slot = np.full(len(feature), -1)
        slot[ids] = np.arange(k)
        rows = np.flatnonzero(slot[node] >= 0)
        s = slot[node[rows]]
        best = np.full((4, k), 0.0)
        by = np.full(k, -1)
        if spec["subset"] < len(cols):
            # Only the features that each row's node has drawn are looked at.
            order = np.random.default_rng([spec["seed"], *where, level]).random((k, len(cols))).argsort(1)
            drawn = np.sort(order[:, :spec["subset"]], 1)
            size = np.array(bins)[drawn]
            start = (np.cumsum(size) - size.ravel()).reshape(size.shape)
            h, target, weight = np.zeros(2 * int(size.sum())), y[rows].astype("int64"), w[rows]
            for c in range(drawn.shape[1]):
                h += np.bincount((start[s, c] + cols[drawn[s, c], rows]) * 2 + target, weight, len(h))
            each = np.zeros((4, *drawn.shape))
            for n in np.unique(size):
                at = np.nonzero(size == n)
                part = h.reshape(-1, 2)[start[at][:, None] + np.arange(n)]
                each[:, at[0], at[1]] = _best(part[:, :, 0], part[:, :, 1], spec)
            for c in range(drawn.shape[1]):
                better = each[0, :, c] > best[0] + 1e-12
                best[:, better], by[better] = each[:, better, c], drawn[better, c]
        else:
            for f in range(len(cols)):
                code = s * bins[f] + cols[f, rows]
                h0, h1 = (np.bincount(code, c[rows], k * bins[f]).reshape(-1, bins[f]) for c in (w0, w1))
                found = np.array(_best(h0, h1, spec))
                better = found[0] > best[0] + 1e-12
                best[:, better] = found[:, better]
                by[better] = f
        active, go = [], np.full(k, -1)
        for i in np.flatnonzero(by >= 0):
            p = ids[i]
            feature[p], cut[p], gain[p] = int(by[i]), int(best[1, i]), best[0, i] * (neg[p] + pos[p])
            left[p], right[p], go[i] = len(feature), len(feature) + 1, len(feature)
            for a, b in ((best[2, i], best[3, i]), (neg[p] - best[2, i], pos[p] - best[3, i])):
                if a and b and level + 1 < spec["depth"]:
                    active.append(len(feature))
                for col, v in ((feature, -1), (cut, 0), (left, -1), (right, -1), (gain, 0.0), (neg, a), (pos, b), (depth, level + 1)):
                    col.append(v)
        rows, s = rows[by[s] >= 0], s[by[s] >= 0]
        node[rows] = go[s] + (cols[by[s], rows] > best[1, s])
        level += 1
    mixed = _mixed(feature, left, right, neg, pos, depth)
    return {"feature": np.array(feature, "int32"), "cut": np.array(cut, "int32"), "left": np.array(left, "int32"), "right": np.array(right, "int32"),
            "level": np.array(depth, "int32"), "mixed": np.array(mixed, "int32"), "neg": np.array(neg, "float64"), "pos": np.array(pos, "float64"),
            "gain": np.array(gain, "float64")}


def walk(t: dict[str, np.ndarray], x: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Node that each row ends in; with ``depth`` the one that scores it in the tree cut there."""
    node = np.zeros(len(x), "int64")
    rows = np.arange(len(x))
    while len(rows):
        at = node[rows]
        more = t["feature"][at] >= 0
        if depth is not None:
            more &= (t["level"][at] < depth) & (t["mixed"][at] <= depth)
        rows, at = rows[more], at[more]
        node[rows] = np.where(x[rows, t["feature"][at]] <= t["cut"][at], t["left"][at], t["right"][at])
    return node


_INT, _FLOAT = ("feature", "cut", "left", "right", "level", "mixed"), ("neg", "pos", "gain")
_SUBTREE = "g int, " + ", ".join(f"{c} binary" for c in (*_INT, *_FLOAT)) + ", n0 double, n1 double, lowest int, kept int, deepest int, importance array<double>"


def _unpack(row) -> dict[str, np.ndarray]:
    return {c: np.frombuffer(row[c], "int32" if c in _INT else "float64") for c in (*_INT, *_FLOAT)}


def _arrays(tops: list[dict]) -> list[dict[str, np.ndarray]]:
    return [{c: np.array(v, "int64" if c in _INT or c == "g" else "float64") for c, v in t.items()} for t in tops]


class PartitionedTrees:
    """A fitted tree (or the mean of several): ``tops``, the nodes above the
    groups, held here; ``subtrees``, a stored row per group."""

    def __init__(self, features, cuts, spec, tops, subtrees, n_groups, depth, numNodes, importances):
        self.features, self.cuts, self.spec, self.tops = list(features), cuts, spec, tops
        self.subtrees, self.n_groups, self.depth, self.numNodes = subtrees, n_groups, depth, numNodes
        self.featureImportances = DenseVector(importances)
        self.stages = [self]

    def probabilities(self, df: DataFrame, depths: Sequence[int]) -> DataFrame:
        """``df`` with ``__p``: per depth limit the probability of class 1."""
        depths, tops = list(depths), self.tops
        stored = materialize(_with_bins(df, self.features, self.cuts).withColumn("__row", F.monotonically_increasing_id()), "to-score")

        def place(batches):
            trees = _arrays(tops)
            for b in batches:
                x = _matrix(b["__bins"])
                for t in trees:
                    g = t["g"][walk(t, x)]
                    p = np.empty((len(x), len(depths)))
                    for j, d in enumerate(depths):
                        at = walk(t, x, d)
                        p[:, j] = np.where((t["g"][at] >= 0) & (t["level"][at] < d) & (t["mixed"][at] <= d), np.nan, t["pos"][at] / np.maximum(t["neg"][at] + t["pos"][at], 1))
                    g[~np.isnan(p).any(1)] = -1  # scored above the groups at every depth
                    yield pd.DataFrame({"row": b["__row"], "g": g.astype("int32"), "bins": b["__bins"], "p": list(p)})

        def below(key, rows, tree):
            if not len(rows) or not len(tree):
                return rows.iloc[:0][["row", "p"]]
            t, x, p = _unpack(tree.iloc[0]), _matrix(rows["bins"]), np.array(rows["p"].tolist())
            for j, d in enumerate(depths):
                at = walk(t, x, d)
                p[:, j] = np.where(np.isnan(p[:, j]), t["pos"][at] / (t["neg"][at] + t["pos"][at]), p[:, j])
            return pd.DataFrame({"row": rows["row"], "p": list(p)})

        at = stored.select("__row", "__bins").mapInPandas(place, "row long, g int, bins binary, p array<double>")
        scored = at.where("g < 0").select("row", "p")
        if self.n_groups:
            # A group's rows to score are dealt over as many tasks as their number asks for.
            parts = max(1, -(-stored.count() * len(tops) // (self.n_groups * GROUP_ROWS)))
            trees = self.subtrees.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
            inside = at.where("g >= 0").withColumn("part", F.pmod("row", F.lit(parts)).cast("int"))
            scored = scored.unionByName(inside.groupBy("g", "part").cogroup(trees.groupBy("g", "part")).applyInPandas(below, "row long, p array<double>"))
        mean = scored.groupBy("row").agg(F.array(*[F.avg(F.col("p")[j]) for j in range(len(depths))]).alias("__p"))
        return stored.drop("__bins").join(mean, F.col("__row") == F.col("row")).drop("__row", "row")

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.probabilities(df, [self.spec["depth"]])
        return out.withColumns({"probability_1": F.col("__p")[0], "prediction": (F.col("__p")[0] > 0.5).cast("double")}).drop("__p")

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.subtrees.write.mode("overwrite").parquet(f"{path}/subtrees")
        rest = {"features": self.features, "cuts": self.cuts, "spec": self.spec, "tops": self.tops, "n_groups": self.n_groups, "depth": self.depth,
                "numNodes": self.numNodes, "importances": list(self.featureImportances.toArray())}
        spark.createDataFrame([(json.dumps(rest),)], "model string").coalesce(1).write.mode("overwrite").parquet(f"{path}/top")

    @staticmethod
    def load(spark: SparkSession, path: str) -> PartitionedTrees:
        return PartitionedTrees(subtrees=spark.read.parquet(f"{path}/subtrees"), **json.loads(spark.read.parquet(f"{path}/top").first().model))


def binned(df: DataFrame, features: Sequence[str], label: str = "label", seed: int = 42) -> tuple[list[list[float]], DataFrame]:
    """Split points, and the stored rows as label, random number and a byte per
    feature: what several fits on the same rows share."""
    cuts = thresholds(df, features, df.count(), seed)
    rows = _with_bins(df, features, cuts)
    return cuts, materialize(rows.select(F.col(label).cast("int").alias("y"), (F.rand(seed) * 2**53).cast("long").alias("u"), F.col("__bins").alias("bins")), "binned")


def fit_trees(cuts: list[list[float]], rows: DataFrame, features: Sequence[str], depth: int, leaf: int = 1, impurity: str = "gini", trees: int = 1,
              seed: int = 42) -> PartitionedTrees:
    """Fit one tree on all features, or a forest (bootstrap rows, about the root of
    their number of features per node), on :func:`binned` rows with a 0/1 label."""
    features, n_features = list(features), len(features)
    spec = {"depth": depth, "leaf": leaf, "impurity": impurity, "seed": seed, "bootstrap": trees > 1,
            "subset": math.ceil(math.sqrt(n_features)) if trees > 1 else n_features}
    spec["bins"] = [len(c) + 1 for c in cuts]
    tops = [{c: [v] for c, v in (("feature", -1), ("cut", 0), ("left", -1), ("right", -1), ("level", 0), ("neg", 0.0), ("pos", 0.0), ("gain", 0.0))} for _ in range(trees)]
    todo = [(t, 0) for t in range(trees)]
    while todo:
        now, chunk, todo = {}, todo[:PASS_NODES], todo[PASS_NODES:]
        for t, i in chunk:
            now.setdefault(t, []).append(i)

        def count(batches, now=now, tops=tops):
            flat = {t: _arrays([tops[t]])[0] for t in now}
            hist = {t: np.zeros((len(ids), n_features, BINS, 2)) for t, ids in now.items()}
            use = {t: np.array([_subset(spec, n_features, t, i) for i in ids]) for t, ids in now.items()}
            for b in batches:
                x, y, u = _matrix(b["bins"]), b["y"].to_numpy(), b["u"].to_numpy()
                for t, ids in now.items():
                    slot = np.full(len(flat[t]["feature"]), -1)
                    slot[ids] = np.arange(len(ids))
                    at, w = slot[walk(flat[t], x)], _weights(u, t, spec["bootstrap"])
                    r = np.flatnonzero(at >= 0)
                    if spec["subset"] < n_features:
                        for c in range(spec["subset"]):
                            f = use[t][at[r], c]
                            code = ((at[r] * n_features + f) * BINS + x[r, f]) * 2 + y[r]
                            hist[t] += np.bincount(code, w[r], hist[t].size).reshape(hist[t].shape)
                        continue
                    for f in range(n_features):
                        code = (at[r] * BINS + x[r, f]) * 2 + y[r]
                        hist[t][:, f] += np.bincount(code, w[r], len(ids) * BINS * 2).reshape(len(ids), BINS, 2)
            for t, ids in now.items():
                for i, h in zip(ids, hist[t]):
                    if h.any():
                        yield pd.DataFrame({"tree": [t], "node": [i], "h": [h.tobytes()]})

        def choose(key, parts):
            h = sum(np.frombuffer(b, "float64") for b in parts["h"]).reshape(n_features, BINS, 2)
            use = _subset(spec, n_features, *map(int, key))
            gain, at, l0, l1 = _best(h[use, :, 0], h[use, :, 1], spec)
            j = int(gain.argmax())
            total = h[use[0]].sum(0)
            return pd.DataFrame([(int(key[0]), int(key[1]), int(use[j]) if gain[j] > 1e-12 else -1, int(at[j]), float(gain[j]), total[0], total[1], l0[j], l1[j])],
                                columns=["tree", "node", "feature", "cut", "gain", "neg", "pos", "l0", "l1"])

        found = rows.mapInPandas(count, "tree int, node int, h binary").groupBy("tree", "node").applyInPandas(
            choose, "tree int, node int, feature int, cut int, gain double, neg double, pos double, l0 double, l1 double").collect()
        for r in sorted(found, key=lambda r: (r.tree, r.node)):
            t = tops[r.tree]
            t["neg"][r.node], t["pos"][r.node] = r.neg, r.pos
            if r.feature < 0 or t["level"][r.node] >= depth or (r.node == 0 and r.neg + r.pos <= GROUP_ROWS):
                continue
            t["feature"][r.node], t["cut"][r.node], t["gain"][r.node] = r.feature, r.cut, r.gain * (r.neg + r.pos)
            for side, a, b in (("left", r.l0, r.l1), ("right", r.neg - r.l0, r.pos - r.l1)):
                i = len(t["feature"])
                t[side][r.node] = i
                for c, v in (("feature", -1), ("cut", 0), ("left", -1), ("right", -1), ("level", t["level"][r.node] + 1), ("neg", a), ("pos", b), ("gain", 0.0)):
                    t[c].append(v)
                if a + b > GROUP_ROWS and a and b and t["level"][i] < depth:
                    todo.append((r.tree, i))
    groups = []  # (tree, node): small nodes of both classes, grown where their rows meet
    for t, top in enumerate(tops):
        top["g"] = [-1] * len(top["feature"])
        for i in range(len(top["feature"])):
            if top["feature"][i] < 0 and top["neg"][i] and top["pos"][i] and top["neg"][i] + top["pos"][i] <= GROUP_ROWS and top["level"][i] < depth:
                top["g"][i] = len(groups)
                groups.append((t, i, top["level"][i]))

    def deal(batches):
        flat = _arrays(tops)
        for b in batches:
            x, u = _matrix(b["bins"]), b["u"].to_numpy()
            for t, top in enumerate(flat):
                g, w = top["g"][walk(top, x)], _weights(u, t, spec["bootstrap"])
                r = np.flatnonzero((g >= 0) & (w > 0))
                yield pd.DataFrame({"g": g[r].astype("int32"), "y": b["y"].to_numpy()[r], "w": w[r], "bins": b["bins"].to_numpy()[r]})

    def finish(key, part):
        g = int(key[0])
        t = grow(_matrix(part["bins"]), part["y"].to_numpy(), part["w"].to_numpy(), groups[g][2], spec, g)
        inner = (t["feature"] >= 0) & (t["mixed"] <= depth)
        importance = np.bincount(t["feature"][inner], t["gain"][inner], n_features)
        return pd.DataFrame([{"g": g, **{c: t[c].tobytes() for c in (*_INT, *_FLOAT)}, "n0": t["neg"][0], "n1": t["pos"][0], "lowest": int(t["mixed"][0]),
                              "kept": int(inner.sum()), "deepest": int(t["level"][inner].max()) + 1 if inner.any() else 0, "importance": importance}])

    # A stated number of partitions: groups are small but take time, so they are not to be put together.
    dealt = rows.mapInPandas(deal, "g int, y int, w double, bins binary").repartition(min(max(len(groups), 1), MOST_TASKS), "g")
    grown = dealt.groupBy("g").applyInPandas(finish, _SUBTREE)
    subtrees = materialize(grown, "subtrees")
    found = subtrees.select("g", "lowest", "kept", "deepest", "importance").collect()  # a short row per group
    lowest = {groups[r.g][:2]: r.lowest for r in found}
    importance, inner, deepest = np.zeros((trees, n_features)), sum(r.kept for r in found), max([r.deepest for r in found], default=0)
    for r in found:
        importance[groups[r.g][0]] += r.importance
    for t, top in enumerate(tops):
        top["mixed"] = _mixed(*[top[c] for c in ("feature", "left", "right", "neg", "pos", "level")], {i: m for (k, i), m in lowest.items() if k == t})
        for i, f in enumerate(top["feature"]):
            if f >= 0 and top["mixed"][i] <= depth:
                importance[t, f] += top["gain"][i]
                inner += 1
                deepest = max(deepest, top["level"][i] + 1)
    total = importance.sum(1, keepdims=True)
    mean = np.where(total > 0, importance / np.where(total > 0, total, 1), 0).sum(0)
    return PartitionedTrees(features, cuts, spec, tops, subtrees, len(groups), deepest, 2 * inner + trees, [float(v) for v in mean / (mean.sum() or 1)])


def _levels_mixed(t: dict[str, np.ndarray]) -> np.ndarray:
    """What :func:`_mixed` gives, for a tree whose children lie one level below their parents."""
    out = np.full(len(t["feature"]), NEVER)
    split, one = t["feature"] >= 0, t["pos"] > t["neg"]
    for level in np.unique(t["level"][split])[::-1]:
        i = np.flatnonzero(split & (t["level"] == level))
        a, b = t["left"][i], t["right"][i]
        out[i] = np.where(one[a] != one[b], level + 1, np.minimum(out[a], out[b]))
    return out


def grow_many(x: np.ndarray, y: np.ndarray, level: int, specs: Sequence[dict], depth: int, bins: Sequence[int]) -> list[dict[str, np.ndarray]]:
    """The trees that :func:`grow` gives for every (leaf size, impurity) of ``specs`` over the same rows, all
    features, weight 1. Trees that have split alike so far share their nodes, and a node is counted once for all of them."""
    cols, y, many = np.ascontiguousarray(x.T), y.astype("int64"), len(specs)
    leaves = {kind: [j for j, s in enumerate(specs) if s["impurity"] == kind] for kind in {s["impurity"] for s in specs}}
    # Features of two values are counted together, a row at a time.
    two = [f for f, b in enumerate(bins) if b == 2]
    is_flag, flags = {f: i for i, f in enumerate(two)}, np.ascontiguousarray(x[:, two]).astype("uint16" if len(y) < 1 << 16 else "uint32")
    neg, pos = np.array([(y == 0).sum()], "float64"), np.array([(y == 1).sum()], "float64")
    has, r, slot, done = np.ones((1, many), bool), np.arange(len(y)), np.zeros(len(y), "int64"), []
    first = 0  # number of the level's first node
    while len(neg):
        n, node = len(neg), {c: np.full((len(neg), many), v) for c, v in (("feature", -1), ("cut", 0), ("left", -1))}
        done.append((neg, pos, np.full(n, level), node))
        ids = np.flatnonzero((neg > 0) & (pos > 0)) if level < depth else np.zeros(0, "int64")
        k, place = len(ids), np.full(n, -1)
        place[ids] = np.arange(k)
        slot = place[slot]
        r, slot = r[slot >= 0], slot[slot >= 0]
        best = np.zeros((4, k, many))
        by = np.full((k, many), -1)
        target = y[r]
        ones = _ones(flags, r, slot * 2 + target, 2 * k).reshape(k, 2, len(two))
        some = {kind: np.flatnonzero(has[ids][:, which].any(1)) for kind, which in leaves.items()}
        total = np.stack([neg[ids], pos[ids]], 1)
        of_flags = {}
        for kind, at in some.items():
            right0, right1 = ones[at, 0].astype("float64"), ones[at, 1].astype("float64")
            l0, l1 = total[at, :1] - right0, total[at, 1:] - right1
            of_flags[kind] = (l0, l1, *_gain(l0, l1, total[at, :1], total[at, 1:], kind))
        for f in range(len(cols) if k else 0):
            flag = is_flag.get(f)
            if flag is None:
                h = np.bincount((slot * bins[f] + cols[f, r]) * 2 + target, minlength=k * bins[f] * 2).reshape(k, bins[f], 2).astype("float64")
            for kind, which in leaves.items():
                at, least_of = some[kind], [max(specs[j]["leaf"], 1) for j in which]
                if flag is None:
                    l0, l1 = h[at, :, 0].cumsum(1), h[at, :, 1].cumsum(1)
                    gain, least = _gain(l0, l1, l0[:, -1:], l1[:, -1:], kind)
                    i = np.arange(len(at))
                    for j, leaf in zip(which, least_of):
                        allowed = np.where(least < leaf, 0, gain)
                        cut = allowed.argmax(1)
                        found = allowed[i, cut]
                        q = np.flatnonzero(found > best[0, at, j] + 1e-12)
                        best[:, at[q], j] = found[q], cut[q], l0[q, cut[q]], l1[q, cut[q]]
                        by[at[q], j] = f
                else:
                    l0, l1, gain, least = (v[:, flag] for v in of_flags[kind])
                    for j, leaf in zip(which, least_of):
                        q = np.flatnonzero((gain > best[0, at, j] + 1e-12) & (least >= leaf))
                        best[0, at[q], j], best[1, at[q], j], best[2, at[q], j], best[3, at[q], j] = gain[q], 0, l0[q], l1[q]
                        by[at[q], j] = f
        by[~has[ids]] = -1
        choice = np.where(by >= 0, by * 256 + best[1].astype("int64"), -1)
        like = (choice[:, :, None] == choice[:, None, :]).argmax(2)  # the first that splits alike
        own = (like == np.arange(many)) & (choice >= 0)
        at, j = np.nonzero(own)  # a pair of children each, by node
        number = np.full((k, many), -1)
        number[at, j] = np.arange(len(at))
        pair = np.where(choice >= 0, np.take_along_axis(number, like, 1), -1)
        node["feature"][ids], node["cut"][ids] = by, np.where(by >= 0, best[1], 0)
        node["left"][ids] = np.where(pair >= 0, first + n + 2 * pair, -1)
        of = own.sum(1)  # pairs of a node, from ``start``
        start = np.cumsum(of) - of
        again = np.repeat(np.arange(len(r)), of[slot])
        to = np.arange(len(again)) - np.repeat(np.cumsum(of[slot]) - of[slot], of[slot]) + start[slot[again]]
        r = r[again]
        slot = 2 * to + (cols[by[at, j][to], r] > best[1, at, j][to])
        has = np.repeat(pair[at] == np.arange(len(at))[:, None], 2, axis=0)
        l0, l1, total0, total1 = best[2, at, j], best[3, at, j], neg[ids][at], pos[ids][at]
        neg, pos = np.stack([l0, total0 - l0], 1).ravel(), np.stack([l1, total1 - l1], 1).ravel()
        first, level = first + n, level + 1
    neg, pos, depths = (np.concatenate([d[i] for d in done]) for i in range(3))
    out = []
    for j in range(many):
        t = {c: np.concatenate([d[3][c][:, j] for d in done]) for c in ("feature", "cut", "left")}
        t |= {"right": np.where(t["left"] >= 0, t["left"] + 1, -1), "level": depths, "neg": neg, "pos": pos}
        out.append(t | {"mixed": _levels_mixed(t)})
    return out


def _ones(flags: np.ndarray, r: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Per group the sums of its rows of 0/1 columns."""
    out = np.zeros((groups, flags.shape[1]), flags.dtype)
    if len(r) and flags.shape[1]:
        by = np.argsort(group, kind="stable")
        ends = np.searchsorted(group[by], np.arange(groups + 1))
        there = np.flatnonzero(ends[1:] > ends[:-1])
        out[there] = np.add.reduceat(flags[r[by]], ends[there], axis=0, dtype=flags.dtype)
    return out


def _gain(l0: np.ndarray, l1: np.ndarray, t0: np.ndarray, t1: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Gains as in :func:`_best` from the counts left of each cut, and the rows of the smaller side."""
    n, nl = t0 + t1, l0 + l1
    nr = n - nl
    gain = _impurity(t0, n, kind) - (nl * _impurity(l0, nl, kind) + nr * _impurity(t0 - l0, nr, kind)) / np.maximum(n, 1)
    return gain, np.minimum(nl, nr)


def _new_tops(trees: int) -> list[dict]:
    return [{c: [v] for c, v in (("feature", -1), ("cut", 0), ("left", -1), ("right", -1), ("level", 0), ("neg", 0.0), ("pos", 0.0), ("gain", 0.0))} for _ in range(trees)]


def score_many(rows: DataFrame, cuts: list[list[float]], features: Sequence[str], depths: Sequence[int], specs: Sequence[dict]) -> DataFrame:
    """``spec, depth, p, neg, pos``: held-out rows by the score they get from the tree of every (leaf size, impurity) of
    ``specs``, fitted on the other rows and cut at every depth. ``rows``: y, held, bins (:func:`_with_bins`). Nodes
    that several trees share are counted and their rows are moved once."""
    n_features, many, deepest, bins = len(features), len(specs), max(depths), [len(c) + 1 for c in cuts]
    tops, group_rows = _new_tops(many), GROUP_ROWS
    todo = {(): [(j, 0) for j in range(many)]}  # splits on the way to a node -> where the trees have it
    while todo:
        paths = list(todo)[:PASS_NODES]
        now = [todo.pop(p) for p in paths]
        lead: dict[int, list[tuple[int, int]]] = {}
        for q, at in enumerate(now):
            lead.setdefault(at[0][0], []).append((at[0][1], q))

        def count(batches, lead=lead, tops=tops, size=len(now)):
            flat, hist = {t: _arrays([tops[t]])[0] for t in lead}, {}
            for b in batches:
                b = b[~b["held"]]
                x, y = _matrix(b["bins"]) if len(b) else np.zeros((0, n_features), "uint8"), b["y"].to_numpy().astype("int64")
                for t, nodes in lead.items():
                    slot = np.full(len(flat[t]["feature"]), -1)
                    slot[[i for i, _ in nodes]] = np.arange(len(nodes))
                    at = slot[walk(flat[t], x)]
                    r = np.flatnonzero(at >= 0)
                    at, target, h = at[r], y[r], hist.setdefault(t, np.zeros((len(nodes), n_features, BINS, 2), "int64"))
                    for f in range(n_features):
                        h[:, f] += np.bincount((at * BINS + x[r, f]) * 2 + target, minlength=len(nodes) * BINS * 2).reshape(len(nodes), BINS, 2)
            for t, h in hist.items():
                for (_, q), one in zip(lead[t], h):
                    if one.any():
                        yield pd.DataFrame({"path": [q], "h": [one.tobytes()]})

        def choose(key, parts):
            h = sum(np.frombuffer(b, "int64") for b in parts["h"]).reshape(n_features, BINS, 2).astype("float64")
            out, total = [], h[0].sum(0)
            for j, _ in now[int(key[0])]:
                gain, at, l0, l1 = _best(h[:, :, 0].copy(), h[:, :, 1].copy(), specs[j])
                f = int(gain.argmax())
                out.append((int(key[0]), j, f if gain[f] > 1e-12 else -1, int(at[f]), total[0], total[1], l0[f], l1[f]))
            return pd.DataFrame(out, columns=["path", "spec", "feature", "cut", "neg", "pos", "l0", "l1"])

        found = rows.mapInPandas(count, "path int, h binary").groupBy("path").applyInPandas(
            choose, "path int, spec int, feature int, cut int, neg double, pos double, l0 double, l1 double").collect()
        for c in sorted(found, key=lambda c: (c.path, c.spec)):
            t, i = tops[c.spec], dict(now[c.path])[c.spec]
            t["neg"][i], t["pos"][i] = c.neg, c.pos
            if c.feature < 0 or t["level"][i] >= deepest or (i == 0 and c.neg + c.pos <= group_rows):
                continue
            t["feature"][i], t["cut"][i] = c.feature, c.cut
            for side, a, b in (("left", c.l0, c.l1), ("right", c.neg - c.l0, c.pos - c.l1)):
                n = len(t["feature"])
                t[side][i] = n
                for col, v in (("feature", -1), ("cut", 0), ("left", -1), ("right", -1), ("level", t["level"][i] + 1), ("neg", a), ("pos", b), ("gain", 0.0)):
                    t[col].append(v)
                if a + b > group_rows and a and b and t["level"][n] < deepest:
                    todo.setdefault((*paths[c.path], (c.feature, c.cut, side)), []).append((c.spec, n))
    groups: dict[tuple, list[tuple[int, int]]] = {}
    for j, t in enumerate(tops):
        way = {0: ()}
        for i, f in enumerate(t["feature"]):
            for side in ("left", "right") if f >= 0 else ():
                way[t[side][i]] = (*way[i], (f, t["cut"][i], side))
            if f < 0 and t["neg"][i] and t["pos"][i] and t["neg"][i] + t["pos"][i] <= group_rows and t["level"][i] < deepest:
                groups.setdefault(way[i], []).append((j, i))
    for t in tops:
        t["g"] = [-1] * len(t["feature"])
    members = list(groups.values())
    for g, at in enumerate(members):
        tops[at[0][0]]["g"][at[0][1]] = g  # the first of its trees deals the rows

    def deal(batches):
        flat = [t for t in _arrays(tops) if (t["g"] >= 0).any()]
        for b in batches:
            x = _matrix(b["bins"]) if len(b) else np.zeros((0, n_features), "uint8")
            for t in flat:
                g = t["g"][walk(t, x)]
                r = np.flatnonzero(g >= 0)
                yield pd.DataFrame({"g": g[r].astype("int32"), "y": b["y"].to_numpy()[r], "held": b["held"].to_numpy()[r], "bins": b["bins"].to_numpy()[r]})

    def finish(key, part):
        g = int(key[0])
        x, y, held, level = _matrix(part["bins"]), part["y"].to_numpy(), part["held"].to_numpy(), tops[members[g][0][0]]["level"][members[g][0][1]]
        out = []
        for (j, _), t in zip(members[g], grow_many(x[~held], y[~held], level, [specs[j] for j, _ in members[g]], deepest, bins)):
            lowest, counted = int(t["mixed"][0]), ([], [], [], [])
            for k, d in enumerate(depths):
                if level < d and lowest <= d and held.any():  # else a node above scores these rows
                    at = walk(t, x[held], d)
                    p, which = np.unique(t["pos"][at] / (t["neg"][at] + t["pos"][at]), return_inverse=True)
                    n = np.bincount(which * 2 + y[held], minlength=2 * len(p)).reshape(-1, 2)
                    for c, v in zip(counted, (np.full(len(p), k), p, n[:, 0], n[:, 1])):
                        c.append(v)
            kinds = ("int32", "float64", "int64", "int64")
            out.append((g, j, lowest, *[np.concatenate(c).astype(kind) if c else np.zeros(0, kind) for c, kind in zip(counted, kinds)]))
        return pd.DataFrame(out, columns=["g", "spec", "lowest", "depth", "p", "neg", "pos"])

    def ends(batches):
        """Held-out rows by the node above the groups that they end in."""
        flat, n = _arrays(tops), [np.zeros((len(t["feature"]), 2), "int64") for t in tops]
        for b in batches:
            b = b[b["held"]]
            if len(b):
                x, y = _matrix(b["bins"]), b["y"].to_numpy()
                for t, seen in zip(flat, n):
                    seen += np.bincount(walk(t, x) * 2 + y, minlength=seen.size).reshape(seen.shape)
        for j, seen in enumerate(n):
            i = np.flatnonzero(seen.any(1))
            yield pd.DataFrame({"spec": np.full(len(i), j, "int32"), "node": i.astype("int32"), "neg": seen[i, 0], "pos": seen[i, 1]})

    spark = rows.sparkSession
    dealt = rows.mapInPandas(deal, "g int, y int, held boolean, bins binary").repartition(min(max(len(groups), 1), MOST_TASKS), "g")
    grown = materialize(dealt.groupBy("g").applyInPandas(finish, "g int, spec int, lowest int, depth array<int>, p array<double>, neg array<long>, pos array<long>"), "grown")
    lowest = {(c.spec, dict(members[c.g])[c.spec]): c.lowest for c in grown.select("g", "spec", "lowest").collect()}
    above = []
    mixed = [_mixed(*[t[c] for c in ("feature", "left", "right", "neg", "pos", "level")], {i: m for (k, i), m in lowest.items() if k == j}) for j, t in enumerate(tops)]
    for c in rows.mapInPandas(ends, "spec int, node int, neg long, pos long").groupBy("spec", "node").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).collect():
        t, way = tops[c.spec], [c.node]
        parent = {b: i for i in range(len(t["feature"])) if t["feature"][i] >= 0 for b in (t["left"][i], t["right"][i])} if c.node else {}
        while way[-1]:
            way.append(parent[way[-1]])
        for k, d in enumerate(depths):
            i = next(i for i in way[::-1] if i == c.node or t["level"][i] >= d or mixed[c.spec][i] > d)
            if not ((c.spec, i) in lowest and t["level"][i] < d and mixed[c.spec][i] <= d):  # those are counted in the group
                above.append((c.spec, k, t["pos"][i] / max(t["neg"][i] + t["pos"][i], 1), c.neg, c.pos))
    inside = grown.select("spec", F.explode(F.arrays_zip("depth", "p", "neg", "pos")).alias("c")).select("spec", "c.*")
    return inside.unionByName(spark.createDataFrame(above, "spec int, depth int, p double, neg long, pos long"))


def binned_for_search(df: DataFrame, features: Sequence[str], held: str, label: str = "label", seed: int = 42) -> tuple[DataFrame, list[list[float]]]:
    """Stored rows as label, whether ``held`` is true, and bins by the split points of the other rows."""
    train = df.where(f"not ({held})")
    cuts = thresholds(train, features, train.count(), seed)
    rows = _with_bins(df, features, cuts)
    return materialize(rows.select(F.col(label).cast("int").alias("y"), F.expr(held).alias("held"), F.col("__bins").alias("bins")), "binned"), cuts
