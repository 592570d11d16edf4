"""Logistic regression over tables too large for Spark's learner, several fits at once.

Spark's learner keeps a copy of the scaled rows in memory for every fit and reads it
once per step of a first-order solver. Here the rows are stored once, packed as one
binary value each, and a pass over them adds up loss, gradient and second
derivatives of all fits (folds, parts, penalties) together; the driver holds these
sums, a square matrix of the features per fit, and takes a Newton step.

Objective as in Spark's learner: the mean logistic loss of the standardised inputs
(sample deviation of the fit's own rows) plus regParam * (a * |w| + (1 - a) / 2 * w^2),
the intercept free. It is solved to its minimum, where Spark's solver stops at a tolerance.
"""

from __future__ import annotations

import json
import math
from collections.abc import Collection, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.session import materialize

PASSES = 100    # most passes over the rows; a fit takes about ten
SETTLED = 1e-6  # a step that promises less than this share of the loss is the last one
SWEEPS = 1000   # most rounds of coordinate descent in a step with an absolute penalty


@dataclass(frozen=True)
class Fit:
    """One fit: the tags of the rows it is fitted on, and its penalty; a ``C`` stands for
    regParam = 1 / (C * rows)."""

    tags: frozenset[int]
    regParam: float = 0.0
    elasticNetParam: float = 0.0
    C: float | None = None


class LogisticModel:
    """Fitted coefficients; scores a row by one expression, so in batches and in streams."""

    def __init__(self, features, coefficients, intercept, mean, std):
        self.features, self.intercept = list(features), float(intercept)
        self.coefficients = DenseVector(coefficients)  # of the standardised inputs
        self.mean, self.std = [float(v) for v in mean], [float(v) for v in std]
        self.stages = [self]

    def plain(self) -> tuple[list[float], float]:
        """Coefficients and intercept for the inputs as they are."""
        w = [c / s if s > 0 else 0.0 for c, s in zip(self.coefficients.toArray().tolist(), self.std)]
        return w, self.intercept - math.fsum(a * m for a, m in zip(w, self.mean))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``rawPrediction`` (log odds), ``probability_1`` and ``prediction``; a missing input gives no number."""
        w, b = self.plain()
        margin = F.lit(b)
        for c, v in zip(self.features, w):
            margin = margin + F.col(f"`{c}`").cast("double") * F.lit(v)
        out = df.withColumn("rawPrediction", F.coalesce(margin, F.lit(float("nan"))))  # one missing input leaves no sum
        return out.withColumns({"probability_1": 1 / (1 + F.exp(-F.col("rawPrediction"))), "prediction": (F.col("rawPrediction") > 0).cast("double")})

    def save(self, path: str) -> None:
        rest = {"features": self.features, "coefficients": list(self.coefficients.toArray()), "intercept": self.intercept, "mean": self.mean, "std": self.std}
        SparkSession.active().createDataFrame([(json.dumps(rest),)], "model string").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LogisticModel:
        return LogisticModel(**json.loads(spark.read.parquet(path).first().model))


def pack(df: DataFrame, features: Sequence[str], label: str = "label", tag: str | None = None) -> DataFrame:
    """The stored rows as ``tag``, ``y`` and ``x``, the features as one binary value."""
    n = len(features)
    rows = df.select((F.col(f"`{tag}`") if tag else F.lit(0)).cast("int").alias("tag"), F.col(f"`{label}`").cast("double").alias("y"),
                     *[F.col(f"`{f}`").cast("double").alias(f"f{i}") for i, f in enumerate(features)])

    def run(batches):
        for b in batches:
            # A missing value is read as NaN.
            x = np.column_stack([b.column(i + 2).to_numpy(zero_copy_only=False) for i in range(n)])
            at = pa.py_buffer(np.arange(len(x) + 1, dtype="int32") * (8 * n))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.Array.from_buffers(pa.binary(), len(x), [None, at, pa.py_buffer(x.tobytes())])],
                                             ["tag", "y", "x"])

    return materialize(rows.mapInArrow(run, "tag int, y double, x binary"), "packed")


def _by_tag(batch, n: int):
    """(tag, y, x) of a packed batch, tag by tag."""
    tags, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    v = batch.column(2)
    at = np.frombuffer(v.buffers()[1], "int32")[v.offset:v.offset + len(v) + 1]
    x = np.frombuffer(v.buffers()[2], "float64", (at[-1] - at[0]) // 8, at[0]).reshape(-1, n)
    for t in np.unique(tags):
        r = tags == t
        yield int(t), y[r], x[r]


def _sums(packed: DataFrame, run, width: int) -> dict[int, np.ndarray]:
    """Sums over all rows per key: ``run`` gives (key, array of ``width`` numbers) once a partition.
    Parts are added in the order of their partitions, so that reruns agree."""
    def part(batches):
        p = TaskContext.get().partitionId()
        found = run(batches)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([p] * len(found), pa.int32()),
                                          pa.array([v.tobytes() for _, v in found], pa.binary())], ["k", "p", "v"])

    def total(key, parts):
        parts = parts.sort_values("p")
        out = np.zeros(width)
        for v in parts["v"]:
            out += np.frombuffer(v)
        return parts.iloc[:1].assign(v=[out.tobytes()])[["k", "v"]]

    rows = packed.mapInArrow(part, "k int, p int, v binary").groupBy("k").applyInPandas(total, "k int, v binary").collect()
    return {r.k: np.frombuffer(r.v) for r in rows}


def _moments(packed: DataFrame, n: int) -> dict[int, tuple[float, float, np.ndarray, np.ndarray]]:
    """Per tag: rows, positives, mean and sum of squared deviations per feature."""
    first = packed.select("x").first()
    if first is None:
        return {}
    shift = np.nan_to_num(np.frombuffer(first.x))  # sums are taken around a row's values

    def run(batches):
        out: dict[int, np.ndarray] = {}
        for b in batches:
            for t, y, x in _by_tag(b, n) if b.num_rows else ():
                x = x - shift
                out[t] = out.get(t, 0) + np.concatenate([[len(y), y.sum()], x.sum(0), (x * x).sum(0)])
        return list(out.items())

    found = _sums(packed, run, 2 + 2 * n)
    return {t: (v[0], v[1], shift + v[2:2 + n] / v[0], v[2 + n:] - v[2:2 + n] ** 2 / v[0]) for t, v in found.items()}


def _merged(parts: Collection[tuple]) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Rows, positives, mean and sample deviation of the rows of several tags."""
    rows, pos = sum(p[0] for p in parts), sum(p[1] for p in parts)
    mean = sum(p[0] * p[2] for p in parts) / rows
    squares = sum(np.maximum(p[3], 0) + p[0] * (p[2] - mean) ** 2 for p in parts)
    std = np.sqrt(squares / max(rows - 1, 1))
    return rows, pos, mean, np.where(std > 1e-12 * np.maximum(np.abs(mean), 1), std, 0)


def _step(u: np.ndarray, g: np.ndarray, h: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """Minimum of the quadratic model at ``u`` (weights, then intercept) plus penalties, as a step.
    ``g`` and ``h`` are of the loss alone."""
    ridge = np.append(np.full(len(u) - 1, l2), 0.0)
    g, h = g + ridge * u, h + np.diag(ridge)
    scale, q = np.linalg.eigh(h)
    floor = max(scale[-1], 1e-300) * 1e-15
    best = -(q / np.maximum(scale, floor)) @ np.where(scale > floor, q.T @ g, 0)
    if not l1:
        return best
    d, hd, diagonal = np.zeros(len(u)), np.zeros(len(u)), h.diagonal()
    for _ in range(SWEEPS):
        most = 0.0
        for j in range(len(u)):
            if diagonal[j] <= floor:
                continue
            slope = g[j] + hd[j] - diagonal[j] * (u[j] + d[j])
            to = -slope / diagonal[j] if j == len(u) - 1 else -math.copysign(max(abs(slope) - l1, 0.0), slope) / diagonal[j]
            move = to - u[j] - d[j]
            if move:
                d[j] += move
                hd += h[:, j] * move
                most = max(most, abs(move))
        if most < 1e-9:
            break
    return d


def fit_logistic(packed: DataFrame, features: Sequence[str], fits: Sequence[Fit]) -> list[LogisticModel]:
    """The models of all ``fits`` on :func:`pack`-ed rows with a 0/1 label and finite features."""
    n = len(features)
    moments = _moments(packed, n)
    own = [_merged([moments[t] for t in f.tags if t in moments]) for f in fits]
    _, _, mean, std = _merged(list(moments.values()))
    if not np.isfinite(np.append(mean, std)).all():
        raise ValueError("Features hold values that are no finite numbers")
    base = np.where(std > 0, std, 1)
    state = []
    for f, (rows, pos, m, s) in zip(fits, own):
        # From the fit's own standardised coordinates to the common ones of a pass.
        t = np.eye(n + 1)
        inverse = np.where(s > 0, 1 / np.where(s > 0, s, 1), 0)
        t[np.arange(n), np.arange(n)] = base * inverse
        t[n, :n] = (mean - m) * inverse
        reg = 1 / (f.C * rows) if f.C is not None else f.regParam
        u = np.zeros(n + 1)
        u[n] = math.log(pos / (rows - pos)) if 0 < pos < rows else math.copysign(math.inf, pos - 0.5)
        state.append({"u": u, "t": t, "rows": rows, "l1": reg * f.elasticNetParam, "l2": reg * (1 - f.elasticNetParam), "was": math.inf, "step": None})
    active = [i for i, s in enumerate(state) if np.isfinite(s["u"]).all()]  # one class alone: no weights
    width = 1 + (n + 1) + (n + 1) ** 2
    for _ in range(PASSES):
        if not active:
            break
        theta = np.column_stack([state[i]["t"] @ state[i]["u"] for i in active])
        uses = {t: [k for k, i in enumerate(active) if t in fits[i].tags] for t in moments}

        def run(batches, theta=theta, uses=uses, mean=mean, base=base):
            loss, grad, hess = np.zeros(theta.shape[1]), np.zeros(theta.shape), np.zeros((theta.shape[1], n + 1, n + 1))
            for b in batches:
                for t, y, x in _by_tag(b, n) if b.num_rows else ():
                    if not uses[t]:
                        continue
                    z = np.ones((len(y), n + 1))
                    np.divide(x - mean, base, out=z[:, :n])
                    margin = z @ theta[:, uses[t]]
                    e = np.exp(-np.abs(margin))
                    p = np.where(margin >= 0, 1, e) / (1 + e)
                    loss[uses[t]] += (np.log1p(e) + np.maximum(margin, 0) - margin * y[:, None]).sum(0)
                    grad[:, uses[t]] += z.T @ (p - y[:, None])
                    root = np.sqrt(p * (1 - p))
                    for c, k in enumerate(uses[t]):
                        a = z * root[:, c:c + 1]
                        hess[k] += a.T @ a
            return [(k, np.concatenate([[loss[k]], grad[:, k], hess[k].ravel()])) for k in range(theta.shape[1])]

        sums = _sums(packed, run, width)
        going = []
        for k, i in enumerate(active):
            s, v = state[i], sums[k]
            w = s["u"][:n]
            now = v[0] / s["rows"] + s["l1"] * np.abs(w).sum() + s["l2"] / 2 * (w @ w)
            if s["step"] is not None and now > s["was"] + 1e-12 * abs(s["was"]):  # too far: half the step
                s["step"] = s["step"] / 2
                s["u"] = s["from"] + s["step"]
                if np.abs(s["step"]).max() > 1e-12:
                    going.append(i)
                continue
            g = s["t"].T @ v[1:n + 2] / s["rows"]
            h = s["t"].T @ v[n + 2:].reshape(n + 1, n + 1) @ s["t"] / s["rows"]
            step = _step(s["u"], g, h, s["l1"], s["l2"])
            to = w + step[:n]
            gain = -(g @ step + step @ h @ step / 2 + s["l1"] * (np.abs(to).sum() - np.abs(w).sum()) + s["l2"] / 2 * (to @ to - w @ w))
            s["was"], s["from"], s["step"], s["u"] = now, s["u"], step, s["u"] + step
            if gain > SETTLED * now:
                going.append(i)
        active = going
    return [LogisticModel(features, np.where(d > 0, s["u"][:n], 0), s["u"][n], m, d) for s, (_, _, m, d) in zip(state, own)]


def score_packed(packed: DataFrame, models: Sequence[Sequence[LogisticModel]]) -> DataFrame:
    """``candidate, fold, y, p`` of packed rows: a row of tag f is scored by the models of ``models[f]``."""
    plain = [[m.plain() for m in ms] for ms in models]
    n = len(models[0][0].features)

    def run(batches):
        for b in batches:
            for t, y, x in _by_tag(b, n) if b.num_rows else ():
                w, c = np.array([v for v, _ in plain[t]]).T, np.array([v for _, v in plain[t]])
                with np.errstate(over="ignore"):
                    p = 1 / (1 + np.exp(-(x @ w + c)))
                k = p.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(k, dtype="int32"), len(y))), pa.array(np.full(len(y) * k, t, "int32")),
                                                  pa.array(np.repeat(y, k).astype("int32")), pa.array(p.ravel())], ["candidate", "fold", "y", "p"])

    return packed.mapInArrow(run, "candidate int, fold int, y int, p double")
