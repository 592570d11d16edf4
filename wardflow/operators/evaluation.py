"""Classifier evaluation maths over rows of (label, prediction, score).

Ranking metrics (ROC-AUC with tie averaging, average precision, curve
points) are computed from the *distinct scores* with a two-level prefix sum,
so no step orders all rows (or all distinct scores) in one task:

1. ``groupBy(group, score)`` counts positives / negatives, and the outcomes of
   the predictions, with a map-side combine: the only look at the rows;
2. :func:`running_counts` stores these counts and turns them into counts
   strictly below each score;
3. one aggregate over them gives all metrics of a group at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.prefix import running_counts

INF = float("inf")


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (the zero_division=0 convention)."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion_counts(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Tn, fp, fn, tp in one aggregate (per group when ``by``)."""
    yc, pc = F.col(y), F.col(pred)
    aggs = [F.count_if((yc == 0) & (pc == 0)).alias("tn"), F.count_if((yc == 0) & (pc == 1)).alias("fp"),
            F.count_if((yc == 1) & (pc == 0)).alias("fn"), F.count_if((yc == 1) & (pc == 1)).alias("tp")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def rates_from_counts(c: DataFrame) -> DataFrame:
    """E2-E4 from tn/fp/fn/tp: accuracy, precision, recall, F1, sensitivity,
    specificity, PPV, NPV (0 on empty denominators), NNS and likelihood
    ratios (infinity on a zero denominator)."""
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    precision = _div0(tp, tp + fp)
    recall = _div0(tp, tp + fn)
    spec = _div0(tn, tn + fp)
    return c.select(
        "*",
        _div0(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _div0(2 * precision * recall, precision + recall).alias("f1"),
        recall.alias("sensitivity"),
        spec.alias("specificity"),
        precision.alias("ppv"),
        _div0(tn, tn + fn).alias("npv"),
        F.when(precision > 0, 1.0 / precision).otherwise(F.lit(INF)).alias("nns"),
        F.when(spec < 1, recall / (1.0 - spec)).otherwise(F.lit(INF)).alias("lr_positive"),
        F.when(spec > 0, (1.0 - recall) / spec).otherwise(F.lit(INF)).alias("lr_negative"),
    )


OUTCOMES = ("tn", "fp", "fn", "tp")


def score_counts(df: DataFrame, by: Sequence[str], y: str = "y", p: str = "p", pred: str | None = None) -> DataFrame:
    """A row per (group, distinct score): ``pos``, ``neg`` and, with ``pred``, the
    numbers of tn, fp, fn, tp among its rows."""
    yc = F.col(y)
    aggs = [F.sum(yc).cast("long").alias("pos"), (F.count(F.lit(1)) - F.sum(yc)).cast("long").alias("neg")]
    if pred:
        aggs += [F.count_if((yc == int(o in ("fn", "tp"))) & (F.col(pred) == int(o in ("fp", "tp")))).alias(o) for o in OUTCOMES]
    return df.groupBy(*by, p).agg(*aggs)


def score_prefix(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Per (group, distinct score): pos, neg, pos_below, neg_below (counts
    with a strictly lower score) and group totals total_pos, total_neg."""
    return running_counts(score_counts(df, by, y, p), p, ["pos", "neg"], by)


def _auc() -> Column:
    """ROC-AUC over the rows of :func:`score_prefix` (Mann-Whitney, ties count
    one half); null with one class."""
    pos, neg = F.first("total_pos"), F.first("total_neg")
    return F.when((pos > 0) & (neg > 0), F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))) / (pos * neg))


def _average_precision() -> Column:
    """Sum over thresholds (distinct scores, descending) of (recall gain) x
    precision; null without positives."""
    tp = F.col("total_pos") - F.col("pos_below")
    k = tp + F.col("total_neg") - F.col("neg_below")
    return F.when(F.first("total_pos") > 0, F.sum(F.col("pos") * tp / k) / F.first("total_pos"))


def _brier(p: str) -> Column:
    """Mean squared difference of score and label over (score, pos, neg) rows."""
    known = F.col(p).isNotNull()
    return F.sum(F.when(known, F.col("pos") * F.pow(F.col(p) - 1, 2) + F.col("neg") * F.pow(F.col(p), 2))) / F.sum(F.when(known, F.col("pos") + F.col("neg")))


def roc_auc(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC-AUC; null when a group has only one class."""
    return score_prefix(df, y, p, by).groupBy(*by).agg(_auc().alias("roc_auc"))


def roc_auc_of_counts(counts: DataFrame, by: Sequence[str], p: str = "p") -> DataFrame:
    """The same from one row per (group, score) with its ``pos`` and ``neg``."""
    return running_counts(counts, p, ["pos", "neg"], by).groupBy(*by).agg(_auc().alias("roc_auc"))


def average_precision(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Step-wise average precision; null without positives."""
    return score_prefix(df, y, p, by).groupBy(*by).agg(_average_precision().alias("pr_auc"))


def curve_points(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score used as threshold (score >= t):
    tp, fp, tpr, fpr, precision, recall."""
    sp = score_prefix(df, y, p, by)
    tp = F.col("total_pos") - F.col("pos_below")
    fp = F.col("total_neg") - F.col("neg_below")
    return sp.select(*by, F.col(p).alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                     F.try_divide(tp, F.col("total_pos")).alias("tpr"),
                     F.try_divide(fp, F.col("total_neg")).alias("fpr"),
                     F.try_divide(tp, tp + fp).alias("precision"),
                     F.try_divide(tp, F.col("total_pos")).alias("recall"))


def brier(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Mean squared difference of score and label."""
    return df.agg(F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier_score"))


def clinical_metrics(df: DataFrame, y: str = "y", pred: str = "pred", p: str = "p",
                     model: str = "Model", with_pr_auc: bool = False) -> DataFrame:
    """E8 (and E9 with PR-AUC): one row with counts, rates, ROC-AUC, Brier, all
    from one ranking: the rows are read once."""
    ranked = running_counts(score_counts(df, (), y, p, pred), p, ["pos", "neg"], carry=OUTCOMES)
    ranking = {"roc_auc": _auc(), "brier_score": _brier(p)} | ({"pr_auc": _average_precision()} if with_pr_auc else {})
    row = ranked.agg(*[F.coalesce(F.sum(o), F.lit(0)).alias(o) for o in OUTCOMES], *[v.alias(k) for k, v in ranking.items()])
    out = rates_from_counts(row)
    rates = [c for c in out.columns if c not in ranking]
    return out.select(F.lit(model).alias("model"), *rates, *ranking)


def interior_edges(n_bins: int) -> list[float]:
    """Interior edges of n equal bins on [0, 1], bit-equal to i * (1 / n)."""
    step = 1.0 / n_bins
    return [i * step for i in range(1, n_bins)]


def _bin_id(p: Column, n_bins: int) -> Column:
    """0-based bin: number of interior edges strictly below p (right-closed
    bins; p = 0 falls in the first bin)."""
    edges = F.array(*[F.lit(e) for e in interior_edges(n_bins)])
    return F.size(F.filter(edges, lambda e: e < p))


def calibration_curve(df: DataFrame, y: str = "y", p: str = "p", n_bins: int = 10) -> DataFrame:
    """Per non-empty bin: mean score, fraction of positives, rows."""
    return (df.withColumn("bin", _bin_id(F.col(p), n_bins)).groupBy("bin")
            .agg(F.avg(p).alias("mean_predicted"), F.avg(y).alias("fraction_positives"),
                 F.count(F.lit(1)).alias("n")))


def expected_calibration_error(df: DataFrame, y: str = "y", p: str = "p", n_bins: int = 10) -> DataFrame:
    """E11 + E12: ECE over (lo, hi] bins (score 0 belongs to no bin, share
    taken over all rows), and its grade."""
    total = df.agg(F.count(F.lit(1)).alias("n_all"))
    bins = (df.where((F.col(p) > 0) & (F.col(p) <= 1)).withColumn("bin", _bin_id(F.col(p), n_bins))
            .groupBy("bin").agg(F.avg(p).alias("conf"), F.avg(y).alias("acc"), F.count(F.lit(1)).alias("n")))
    ece = (bins.crossJoin(total)
           .agg(F.coalesce(F.sum(F.abs(F.col("conf") - F.col("acc")) * F.col("n") / F.col("n_all")),
                           F.lit(0.0)).alias("ece")))
    return ece.select("ece", calibration_grade(F.col("ece")).alias("calibration_quality"))


def calibration_grade(ece: Column) -> Column:
    return (F.when(ece < 0.05, "Excellent").when(ece < 0.10, "Good").when(ece < 0.15, "Fair")
            .otherwise("Poor"))


def ppv_at_thresholds(df: DataFrame, y: str = "y", p: str = "p",
                      thresholds: Sequence[float] = (0.1, 0.2, 0.3, 0.4, 0.5)) -> DataFrame:
    """Share of positives among rows with score >= t (0 if none), one
    pass with a conditional aggregate per threshold."""
    structs = [F.struct(F.lit(t).alias("threshold"),
                        F.coalesce(F.avg(F.when(F.col(p) >= t, F.col(y))), F.lit(0.0)).alias("ppv"),
                        F.count_if(F.col(p) >= t).alias("flagged")) for t in thresholds]
    return df.agg(F.array(*structs).alias("s")).select(F.inline("s"))


# ---------------------------------------------------------- groups
def _membership(df: DataFrame, tags: Sequence[Column], keys: Sequence[str], y: str, p: str, pred: str | None = None) -> DataFrame:
    """:func:`score_counts` per group of a row's tags (a row may be in several
    groups; rows in none are dropped). Rows are counted by (set of tags, score)
    first; only these counts are repeated per tag."""
    g = score_counts(df.withColumn("_tags", F.filter(F.array(*tags), lambda x: x.isNotNull())), ["_tags"], y, p, pred)
    g = g.select(F.explode("_tags").alias("_tag"), *[c for c in g.columns if c != "_tags"])
    g = g.select(*([F.col(f"_tag.{k}").alias(k) for k in keys] if len(keys) > 1 else [F.col("_tag").alias(keys[0])]), *[c for c in g.columns if c != "_tag"])
    return g.groupBy(*keys, p).agg(*[F.sum(c).alias(c) for c in g.columns if c not in (*keys, p)])


def scenario_analysis(df: DataFrame, scenarios: Mapping[str, Column], y: str = "y", p: str = "p") -> DataFrame:
    """G1: per non-empty scenario: patients, actual rate, mean predicted
    score, AUC (null with one class), from one pass over the rows."""
    g = _membership(df, [F.when(cond, F.lit(name)) for name, cond in scenarios.items()], ["scenario"], y, p)
    n = F.sum(F.col("pos") + F.col("neg"))
    return running_counts(g, p, ["pos", "neg"], ["scenario"]).groupBy("scenario").agg(
        n.alias("n_patients"), (F.sum("pos") / n).alias("actual_rate"), (F.sum(F.col(p) * (F.col("pos") + F.col("neg"))) / n).alias("predicted_rate"),
        _auc().alias("auc"))


def group_performance(df: DataFrame, dimensions: Mapping[str, Mapping[str, Column]],
                      y: str = "y", pred: str = "pred", p: str = "p") -> DataFrame:
    """Per (dimension, group): N, prevalence, AUC, precision, recall,
    FPR; the four metrics are null when the group holds one class."""
    tags = [F.when(cond, F.struct(F.lit(dim).alias("dimension"), F.lit(g).alias("group")))
            for dim, groups in dimensions.items() for g, cond in groups.items()]
    keys = ["dimension", "group"]
    ranked = running_counts(_membership(df, tags, keys, y, p, pred), p, ["pos", "neg"], keys, OUTCOMES)
    c = ranked.groupBy(*keys).agg(*[F.sum(o).alias(o) for o in OUTCOMES], _auc().alias("auc"))
    two = (F.col("tp") + F.col("fn") > 0) & (F.col("tn") + F.col("fp") > 0)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    return c.select(*keys, (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("n"),
                    ((tp + fn) / (tn + fp + fn + tp)).alias("prevalence"),
                    F.when(two, _div0(tp, tp + fp)).alias("precision"),
                    F.when(two, _div0(tp, tp + fn)).alias("recall"),
                    F.when(two, _div0(fp, fp + tn)).alias("fpr"), "auc")


def fairness_disparity(perf: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Per dimension with more than one group: AUC and FPR spread
    (max - min) and whether it exceeds the threshold."""
    d = perf.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("groups"),
        (F.max("auc") - F.min("auc")).alias("auc_disparity"),
        (F.max("fpr") - F.min("fpr")).alias("fpr_disparity"))
    return (d.where(F.col("groups") > 1)
            .withColumn("auc_flag", F.coalesce(F.col("auc_disparity") > threshold, F.lit(False)).cast("int"))
            .withColumn("fpr_flag", F.coalesce(F.col("fpr_disparity") > threshold, F.lit(False)).cast("int")))


def difficult_scenarios(scen: DataFrame, rate: float = 0.3, auc: float = 0.7) -> DataFrame:
    """Scenarios with a high actual rate or a low AUC."""
    return scen.select("scenario", F.coalesce(F.col("actual_rate") > rate, F.lit(False)).cast("int").alias("high_risk"),
                       F.coalesce(F.col("auc") < auc, F.lit(False)).cast("int").alias("difficult")).where(
        (F.col("high_risk") == 1) | (F.col("difficult") == 1))
