"""Evaluation maths on hand cases and invariants."""

import random

import pytest
from pyspark.sql import functions as F

from wardflow.operators import evaluation as EV


def frame(spark, ys, ps, preds=None):
    preds = preds or [int(p >= 0.5) for p in ps]
    return spark.createDataFrame(list(zip(ys, preds, ps)), "y int, pred int, p double")


def test_hand_case_auc_and_ap(spark):
    df = frame(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8])
    assert EV.roc_auc(df).first()[0] == pytest.approx(0.75)
    assert EV.average_precision(df).first()[0] == pytest.approx(0.833333, abs=1e-6)


def test_auc_ties_count_half(spark):
    df = frame(spark, [0, 1, 0, 1], [0.5, 0.5, 0.2, 0.9])
    # pairs (pos, neg): (0.5,0.5)=0.5, (0.5,0.2)=1, (0.9,0.5)=1, (0.9,0.2)=1 -> 3.5/4
    assert EV.roc_auc(df).first()[0] == pytest.approx(0.875)


def test_auc_one_class_is_null(spark):
    df = frame(spark, [1, 1, 1], [0.2, 0.3, 0.4])
    assert EV.roc_auc(df).first()[0] is None


def test_auc_matches_brute_force_many_scores(spark):
    rnd = random.Random(7)
    ys = [rnd.randint(0, 1) for _ in range(600)]
    ps = [round(rnd.random(), 2) for _ in range(600)]  # many ties, > 64 distinct
    pos = [p for p, y in zip(ps, ys) if y == 1]
    neg = [p for p, y in zip(ps, ys) if y == 0]
    brute = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg) / (len(pos) * len(neg))
    df = frame(spark, ys, ps)
    assert EV.roc_auc(df).first()[0] == pytest.approx(brute)
    # grouped path: the same rows in two groups give the same AUC each
    g = df.withColumn("g", F.lit("a")).unionByName(df.withColumn("g", F.lit("b")))
    assert [r[1] for r in EV.roc_auc(g, by=["g"]).orderBy("g").collect()] == pytest.approx([brute, brute])


def test_confusion_and_rates(spark):
    df = frame(spark, [0, 0, 1, 1, 1], [0.1, 0.6, 0.7, 0.2, 0.9])
    c = EV.confusion_counts(df).first()
    assert (c.tn, c.fp, c.fn, c.tp) == (1, 1, 1, 2)
    r = EV.rates_from_counts(EV.confusion_counts(df)).first()
    assert r.precision == pytest.approx(2 / 3) and r.recall == pytest.approx(2 / 3)
    assert r.specificity == pytest.approx(0.5) and r.nns == pytest.approx(1.5)


def test_zero_denominators(spark):
    df = frame(spark, [0, 0], [0.1, 0.2])
    r = EV.rates_from_counts(EV.confusion_counts(df)).first()
    assert r.precision == 0.0 and r.recall == 0.0 and r.nns == float("inf")


def test_calibration_bins_right_closed(spark):
    df = frame(spark, [0, 1, 1, 0], [0.0, 0.1, 0.15, 1.0])
    bins = {r.bin: r.n for r in EV.calibration_curve(df).collect()}
    assert bins == {0: 2, 1: 1, 9: 1}
    ece = EV.expected_calibration_error(df).first()
    # p = 0 is in no ECE bin; bins: (0,.1] -> |0.1-1|*1/4, (.1,.2] -> |0.15-1|*1/4, (.9,1] -> |1-0|*1/4
    assert ece.ece == pytest.approx((0.9 + 0.85 + 1.0) / 4)


def test_scenarios_multi_membership(spark):
    df = spark.createDataFrame([(70.0, 1, 0.9), (80.0, 0, 0.2), (30.0, 1, 0.7), (30.0, 0, 0.1)],
                               "age double, y int, p double")
    out = {r.scenario: r for r in EV.scenario_analysis(df, {"old": F.col("age") >= 65, "all": F.lit(True),
                                                           "none": F.col("age") > 200}).collect()}
    assert set(out) == {"old", "all"}
    assert out["old"].n_patients == 2 and out["all"].auc == pytest.approx(1.0)


def test_ranges_follow_the_data(spark, monkeypatch):
    """Running sums over many ranges equal those over one, per group and with null groups."""
    from wardflow.operators import prefix
    rows = [(g, v * 0.5, (v * 7 + len(g or "")) % 5, v % 3) for g in ("a", "bb", None) for v in range(60)]
    d = spark.createDataFrame(rows, "g string, v double, n long, extra long")
    for by in (["g"], []):
        source = d if by else d.where("g = 'a'")
        one = prefix.running_counts(source, "v", ["n"], by, ["extra"])
        with monkeypatch.context() as m:
            m.setattr(prefix, "RANGE_ROWS", 20)
            many = prefix.running_counts(source, "v", ["n"], by, ["extra"])
            assert sorted(map(str, many.collect())) == sorted(map(str, one.collect())) and many.columns == one.columns
    got = {(r.g, r.v): (r.n_below, r.total_n) for r in prefix.running_counts(d, "v", ["n"], ["g"]).collect()}
    for g, v, _, _ in rows:
        mine = [x for x in rows if x[0] == g]
        assert got[g, v] == (sum(x[2] for x in mine if x[1] < v), sum(x[2] for x in mine))


def test_all_metrics_come_from_one_reading(spark):
    from wardflow.operators import evaluation as EV
    d = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.4), (1, 0, 0.35), (1, 1, 0.8)], "y int, pred int, p double")
    plan = EV.clinical_metrics(d, with_pr_auc=True)
    row = plan.first()
    assert (row.roc_auc, row.tn, row.fn, row.tp) == (0.75, 2, 1, 1) and abs(row.pr_auc - 0.8333333) < 1e-6
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan parquet") == 1 and text.count("Exchange") <= 5
