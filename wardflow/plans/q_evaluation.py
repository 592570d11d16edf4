"""Queries: evaluation maths (E), ranking windows (W5, W6), scenario and
group analysis (G, A34), over deterministic scores of the admissions.

Two scores are used: the additive demo score ``p`` (few distinct values,
heavy ties; prediction = p >= 0.35) and a continuous index ``p2`` (many
distinct values; prediction = p2 >= 0.5). Label ``y`` is the 30-day flag.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow.functions import clinical as CL
from wardflow.operators import evaluation as EV
from wardflow.plans.catalog import out_sql, register
from wardflow.plans.q_features import featured_pre
from wardflow.plans.sql import auc_sql, cte, dbl, lit, with_ctes


def index_score():
    x = (F.col("age") + F.lit(3.0) * F.col("length_of_stay") + F.lit(7.0) * F.col("previous_admissions")
         + F.lit(11.0) * F.col("has_heart_disease")) / F.lit(300.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def scored(spark, sf):
    df = featured_pre(spark, sf)
    df = df.withColumns({"y": F.col("readmission_30_day"), "p": CL.demo_risk_score(), "p2": index_score()})
    return df.withColumns({"pred": (F.col("p") >= 0.35).cast("int"), "pred2": (F.col("p2") >= 0.5).cast("int")})


def _counts_sql(pred: str = "pred") -> str:
    return (f"SELECT count_if(y = 0 AND {pred} = 0) AS tn, count_if(y = 0 AND {pred} = 1) AS fp, "
            f"count_if(y = 1 AND {pred} = 0) AS fn, count_if(y = 1 AND {pred} = 1) AS tp FROM scored")


def _rates_sql(src: str) -> str:
    tp, tn, fp, fn = ("CAST(tp AS DOUBLE)", "CAST(tn AS DOUBLE)", "CAST(fp AS DOUBLE)", "CAST(fn AS DOUBLE)")

    def d0(a, b):
        return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) / ({b}) END)"
    prec, rec, spec = d0(tp, f"{tp} + {fp}"), d0(tp, f"{tp} + {fn}"), d0(tn, f"{tn} + {fp}")
    return f"""SELECT *, {d0(f'{tp} + {tn}', f'{tp} + {tn} + {fp} + {fn}')} AS accuracy, {prec} AS precision,
      {rec} AS recall, {d0(f'2 * {prec} * {rec}', f'{prec} + {rec}')} AS f1, {rec} AS sensitivity,
      {spec} AS specificity, {prec} AS ppv, {d0(tn, f'{tn} + {fn}')} AS npv,
      CASE WHEN {prec} > 0 THEN 1.0 / {prec} ELSE 'inf'::DOUBLE END AS nns,
      CASE WHEN {spec} < 1 THEN {rec} / (1.0 - {spec}) ELSE 'inf'::DOUBLE END AS lr_positive,
      CASE WHEN {spec} > 0 THEN (1.0 - {rec}) / {spec} ELSE 'inf'::DOUBLE END AS lr_negative
    FROM ({src})"""


RATES = _rates_sql(_counts_sql())


@register("e01_confusion_counts", with_ctes(out_sql("tn:i fp:i fn:i tp:i", f"({_counts_sql()})"), "scored"))
def e01_confusion_counts(spark, sf):
    """tn, fp, fn, tp of the score >= 0.35 rule."""
    return EV.confusion_counts(scored(spark, sf))


@register("e02_accuracy_precision_recall_f1", with_ctes(out_sql("accuracy:d precision:d recall:d f1:d", f"({RATES})"),
                                                       "scored"))
def e02_accuracy_precision_recall_f1(spark, sf):
    """Accuracy, precision, recall, F1 (0 on empty denominators)."""
    return EV.rates_from_counts(EV.confusion_counts(scored(spark, sf))).select("accuracy", "precision", "recall", "f1")


@register("e03_sensitivity_specificity", with_ctes(out_sql("sensitivity:d specificity:d ppv:d npv:d", f"({RATES})"),
                                                  "scored"))
def e03_sensitivity_specificity(spark, sf):
    """Sensitivity, specificity, PPV, NPV."""
    return EV.rates_from_counts(EV.confusion_counts(scored(spark, sf))).select("sensitivity", "specificity", "ppv", "npv")


@register("e04_utility_ratios", with_ctes(out_sql("nns:d lr_positive:d lr_negative:d", f"({RATES})"), "scored"))
def e04_utility_ratios(spark, sf):
    """Number needed to screen and likelihood ratios (infinite on zero)."""
    return EV.rates_from_counts(EV.confusion_counts(scored(spark, sf))).select("nns", "lr_positive", "lr_negative")


@register("e05_roc_auc", with_ctes(
    f"SELECT round(a.roc_auc, 6) AS auc_demo, round(b.roc_auc, 6) AS auc_index "
    f"FROM ({auc_sql('scored', 'p')}) a CROSS JOIN ({auc_sql('scored', 'p2')}) b", "scored"))
def e05_roc_auc(spark, sf):
    """Exact ROC-AUC with tie averaging, tied and continuous score."""
    df = scored(spark, sf)
    return (EV.roc_auc(df, "y", "p").withColumnRenamed("roc_auc", "auc_demo")
            .crossJoin(EV.roc_auc(df, "y", "p2").withColumnRenamed("roc_auc", "auc_index")))


@register("e06_average_precision", with_ctes(
    f"SELECT round(a.pr_auc, 6) AS ap_demo, round(b.pr_auc, 6) AS ap_index "
    f"FROM ({auc_sql('scored', 'p')}) a CROSS JOIN ({auc_sql('scored', 'p2')}) b", "scored"))
def e06_average_precision(spark, sf):
    """Step-wise average precision (not the trapezoid PR area)."""
    df = scored(spark, sf)
    return (EV.average_precision(df, "y", "p").withColumnRenamed("pr_auc", "ap_demo")
            .crossJoin(EV.average_precision(df, "y", "p2").withColumnRenamed("pr_auc", "ap_index")))


@register("e07_brier_score", with_ctes(out_sql(
    "brier_demo=avg(power(p - y, 2)):d | brier_index=avg(power(p2 - y, 2)):d", "scored"), "scored"))
def e07_brier_score(spark, sf):
    """Mean squared error of score vs label."""
    df = scored(spark, sf)
    return df.agg(F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("brier_demo"),
                  F.avg(F.pow(F.col("p2") - F.col("y"), 2)).alias("brier_index"))


_E8_COLS = ("model:s accuracy:d precision:d recall:d f1:d roc_auc:d sensitivity:d specificity:d ppv:d npv:d "
            "nns:d lr_positive:d lr_negative:d brier_score:d tp:i tn:i fp:i fn:i")


@register("e08_clinical_metric_row", with_ctes(out_sql(
    _E8_COLS, f"(SELECT 'Demo score' AS model, r.*, a.roc_auc, b.brier_score FROM ({RATES}) r CROSS JOIN "
              f"({auc_sql('scored', 'p')}) a CROSS JOIN (SELECT avg(power(p - y, 2)) AS brier_score FROM scored) b)"),
    "scored"))
def e08_clinical_metric_row(spark, sf):
    """Full clinical evaluation row for one model."""
    return EV.clinical_metrics(scored(spark, sf), model="Demo score")


_RATES2 = _rates_sql(_counts_sql("pred2"))


@register("e09_detailed_metric_row", with_ctes(out_sql(
    _E8_COLS + " pr_auc:d", f"(SELECT 'Index score' AS model, r.*, a.roc_auc, a.pr_auc, b.brier_score FROM ({_RATES2}) r "
                            f"CROSS JOIN ({auc_sql('scored', 'p2')}) a CROSS JOIN "
                            f"(SELECT avg(power(p2 - y, 2)) AS brier_score FROM scored) b)"), "scored"))
def e09_detailed_metric_row(spark, sf):
    """Clinical row plus average precision, continuous score."""
    return EV.clinical_metrics(scored(spark, sf), pred="pred2", p="p2", model="Index score", with_pr_auc=True)


def _bin_sql(p: str, n: int = 10) -> str:
    edges = ", ".join(dbl(e) for e in EV.interior_edges(n))
    return f"len(list_filter([{edges}], lambda e: e < {p}))"


@register("e10_calibration_curve", with_ctes(out_sql(
    "bin:i mean_predicted:d fraction_positives:d n:i",
    f"(SELECT {_bin_sql('p2')} AS bin, avg(p2) AS mean_predicted, avg(y) AS fraction_positives, count(*) AS n "
    f"FROM scored GROUP BY 1)"), "scored"))
def e10_calibration_curve(spark, sf):
    """Reliability curve: mean score and positive rate per non-empty bin."""
    return EV.calibration_curve(scored(spark, sf), "y", "p2")


def _ece_sql(p: str) -> str:
    return (f"SELECT coalesce(sum(abs(conf - acc) * n / (SELECT count(*) FROM scored)), 0.0) AS ece FROM ("
            f"SELECT {_bin_sql(p)} AS bin, avg({p}) AS conf, avg(y) AS acc, count(*) AS n FROM scored "
            f"WHERE {p} > 0 AND {p} <= 1 GROUP BY 1)")


def _grade_sql(x: str) -> str:
    return (f"CASE WHEN {x} < 0.05 THEN 'Excellent' WHEN {x} < 0.10 THEN 'Good' WHEN {x} < 0.15 THEN 'Fair' "
            f"ELSE 'Poor' END")


@register("e11_expected_calibration_error", with_ctes(out_sql(
    f"ece:d | calibration_quality={_grade_sql('ece')}:s", f"({_ece_sql('p2')})"), "scored"))
def e11_expected_calibration_error(spark, sf):
    """ECE over (lo, hi] bins (score 0 excluded) and its grade."""
    return EV.expected_calibration_error(scored(spark, sf), "y", "p2")


@register("e12_calibration_grade", with_ctes(
    f"SELECT {_grade_sql('a.ece')} AS grade_demo, {_grade_sql('b.ece')} AS grade_index "
    f"FROM ({_ece_sql('p')}) a CROSS JOIN ({_ece_sql('p2')}) b", "scored"))
def e12_calibration_grade(spark, sf):
    """Calibration grade of both scores."""
    df = scored(spark, sf)
    return (EV.expected_calibration_error(df, "y", "p").select(F.col("calibration_quality").alias("grade_demo"))
            .crossJoin(EV.expected_calibration_error(df, "y", "p2").select(
                F.col("calibration_quality").alias("grade_index"))))


_THRESHOLDS = (0.1, 0.2, 0.3, 0.4, 0.5)


@register("e13_ppv_at_thresholds", with_ctes(" UNION ALL ".join(
    f"SELECT {dbl(t)} AS threshold, round(coalesce(avg(CASE WHEN p2 >= {t} THEN y END), 0.0), 6) AS ppv, "
    f"CAST(count_if(p2 >= {t}) AS BIGINT) AS flagged FROM scored" for t in _THRESHOLDS), "scored"))
def e13_ppv_at_thresholds(spark, sf):
    """PPV among rows flagged at thresholds 0.1 .. 0.5."""
    return EV.ppv_at_thresholds(scored(spark, sf), "y", "p2", _THRESHOLDS)


@register("w05_rank_auc_by_insurance", with_ctes(
    f"SELECT grp AS insurance_type, round(roc_auc, 6) AS roc_auc FROM ({auc_sql('scored', 'p2', 'insurance_type')})",
    "scored"))
def w05_rank_auc_by_insurance(spark, sf):
    """Rank-based AUC per insurance class (two-level prefix sums per group)."""
    return EV.roc_auc(scored(spark, sf), "y", "p2", ["insurance_type"])


@register("w06_roc_pr_curve_points", with_ctes("""
SELECT round(s, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(tp / P, 6) AS tpr,
       round(fp / N, 6) AS fpr, round(tp / (tp + fp), 6) AS precision, round(tp / P, 6) AS recall FROM (
  SELECT s, P - coalesce(sum(pos) OVER w, 0) AS tp, N - coalesce(sum(neg) OVER w, 0) AS fp, P, N FROM (
    SELECT *, sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM (
      SELECT p AS s, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) - sum(y) AS DOUBLE) AS neg FROM scored GROUP BY 1))
  WINDOW w AS (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""", "scored"))
def w06_roc_pr_curve_points(spark, sf):
    """ROC / PR points: one per distinct score used as threshold."""
    return EV.curve_points(scored(spark, sf), "y", "p")


# The stock clinical scenarios (name -> predicate).
def scenarios():
    c = F.col
    return {
        "Elderly Diabetic Patients": (c("age") >= 75) & (c("has_diabetes") == 1),
        "Young Patients (Under 50)": c("age") < 50,
        "Multiple Comorbidities (3+)": c("comorbidity_count") >= 3,
        "Emergency Admissions with Heart Disease": (c("emergency_admission") == 1) & (c("has_heart_disease") == 1),
        "Recent Frequent Readmitters": c("frequent_readmitter") == 1,
        "Long Stay Patients (>10 days)": c("length_of_stay") > 10,
        "First-Time Admissions": c("previous_admissions") == 0,
        "Medicare Patients with Kidney Disease": (c("insurance_type") == "Medicare") & (c("has_kidney_disease") == 1),
        "High-Risk Elderly Emergency Patients": (c("age") >= 70) & (c("emergency_admission") == 1)
        & (c("comorbidity_count") >= 2),
    }


SCENARIO_SQL = {
    "Elderly Diabetic Patients": "age >= 75 AND has_diabetes = 1",
    "Young Patients (Under 50)": "age < 50",
    "Multiple Comorbidities (3+)": "comorbidity_count >= 3",
    "Emergency Admissions with Heart Disease": "emergency_admission = 1 AND has_heart_disease = 1",
    "Recent Frequent Readmitters": "frequent_readmitter = 1",
    "Long Stay Patients (>10 days)": "length_of_stay > 10",
    "First-Time Admissions": "previous_admissions = 0",
    "Medicare Patients with Kidney Disease": "insurance_type = 'Medicare' AND has_kidney_disease = 1",
    "High-Risk Elderly Emergency Patients": "age >= 70 AND emergency_admission = 1 AND comorbidity_count >= 2",
}
_SCEN_M = " UNION ALL ".join(f"SELECT {lit(n)} AS scenario, y, p2 FROM scored WHERE {w}" for n, w in SCENARIO_SQL.items())
cte("scen_m", ("scored",), _SCEN_M)
_SCEN_SQL = f"""
SELECT s.scenario, CAST(s.n AS BIGINT) AS n_patients, round(s.actual_rate, 6) AS actual_rate,
       round(s.predicted_rate, 6) AS predicted_rate, round(a.roc_auc, 6) AS auc
FROM (SELECT scenario, count(*) AS n, avg(y) AS actual_rate, avg(p2) AS predicted_rate FROM scen_m GROUP BY 1) s
LEFT JOIN ({auc_sql('scen_m', 'p2', 'scenario')}) a ON s.scenario = a.grp"""


@register("g01_scenario_analysis", with_ctes(_SCEN_SQL, "scen_m"))
def g01_scenario_analysis(spark, sf):
    """Per clinical scenario: patients, actual and predicted rate, AUC."""
    return EV.scenario_analysis(scored(spark, sf), scenarios(), "y", "p2")


def dimensions():
    c = F.col
    return {
        "Age Groups": {lab.replace("_", "-"): c("age_group") == lab for lab in CL.AGE_LABELS},
        "Gender": {g: c("gender") == g for g in ["Female", "Male"]},
        "Insurance Type": {i: c("insurance_type") == i for i in ["Medicare", "Private", "Medicaid", "Other"]},
    }


_DIM_SQL = {"Age Groups": [(lab.replace("_", "-"), f"age_group = {lit(lab)}") for lab in CL.AGE_LABELS],
            "Gender": [(g, f"gender = {lit(g)}") for g in ["Female", "Male"]],
            "Insurance Type": [(i, f"insurance_type = {lit(i)}") for i in ["Medicare", "Private", "Medicaid", "Other"]]}
_GRP_M = " UNION ALL ".join(f"SELECT {lit(d)} AS dimension, {lit(g)} AS grp, y, pred2 AS pred, p2 FROM scored WHERE {w}"
                            for d, groups in _DIM_SQL.items() for g, w in groups)
cte("grp_m", ("scored",), _GRP_M)
def _grp_sql(r: bool = True) -> str:
    rd = "round" if r else ""
    nd = ", 6" if r else ""
    return f"""
SELECT c.dimension, c.grp AS "group", CAST(c.n AS BIGINT) AS n, {rd}(c.prevalence{nd}) AS prevalence,
       {rd}(CASE WHEN two THEN a.roc_auc END{nd}) AS auc,
       {rd}(CASE WHEN two THEN (CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END) END{nd}) AS precision,
       {rd}(CASE WHEN two THEN (CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END) END{nd}) AS recall,
       {rd}(CASE WHEN two THEN (CASE WHEN fp + tn = 0 THEN 0.0 ELSE fp / (fp + tn) END) END{nd}) AS fpr
FROM (SELECT dimension, grp, count(*) AS n, avg(y) AS prevalence,
        CAST(count_if(y = 1 AND pred = 1) AS DOUBLE) AS tp, CAST(count_if(y = 0 AND pred = 1) AS DOUBLE) AS fp,
        CAST(count_if(y = 1 AND pred = 0) AS DOUBLE) AS fn, CAST(count_if(y = 0 AND pred = 0) AS DOUBLE) AS tn,
        count_if(y = 1) > 0 AND count_if(y = 0) > 0 AS two
      FROM grp_m GROUP BY 1, 2) c
LEFT JOIN ({auc_sql('grp_m', 'p2', "dimension || '|' || grp")}) a ON c.dimension || '|' || c.grp = a.grp"""


_GRP_SQL = _grp_sql()


@register("g02_group_performance", with_ctes(_GRP_SQL, "grp_m"))
def g02_group_performance(spark, sf):
    """Per demographic group: N, prevalence, AUC, precision, recall, FPR."""
    return EV.group_performance(scored(spark, sf), dimensions(), "y", "pred2", "p2")


@register("g03_difficult_scenarios", with_ctes(f"""
SELECT scenario, CAST(coalesce(actual_rate > 0.3, false) AS BIGINT) AS high_risk,
       CAST(coalesce(auc < 0.7, false) AS BIGINT) AS difficult
FROM ({_SCEN_SQL}) r WHERE coalesce(actual_rate > 0.3, false) OR coalesce(auc < 0.7, false)""", "scen_m"))
def g03_difficult_scenarios(spark, sf):
    """Scenarios with actual rate > 0.3 or AUC < 0.7."""
    return EV.difficult_scenarios(EV.scenario_analysis(scored(spark, sf), scenarios(), "y", "p2"))


@register("a34_fairness_disparity", with_ctes(f"""
SELECT dimension, CAST(count(*) AS BIGINT) AS groups, round(max(auc) - min(auc), 6) AS auc_disparity,
       round(max(fpr) - min(fpr), 6) AS fpr_disparity,
       CAST(coalesce(max(auc) - min(auc) > 0.05, false) AS BIGINT) AS auc_flag,
       CAST(coalesce(max(fpr) - min(fpr) > 0.05, false) AS BIGINT) AS fpr_flag
FROM ({_grp_sql(False)}) r GROUP BY dimension HAVING count(*) > 1""", "grp_m"))
def a34_fairness_disparity(spark, sf):
    """AUC and FPR spread per dimension, flagged above 0.05."""
    perf = EV.group_performance(scored(spark, sf), dimensions(), "y", "pred2", "p2")
    return EV.fairness_disparity(perf)
