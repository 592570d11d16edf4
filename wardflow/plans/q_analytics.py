"""Queries: profiling and group analytics (A), sorts / top-k (T), set and
join shapes (J) over the raw, cleaned, featured and scored admissions."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow.functions import clinical as CL
from wardflow.operators import analytics as AN
from wardflow.operators import codes as K
from wardflow.operators import evaluation as EV
from wardflow.operators import quality as QA
from wardflow.operators.sequence import entity_sequence
from wardflow.plans.catalog import out_sql, register
from wardflow.plans.q_cleaning import cleaned_columns
from wardflow.plans.q_evaluation import scored
from wardflow.plans.q_features import _K06, coded, derived, featured_pre
from wardflow.plans.sql import auc_sql, lit, with_ctes
from wardflow.sources.binding import RAW_COLUMNS, admissions

TARGET = "readmission_30_day"
RAW_TEXT = ["patient_id", "gender", "admission_date", "diagnosis_codes", "insurance_type"]


def _missing_sql(src: str, cols: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS missing, count(*) AS n FROM {src}" for c in cols)
    return parts


# ------------------------------------------------------------- profiling
@register("a01_table_shape", with_ctes(f"SELECT CAST(count(*) AS BIGINT) AS total_records, "
                                       f"CAST({len(RAW_COLUMNS)} AS BIGINT) AS total_columns FROM raw", "raw"))
def a01_table_shape(spark, sf):
    """Rows and columns of the raw table."""
    df = admissions(spark, sf)
    return df.agg(F.count(F.lit(1)).alias("total_records")).withColumn("total_columns", F.lit(len(df.columns)))


@register("a02_missing_values", with_ctes(
    f"SELECT \"column\", CAST(missing AS BIGINT) AS missing, round(missing * 100.0 / n, 6) AS missing_pct "
    f"FROM ({_missing_sql('raw', RAW_COLUMNS)}) WHERE missing > 0", "raw"))
def a02_missing_values(spark, sf):
    """Missing count and percent per column, only columns with gaps."""
    return QA.missing_summary(admissions(spark, sf))


@register("a03_mostly_missing_columns", with_ctes(
    f"SELECT \"column\", round(missing * 100.0 / n, 6) AS missing_pct FROM ({_missing_sql('featured_pre', ['age_group', 'los_category', 'admission_date', 'admission_month'])}) "
    f"WHERE missing * 100.0 / n > 50", "featured_pre"))
def a03_mostly_missing_columns(spark, sf):
    """Columns with more than half of the values missing."""
    df = derived(spark, sf, "age_group", "los_category", "admission_date", "admission_month").drop("admission_key")
    return (QA.column_profile(df).where(F.col("missing_pct") > 50).select("column", "missing_pct"))


_DUP_COLS = [c for c in RAW_COLUMNS if c != "admission_key"]


_DUP_LIST = ", ".join(_DUP_COLS)


@register("a04_duplicate_rows", with_ctes(
    f"SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates FROM "
    f"(SELECT {_DUP_LIST}, count(*) AS c FROM raw GROUP BY {_DUP_LIST})", "raw"))
def a04_duplicate_rows(spark, sf):
    """Rows equal to an earlier row on every column but the key (nulls equal)."""
    return QA.duplicate_count(admissions(spark, sf).select(*_DUP_COLS))


@register("a05_text_cardinality", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values, "
    f"CAST(count(DISTINCT {c}) > count(*) * 0.9 AS BIGINT) AS high_cardinality FROM raw" for c in RAW_TEXT), "raw"))
def a05_text_cardinality(spark, sf):
    """Distinct values per text column, flagged above 90% of rows."""
    prof = QA.column_profile(admissions(spark, sf).select(*RAW_TEXT))
    return prof.select("column", F.col("distinct").alias("distinct_values"),
                       (F.col("distinct") > F.col("rows") * 0.9).cast("long").alias("high_cardinality"))


@register("a06_invalid_ages", with_ctes("SELECT CAST(count_if(age < 0 OR age > 120) AS BIGINT) AS invalid_ages FROM raw",
                                        "raw"))
def a06_invalid_ages(spark, sf):
    """Ages outside 0..120."""
    return admissions(spark, sf, ["age"]).agg(F.count_if((F.col("age") < 0) | (F.col("age") > 120)).alias("invalid_ages"))


_DTYPES = {"bigint": ["admission_key"], "string": RAW_TEXT, "double": ["age", "length_of_stay"],
           "int": ["emergency_admission", "previous_admissions", "readmission_30_day"]}


@register("a07_dtype_profile", with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS dtype, CAST({len(cols)} AS BIGINT) AS columns, CAST({' + '.join(f'count({c})' for c in cols)} AS BIGINT) AS present, "
    f"CAST({' + '.join(f'count_if({c} IS NULL)' for c in cols)} AS BIGINT) AS missing FROM raw" for t, cols in _DTYPES.items()), "raw"))
def a07_dtype_profile(spark, sf):
    """Columns of every data type, their values and missing values."""
    return QA.dtype_profile(admissions(spark, sf))


def _quality_sql() -> str:
    miss = " UNION ALL ".join(
        f"SELECT 'missing_count' AS metric, '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS DOUBLE) AS value FROM raw "
        f"UNION ALL SELECT 'missing_pct', '{c}', count_if({c} IS NULL) * 100.0 / count(*) FROM raw" for c in RAW_COLUMNS)
    card = " UNION ALL ".join(
        f"SELECT 'issue_high_cardinality', '{c}', CAST(count(DISTINCT {c}) AS DOUBLE) FROM raw "
        f"HAVING count(DISTINCT {c}) > count(*) * 0.9" for c in RAW_TEXT)
    dups = (f"SELECT 'duplicates', NULL, CAST(coalesce(sum(c - 1), 0) AS DOUBLE) FROM "
            f"(SELECT {', '.join(RAW_COLUMNS)}, count(*) AS c FROM raw GROUP BY {', '.join(RAW_COLUMNS)})")
    return f"""SELECT metric, "column", round(value, 6) AS value FROM (
      SELECT 'total_records' AS metric, NULL AS "column", CAST(count(*) AS DOUBLE) AS value FROM raw
      UNION ALL SELECT 'total_columns', NULL, {float(len(RAW_COLUMNS))}
      UNION ALL {dups}
      UNION ALL {miss}
      UNION ALL {card}
      UNION ALL SELECT 'issue_invalid_age', 'age', CAST(count_if(age < 0 OR age > 120) AS DOUBLE) FROM raw
        HAVING count_if(age < 0 OR age > 120) > 0)"""


@register("a08_quality_report", with_ctes(_quality_sql(), "raw"))
def a08_quality_report(spark, sf):
    """Whole quality report as tidy (metric, column, value) rows."""
    return QA.quality_report(admissions(spark, sf))


_DESC_COLS = ["age", "length_of_stay", "emergency_admission", "previous_admissions", "readmission_30_day"]


@register("a09_describe", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, "
    f"round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max "
    f"FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM raw)" for c in _DESC_COLS), "raw"))
def a09_describe(spark, sf):
    """count, mean, sample std, min, exact quartiles, max."""
    return QA.describe(admissions(spark, sf), _DESC_COLS)


@register("a10_exact_quantiles", with_ctes(
    "SELECT " + ", ".join(f"round(quantile_cont(length_of_stay, {q}), 6) AS q{int(q * 100):02d}"
                          for q in (0.01, 0.25, 0.5, 0.75, 0.99)) +
    ", round(median(age), 6) AS median_age FROM raw", "raw"))
def a10_exact_quantiles(spark, sf):
    """Exact (interpolated) quantiles of length of stay, median age."""
    from wardflow.operators.quantiles import quantile_row
    df = admissions(spark, sf)
    probs = (0.01, 0.25, 0.5, 0.75, 0.99)
    return (quantile_row(df, "length_of_stay", probs, [f"q{int(x * 100):02d}" for x in probs])
            .crossJoin(quantile_row(df, "age", [0.5], ["median_age"])))


@register("a11_mode", with_ctes("""
SELECT (SELECT insurance_type FROM raw WHERE insurance_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS insurance_mode,
       (SELECT gender FROM raw WHERE gender IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS gender_mode""", "raw"))
def a11_mode(spark, sf):
    """Most frequent raw insurance and gender text (smallest on ties)."""
    from wardflow.operators.cleaning import mode_value
    df = admissions(spark, sf, ["insurance_type", "gender"])
    return spark.range(1).select(mode_value(df, "insurance_type").alias("insurance_mode"),
                                 mode_value(df, "gender").alias("gender_mode"))


@register("a12_value_counts", with_ctes(
    "SELECT insurance_type, CAST(count(*) AS BIGINT) AS n FROM clean WHERE insurance_type IS NOT NULL GROUP BY 1", "clean"))
def a12_value_counts(spark, sf):
    """Standardised insurance classes and their counts."""
    return QA.value_counts(cleaned_columns(spark, sf, ["insurance_type"]), "insurance_type")


@register("a13_distinct_with_null", with_ctes(
    "SELECT CAST(count(DISTINCT admission_date) + max(CAST(admission_date IS NULL AS INTEGER)) AS BIGINT) AS n_unique FROM raw",
    "raw"))
def a13_distinct_with_null(spark, sf):
    """Distinct raw date texts, null counted as one value."""
    return QA.distinct_with_null(admissions(spark, sf, ["admission_date"]), "admission_date")


def _rate_sql(group: str, src: str = "featured_pre", name: str | None = None, integer: bool = False) -> str:
    name = name or group
    key = f"CAST({group} AS BIGINT)" if integer else group
    return (f"SELECT {key} AS {name}, round(avg(readmission_30_day), 6) AS rate, CAST(count(*) AS BIGINT) AS n "
            f"FROM {src} WHERE {group} IS NOT NULL GROUP BY 1")


@register("a14_rate_by_age_group", with_ctes(_rate_sql("age_group"), "featured_pre"))
def a14_rate_by_age_group(spark, sf):
    """Readmission rate and count by age group (the flagship query)."""
    return AN.rate_by(derived(spark, sf, "age_group", TARGET), "age_group")


@register("a14_rate_by_stay_group", with_ctes(_rate_sql(
    "(CASE WHEN length_of_stay > 0 AND length_of_stay <= 2 THEN '1-2 days' WHEN length_of_stay > 2 AND length_of_stay <= 5 "
    "THEN '3-5 days' WHEN length_of_stay > 5 AND length_of_stay <= 10 THEN '6-10 days' "
    "WHEN length_of_stay > 10 AND length_of_stay <= 100 THEN '>10 days' END)", "raw", "los_group"), "raw"))
def a14_rate_by_stay_group(spark, sf):
    """Readmission rate by length-of-stay group (raw values)."""
    g = CL.right_closed_bins(F.col("length_of_stay"), CL.EXPLORE_LOS_EDGES, CL.EXPLORE_LOS_LABELS)
    return AN.rate_by(admissions(spark, sf), g, name="los_group")


@register("a14_rate_by_previous_admissions", with_ctes(
    _rate_sql("previous_admissions", "raw", integer=True) + " ORDER BY 1 LIMIT 6", "raw"))
def a14_rate_by_previous_admissions(spark, sf):
    """Rate by previous admissions, first six values in key order."""
    return AN.rate_by(admissions(spark, sf, ["previous_admissions", TARGET]), "previous_admissions").orderBy("previous_admissions").limit(6)


@register("a14_rate_by_emergency", with_ctes(_rate_sql("emergency_admission", "raw", integer=True), "raw"))
def a14_rate_by_emergency(spark, sf):
    """Rate for scheduled vs emergency admissions."""
    return AN.rate_by(admissions(spark, sf, ["emergency_admission", TARGET]), "emergency_admission")


@register("a15_rate_by_admission_pattern", with_ctes(_rate_sql("admission_pattern") + " ORDER BY rate DESC",
                                                     "featured_pre"))
def a15_rate_by_admission_pattern(spark, sf):
    """Rate per admission pattern, highest first."""
    return AN.rate_by(derived(spark, sf, "admission_pattern", TARGET), "admission_pattern").orderBy(F.col("rate").desc())


@register("a15_rate_by_recent_and_frequent", with_ctes(
    "SELECT CAST(recent_admission AS BIGINT) AS recent_admission, CAST(frequent_readmitter AS BIGINT) AS frequent_readmitter, "
    "round(avg(readmission_30_day), 6) AS rate, CAST(count(*) AS BIGINT) AS n "
    "FROM featured_pre GROUP BY 1, 2", "featured_pre"))
def a15_rate_by_recent_and_frequent(spark, sf):
    """Rate per (recent admission, frequent readmitter) combination."""
    return (derived(spark, sf, "recent_admission", "frequent_readmitter", TARGET).groupBy("recent_admission", "frequent_readmitter")
            .agg(F.avg("readmission_30_day").alias("rate"), F.count(F.lit(1)).alias("n")))


_RR_FLAGS = ["high_risk_patient", "elderly", "multiple_comorbidities", "long_stay"]


@register("a16_relative_risk", with_ctes(" UNION ALL ".join(
    f"SELECT '{f}' AS flag, round(avg(CASE WHEN {f} = 1 THEN readmission_30_day END), 6) AS rate_with, "
    f"round(avg(CASE WHEN {f} = 0 THEN readmission_30_day END), 6) AS rate_without, "
    f"round(CASE WHEN avg(CASE WHEN {f} = 0 THEN readmission_30_day END) = 0 THEN NULL ELSE "
    f"avg(CASE WHEN {f} = 1 THEN readmission_30_day END) / avg(CASE WHEN {f} = 0 THEN readmission_30_day END) END, 6) "
    f"AS relative_risk FROM featured_pre" for f in _RR_FLAGS), "featured_pre"))
def a16_relative_risk(spark, sf):
    """Rate with / without each risk flag and their ratio."""
    return AN.relative_risk(derived(spark, sf, *_RR_FLAGS, TARGET), _RR_FLAGS)


@register("a17_global_rates", with_ctes(out_sql(
    "mean_age=avg(age):d | mean_los=avg(length_of_stay):d | readmission_rate=avg(readmission_30_day):d | "
    "emergency_rate=avg(emergency_admission):d", "raw"), "raw"))
def a17_global_rates(spark, sf):
    """Overall means: age, stay, readmission, emergency."""
    return admissions(spark, sf).agg(F.avg("age").alias("mean_age"), F.avg("length_of_stay").alias("mean_los"),
                                     F.avg("readmission_30_day").alias("readmission_rate"),
                                     F.avg("emergency_admission").alias("emergency_rate"))


_CORR_COLS = ["age", "length_of_stay", "previous_admissions", "emergency_admission", "readmission_30_day"]


@register("a18_correlation_matrix", with_ctes(" UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM raw"
    for a in _CORR_COLS for b in _CORR_COLS), "raw"))
def a18_correlation_matrix(spark, sf):
    """Pearson correlations of five numeric columns (pairwise complete)."""
    return AN.correlation_matrix(admissions(spark, sf), _CORR_COLS)


@register("a19_crosstab_row_share", with_ctes(
    "SELECT admission_pattern, CAST(readmission_30_day AS BIGINT) AS readmission_30_day, CAST(n AS BIGINT) AS n, round(n / sum(n) OVER (PARTITION BY admission_pattern), 6) AS share "
    "FROM (SELECT admission_pattern, readmission_30_day, count(*) AS n FROM featured_pre GROUP BY 1, 2)", "featured_pre"))
def a19_crosstab_row_share(spark, sf):
    """Admission pattern x outcome, shares within each pattern."""
    return AN.crosstab_normalized(derived(spark, sf, "admission_pattern", TARGET), "admission_pattern", TARGET)


@register("a20_crosstab_agreement", with_ctes(
    "SELECT CAST(pred AS BIGINT) AS pred, CAST(pred2 AS BIGINT) AS pred2, CAST(count(*) AS BIGINT) AS n "
    "FROM scored GROUP BY 1, 2", "scored"))
def a20_crosstab_agreement(spark, sf):
    """Counts of the two rules' predictions against each other."""
    return AN.crosstab_counts(scored(spark, sf), "pred", "pred2")


def _hist_sql(col: str, bins: int, src: str, by: str | None = None) -> str:
    grp = f"{by}, " if by else ""
    out_grp = f"CAST({by} AS BIGINT) AS {by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""
SELECT {out_grp}CAST(bin AS BIGINT) AS bin, CAST(n AS BIGINT) AS n, round(lower_edge, 6) AS lower_edge,
       round(n / (sum(n) OVER ({part}) * w), 6) AS density FROM (
  SELECT {grp}bin, count(*) AS n, first(mn + bin * w) AS lower_edge, first(w) AS w FROM (
    SELECT {grp}CAST(coalesce(least({bins - 1}, floor(({col} - mn) * {float(bins)} / (mx - mn))), 0) AS INTEGER) AS bin,
           mn, (mx - mn) / {float(bins)} AS w
    FROM {src} CROSS JOIN (SELECT min({col}) AS mn, max({col}) AS mx FROM {src}) WHERE {col} IS NOT NULL)
  GROUP BY ALL)"""


@register("a21_histogram_age", with_ctes(_hist_sql("age", 30, "clean"), "clean"))
def a21_histogram_age(spark, sf):
    """30 equal-width bins of age: count and density."""
    return AN.histogram(cleaned_columns(spark, sf, ["age"]), "age", 30)


@register("a21_histogram_score_by_class", with_ctes(_hist_sql("p2", 20, "scored", "y"), "scored"))
def a21_histogram_score_by_class(spark, sf):
    """20 bins of the continuous score per outcome class."""
    return AN.histogram(scored(spark, sf), "p2", 20, by="y")


_ERR = ("(CASE WHEN y = 1 AND pred2 = 0 THEN 'False Negative' WHEN y = 0 AND pred2 = 1 THEN 'False Positive' "
        "ELSE 'Correct' END)")


def errors(spark, sf):
    df = scored(spark, sf)
    return df.withColumn("error_type", CL.error_type("y", "pred2"))


@register("a22_box_stats_by_error", with_ctes(f"""
SELECT error_type, CAST(n AS BIGINT) AS n, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       round(greatest(mn, q1 - 1.5 * (q3 - q1)), 6) AS whisker_low, round(least(mx, q3 + 1.5 * (q3 - q1)), 6) AS whisker_high
FROM (SELECT {_ERR} AS error_type, count(*) AS n, quantile_cont(p2, 0.25) AS q1, quantile_cont(p2, 0.5) AS med,
             quantile_cont(p2, 0.75) AS q3, min(p2) AS mn, max(p2) AS mx FROM scored GROUP BY 1)""", "scored"))
def a22_box_stats_by_error(spark, sf):
    """Quartiles and whiskers of the score per error type."""
    return AN.box_stats(errors(spark, sf), "p2", "error_type")


@register("a23_condition_prevalence_sorted", with_ctes(
    f"SELECT condition, round(prevalence, 6) AS prevalence FROM ({_K06}) ORDER BY prevalence DESC", "coded"))
def a23_condition_prevalence_sorted(spark, sf):
    """Condition prevalence, most common first."""
    return K.condition_summary(coded(spark, sf)).select("condition", "prevalence").orderBy(F.col("prevalence").desc())


@register("a24_comorbidity_distribution", with_ctes(
    "SELECT CAST(comorbidity_count AS BIGINT) AS comorbidity_count, CAST(count(*) AS BIGINT) AS n "
    "FROM featured_pre GROUP BY 1", "featured_pre"))
def a24_comorbidity_distribution(spark, sf):
    """Admissions per comorbidity count."""
    return derived(spark, sf, "comorbidity_count").groupBy("comorbidity_count").agg(F.count(F.lit(1)).alias("n"))


@register("a24_comorbidity_summary", with_ctes(
    "SELECT round(avg(comorbidity_count), 6) AS mean_count, round(avg(CAST(comorbidity_count >= 2 AS INTEGER)), 6) AS share_two_plus "
    "FROM featured_pre", "featured_pre"))
def a24_comorbidity_summary(spark, sf):
    """Mean comorbidity count and share with two or more."""
    df = derived(spark, sf, "comorbidity_count")
    return df.agg(F.avg("comorbidity_count").alias("mean_count"),
                  F.avg((F.col("comorbidity_count") >= 2).cast("int")).alias("share_two_plus"))


@register("a25_flag_totals", with_ctes(" UNION ALL ".join(
    f"SELECT '{f}' AS flag, CAST(sum({f}) AS BIGINT) AS total, round(avg({f}), 6) AS rate FROM featured_pre"
    for f in _RR_FLAGS), "featured_pre"))
def a25_flag_totals(spark, sf):
    """Totals and rates of the risk flags."""
    df = derived(spark, sf, *_RR_FLAGS)
    s = [F.struct(F.lit(f).alias("flag"), F.sum(f).alias("total"), F.avg(f).alias("rate")) for f in _RR_FLAGS]
    return df.agg(F.array(*s).alias("s")).select(F.inline("s"))


@register("a26_outlier_counts", with_ctes(
    "SELECT CAST(count_if(length_of_stay > 20) AS BIGINT) AS long_stays, "
    "CAST(count_if(age < 18 OR age > 100) AS BIGINT) AS unusual_ages FROM raw", "raw"))
def a26_outlier_counts(spark, sf):
    """Stays over 20 days; ages under 18 or over 100."""
    return admissions(spark, sf).agg(F.count_if(F.col("length_of_stay") > 20).alias("long_stays"),
                                     F.count_if((F.col("age") < 18) | (F.col("age") > 100)).alias("unusual_ages"))


_PROFILE = ["age", "length_of_stay", "previous_admissions", "comorbidity_count", "has_diabetes", "has_heart_disease",
            "has_kidney_disease", "has_hypertension"]


@register("a27_error_profile", with_ctes(
    f"SELECT coalesce(error_type, 'Overall') AS error_type, CAST(count(*) AS BIGINT) AS n, " +
    ", ".join(f"round(avg({c}), 6) AS mean_{c}" for c in _PROFILE) +
    f" FROM (SELECT *, {_ERR} AS error_type FROM scored) GROUP BY ROLLUP (error_type)", "scored"))
def a27_error_profile(spark, sf):
    """Feature means and condition prevalence per error type and overall."""
    df = errors(spark, sf)
    out = df.rollup("error_type").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in _PROFILE])
    return out.withColumn("error_type", F.coalesce("error_type", F.lit("Overall")))


@register("a28_error_rate_by_age_group", with_ctes(
    f"SELECT age_group, round(avg(CAST({_ERR} <> 'Correct' AS INTEGER)), 6) AS error_rate, CAST(count(*) AS BIGINT) AS n "
    f"FROM scored WHERE age_group IS NOT NULL GROUP BY 1", "scored"))
def a28_error_rate_by_age_group(spark, sf):
    """Share of wrong predictions per age group."""
    df = errors(spark, sf).where(F.col("age_group").isNotNull())
    return df.groupBy("age_group").agg(F.avg((F.col("error_type") != "Correct").cast("int")).alias("error_rate"),
                                       F.count(F.lit(1)).alias("n"))


@register("a29_high_risk_by_correct", with_ctes(
    f"SELECT CAST(high_risk_patient AS BIGINT) AS high_risk_patient, CAST({_ERR} = 'Correct' AS BIGINT) AS correct, "
    f"CAST(count(*) AS BIGINT) AS n "
    f"FROM scored GROUP BY 1, 2", "scored"))
def a29_high_risk_by_correct(spark, sf):
    """2 x 2 counts: high-risk flag by correct prediction."""
    df = errors(spark, sf)
    return df.groupBy("high_risk_patient", (F.col("error_type") == "Correct").cast("int").alias("correct")).agg(
        F.count(F.lit(1)).alias("n"))


@register("a30_model_agreement", with_ctes(
    "SELECT round(avg(CAST(pred = pred2 AS INTEGER)), 6) AS agreement_rate, CAST(count_if(pred <> pred2) AS BIGINT) AS disagreements, "
    "round(avg(CASE WHEN pred <> pred2 THEN age END), 6) AS disagreement_mean_age, "
    "round(avg(CASE WHEN pred <> pred2 THEN comorbidity_count END), 6) AS disagreement_mean_comorbidity FROM scored", "scored"))
def a30_model_agreement(spark, sf):
    """Agreement of the two rules and the profile of disagreements."""
    df = scored(spark, sf)
    d = F.col("pred") != F.col("pred2")
    return df.agg(F.avg((~d).cast("int")).alias("agreement_rate"), F.count_if(d).alias("disagreements"),
                  F.avg(F.when(d, F.col("age"))).alias("disagreement_mean_age"),
                  F.avg(F.when(d, F.col("comorbidity_count"))).alias("disagreement_mean_comorbidity"))


def _tier_sql(p: str) -> str:
    whens = " ".join(f"WHEN {p} < {b} THEN {lit(lab)}" for b, lab in CL.TIER_BOUNDS)
    return f"(CASE {whens} ELSE {lit(CL.TIER_TOP)} END)"


@register("a31_batch_scoring_summary", with_ctes(
    f"SELECT tier, CAST(count(*) AS BIGINT) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share, "
    f"CAST(sum(count_if(tier IN ('High', 'Very High'))) OVER () AS BIGINT) AS high_risk_count, "
    f"round(sum(sum(p2)) OVER () / sum(count(*)) OVER (), 6) AS mean_score "
    f"FROM (SELECT *, {_tier_sql('p2')} AS tier FROM scored) GROUP BY tier", "scored"))
def a31_batch_scoring_summary(spark, sf):
    """Tier distribution with shares, high-risk count and mean score."""
    df = scored(spark, sf).withColumn("tier", CL.probability_tier("p2"))
    per = df.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.sum("p2").alias("_s"),
                                 F.count_if(F.col("tier").isin("High", "Very High")).alias("_h"))
    tot = per.agg(F.sum("n").alias("_n"), F.sum("_h").alias("high_risk_count"), F.sum("_s").alias("_ss"))
    return (per.crossJoin(F.broadcast(tot))
            .select("tier", "n", (F.col("n") / F.col("_n")).alias("share"), "high_risk_count",
                    (F.col("_ss") / F.col("_n")).alias("mean_score")))


# Clinical category of each model input (for grouped importance).
FEATURE_CATEGORY = {
    "age": "Demographics", "elderly": "Demographics", "age_squared": "Demographics",
    "has_diabetes": "Conditions", "has_hypertension": "Conditions", "has_heart_disease": "Conditions",
    "has_kidney_disease": "Conditions", "has_hyperlipidemia": "Conditions", "has_copd": "Conditions",
    "has_depression": "Conditions", "comorbidity_count": "Conditions",
    "previous_admissions": "Utilization", "length_of_stay": "Utilization", "emergency_admission": "Utilization",
    "days_since_last_admission": "Temporal", "recent_admission": "Temporal", "frequent_readmitter": "Temporal",
}


def importance(df, target: str = "readmission_30_day"):
    """|corr(feature, target)| as a model-free importance, one aggregate."""
    s = [F.struct(F.lit(f).alias("feature"), F.abs(F.corr(F.col(f).cast("double"), F.col(target).cast("double")))
                  .alias("importance")) for f in FEATURE_CATEGORY]
    return df.agg(F.array(*s).alias("s")).select(F.inline("s"))


def _importance_sql(target: str = "readmission_30_day") -> str:
    return " UNION ALL ".join(f"SELECT '{f}' AS feature, abs(corr(CAST({f} AS DOUBLE), CAST({target} AS DOUBLE))) AS importance "
                              f"FROM featured_pre" for f in FEATURE_CATEGORY)


_CAT_VALUES = ", ".join(f"({lit(f)}, {lit(c)})" for f, c in FEATURE_CATEGORY.items())


@register("a32_importance_by_category", with_ctes(
    f"SELECT c.category, round(sum(i.importance), 6) AS importance FROM ({_importance_sql()}) i "
    f"JOIN (VALUES {_CAT_VALUES}) c(feature, category) ON i.feature = c.feature GROUP BY c.category", "featured_pre"))
def a32_importance_by_category(spark, sf):
    """Importance (|correlation| with the outcome) summed per clinical category."""
    cats = spark.createDataFrame(list(FEATURE_CATEGORY.items()), "feature string, category string")
    imp = importance(featured_pre(spark, sf))
    return imp.join(F.broadcast(cats), "feature").groupBy("category").agg(F.sum("importance").alias("importance"))


def _a33_sql() -> str:
    from wardflow.plans.q_evaluation import _ece_sql
    return (f"SELECT CASE WHEN a.roc_auc >= b.roc_auc THEN 'Demo score' ELSE 'Index score' END AS best_by_auc, "
            f"round(greatest(a.roc_auc, b.roc_auc), 6) AS best_auc, "
            f"CASE WHEN a.roc_auc >= b.roc_auc AND ea.ece <= eb.ece THEN 'Demo score' ELSE 'Index score' END "
            f"AS recommended FROM ({auc_sql('scored', 'p')}) a CROSS JOIN ({auc_sql('scored', 'p2')}) b "
            f"CROSS JOIN ({_ece_sql('p')}) ea CROSS JOIN ({_ece_sql('p2')}) eb")


@register("a33_best_model", with_ctes(_a33_sql(), "scored"))
def a33_best_model(spark, sf):
    """Model with the highest ROC-AUC (first listed wins ties), and the
    recommendation rule: the first model if its AUC is not lower and its
    calibration error not higher, else the second."""
    df = scored(spark, sf)
    rows = (EV.roc_auc(df, "y", "p").select(F.lit("Demo score").alias("model"), F.lit(0).alias("ord"), "roc_auc")
            .unionByName(EV.roc_auc(df, "y", "p2").select(F.lit("Index score").alias("model"), F.lit(1).alias("ord"),
                                                           "roc_auc")))
    best = rows.agg(F.min_by("model", F.struct(-F.col("roc_auc"), F.col("ord"))).alias("best_by_auc"),
                    F.max("roc_auc").alias("best_auc"))
    a = EV.roc_auc(df, "y", "p").withColumnRenamed("roc_auc", "_aa")
    b = EV.roc_auc(df, "y", "p2").withColumnRenamed("roc_auc", "_ab")
    ea = EV.expected_calibration_error(df, "y", "p").select(F.col("ece").alias("_ea"))
    eb = EV.expected_calibration_error(df, "y", "p2").select(F.col("ece").alias("_eb"))
    rule = a.crossJoin(b).crossJoin(ea).crossJoin(eb).select(
        F.when((F.col("_aa") >= F.col("_ab")) & (F.col("_ea") <= F.col("_eb")), "Demo score")
        .otherwise("Index score").alias("recommended"))
    return best.crossJoin(rule)


@register("a35_exploration_summary", with_ctes("""
SELECT CAST(count(DISTINCT patient_id) AS BIGINT) AS patients, round(avg(readmission_30_day), 6) AS readmission_rate,
       CAST((SELECT count(*) FROM (""" + _missing_sql("raw", RAW_COLUMNS) + """) WHERE missing > 0) AS BIGINT) AS columns_with_gaps,
       CAST((SELECT count(DISTINCT trim(t)) FROM (SELECT unnest(string_split(diagnosis_codes, ';')) AS t FROM raw
             WHERE diagnosis_codes IS NOT NULL AND diagnosis_codes <> '') WHERE trim(t) <> '') AS BIGINT) AS distinct_codes
FROM raw""", "raw"))
def a35_exploration_summary(spark, sf):
    """Patients, readmission rate, columns with gaps, distinct codes."""
    df = admissions(spark, sf)
    base = df.agg(F.count_distinct("patient_id").alias("patients"), F.avg("readmission_30_day").alias("readmission_rate"))
    gaps = QA.missing_summary(df).agg(F.count(F.lit(1)).alias("columns_with_gaps"))
    codes = K.code_frequency(df).agg(F.count(F.lit(1)).alias("distinct_codes"))
    return base.crossJoin(gaps).crossJoin(codes)


_E37 = ["accuracy", "precision", "recall", "f1", "roc_auc"]


def _a37_sql() -> str:
    from wardflow.plans.q_evaluation import RATES, _RATES2
    a = f"SELECT r.accuracy, r.precision, r.recall, r.f1, x.roc_auc FROM ({RATES}) r CROSS JOIN ({auc_sql('scored', 'p')}) x"
    b = f"SELECT r.accuracy, r.precision, r.recall, r.f1, x.roc_auc FROM ({_RATES2}) r CROSS JOIN ({auc_sql('scored', 'p2')}) x"
    parts = " UNION ALL ".join(f"SELECT '{m}' AS metric, round(a.{m}, 6) AS \"Demo score\", round(b.{m}, 6) AS \"Index score\" "
                               f"FROM ({a}) a CROSS JOIN ({b}) b" for m in _E37)
    return parts


@register("a37_model_comparison_table", with_ctes(_a37_sql(), "scored"))
def a37_model_comparison_table(spark, sf):
    """Metric per row, one column per model (unpivot + pivot)."""
    df = scored(spark, sf)
    a = EV.clinical_metrics(df, model="Demo score")
    b = EV.clinical_metrics(df, pred="pred2", p="p2", model="Index score")
    long = a.unionByName(b).unpivot("model", _E37, "metric", "value")
    return long.groupBy("metric").pivot("model", ["Demo score", "Index score"]).agg(F.first("value"))


@register("a38_error_shares", with_ctes(
    f"SELECT round(avg(CAST({_ERR} = 'False Negative' AS INTEGER)), 6) AS fn_rate, "
    f"round(avg(CAST({_ERR} = 'False Positive' AS INTEGER)), 6) AS fp_rate FROM scored", "scored"))
def a38_error_shares(spark, sf):
    """Shares of false negatives and false positives over all rows."""
    df = errors(spark, sf)
    return df.agg(F.avg((F.col("error_type") == "False Negative").cast("int")).alias("fn_rate"),
                  F.avg((F.col("error_type") == "False Positive").cast("int")).alias("fp_rate"))


# ------------------------------------------------------------------ T
@register("t01_patient_admission_order", with_ctes(
    "SELECT patient_id, CAST(admission_key AS BIGINT) AS admission_key, CAST(row_number() OVER (PARTITION BY patient_id "
    "ORDER BY admission_date ASC NULLS LAST, admission_key) AS BIGINT) AS seq FROM clean", "clean"))
def t01_patient_admission_order(spark, sf):
    """Position of each admission within its patient (date, nulls last)."""
    df = cleaned_columns(spark, sf, ["patient_id", "admission_date"])
    return entity_sequence(df, "patient_id", "admission_date", "admission_key", prev_col=None, next_col=None).select(
        "patient_id", "admission_key", "seq")


@register("t02_top_importance", with_ctes(
    f"SELECT feature, round(importance, 6) AS importance FROM ({_importance_sql()}) ORDER BY importance DESC, feature LIMIT 10",
    "featured_pre"))
def t02_top_importance(spark, sf):
    """Ten most important features (|correlation| with the outcome)."""
    return importance(featured_pre(spark, sf)).orderBy(F.col("importance").desc(), "feature").limit(10)


@register("t03_top_values", with_ctes(
    "SELECT diagnosis_codes, CAST(count(*) AS BIGINT) AS n FROM clean WHERE diagnosis_codes IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5", "clean"))
def t03_top_values(spark, sf):
    """Five most frequent cleaned code strings."""
    return QA.value_counts(cleaned_columns(spark, sf, ["diagnosis_codes"]), "diagnosis_codes", 5)


@register("t05_top_high_risk_rows", with_ctes(
    f"SELECT CAST(admission_key AS BIGINT) AS admission_key, patient_id, round(p2, 6) AS p2 FROM scored "
    f"WHERE {_tier_sql('p2')} IN ('High', 'Very High') ORDER BY p2 DESC, admission_key LIMIT 10", "scored"))
def t05_top_high_risk_rows(spark, sf):
    """Ten highest-scored high-risk admissions (explicit order)."""
    df = scored(spark, sf).where(CL.probability_tier("p2").isin("High", "Very High"))
    return df.orderBy(F.col("p2").desc(), "admission_key").limit(10).select("admission_key", "patient_id", "p2")


@register("t06_preview_rows", with_ctes(out_sql(
    "admission_key:i patient_id:s age:d gender:s insurance_type:s", "clean", order="admission_key") + " LIMIT 5", "clean"))
def t06_preview_rows(spark, sf):
    """First five cleaned rows by key."""
    return (cleaned_columns(spark, sf, ["patient_id", "age", "gender", "insurance_type"]).orderBy("admission_key").limit(5)
            .select("admission_key", "patient_id", "age", "gender", "insurance_type"))


@register("t08_argmax_row", with_ctes(
    "SELECT arg_max(admission_key, (clinical_risk_score, -admission_key)) AS admission_key, "
    "round(max(clinical_risk_score), 6) AS clinical_risk_score FROM featured_pre", "featured_pre"))
def t08_argmax_row(spark, sf):
    """Admission with the highest clinical risk score (lowest key on ties)."""
    df = derived(spark, sf, "clinical_risk_score")
    return df.agg(F.max_by("admission_key", F.struct("clinical_risk_score", -F.col("admission_key"))).alias("admission_key"),
                  F.max("clinical_risk_score").alias("clinical_risk_score"))


# ------------------------------------------------------------------ J
@register("j07_importance_lists_joined", with_ctes(
    "SELECT a.feature, round(a.importance, 6) AS importance_outcome, round(b.importance, 6) AS importance_score "
    f"FROM ({_importance_sql()}) a JOIN ({_importance_sql('clinical_risk_score')}) b ON a.feature = b.feature",
    "featured_pre"))
def j07_importance_lists_joined(spark, sf):
    """Two importance lists matched by feature name (inner equi-join)."""
    df = featured_pre(spark, sf)
    a = importance(df).withColumnRenamed("importance", "importance_outcome")
    b = importance(df, "clinical_risk_score").withColumnRenamed("importance", "importance_score")
    return a.join(b, "feature")


@register("j10_top8_intersection", with_ctes(
    f"(SELECT feature FROM ({_importance_sql()}) ORDER BY importance DESC, feature LIMIT 8) INTERSECT "
    f"(SELECT feature FROM ({_importance_sql('clinical_risk_score')}) ORDER BY importance DESC NULLS LAST, feature LIMIT 8)",
    "featured_pre"))
def j10_top8_intersection(spark, sf):
    """Features in both top-8 lists."""
    df = featured_pre(spark, sf)
    a = importance(df).orderBy(F.col("importance").desc(), "feature").limit(8).select("feature")
    b = (importance(df, "clinical_risk_score").orderBy(F.col("importance").desc_nulls_last(), "feature").limit(8)
         .select("feature"))
    return a.intersect(b)
