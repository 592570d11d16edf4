"""Queries: code translation (K), feature columns (F), history windows (W),
feature pipeline and selection (X)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wardflow.functions import clinical as CL
from wardflow.operators import codes as K
from wardflow.operators import derive as DV
from wardflow.operators.features import (FEATURE_CATEGORIES, FeatureOptions, engineer_all_features,
                                         feature_summary, select_final_features)
from wardflow.operators.temporal import temporal_aggregates
from wardflow.plans.catalog import out_sql, register
from wardflow.plans.q_cleaning import cleaned, cleaned_columns
from wardflow.session import materialize
from wardflow.plans.sql import bins_sql, dbl, dummy_columns, flag_sql, lit, with_ctes


def coded(spark, sf):
    return materialize(K.create_condition_features(cleaned(spark, sf), "admission_key"), "coded")


def featured_pre(spark, sf):
    return materialize(engineer_all_features(cleaned(spark, sf), FeatureOptions(categorical_encoding=False))[0],
                       "featured")


def engineered(spark, sf):
    return engineer_all_features(cleaned(spark, sf))[0]


def featured(spark, sf):
    return materialize(engineered(spark, sf), "featured")


def derived(spark, sf, *columns):
    """The key and some derived columns, planned from the inputs they need."""
    base = cleaned_columns(spark, sf, DV.needed(columns))
    return DV.derive(base, columns).select("admission_key", *columns)


def tokens(spark, sf):
    return K.exploded_codes(cleaned_columns(spark, sf, ["diagnosis_codes"]), "admission_key")


FLAGS = " ".join(f"{f}:i" for f in K.FLAG_COLUMNS)


# ------------------------------------------------------------------- K
@register("k01_code_dimension_usage", with_ctes("""
SELECT CAST(d.ord AS BIGINT) AS ord, d.code, d.system, d.condition,
       CAST(count(DISTINCT t.admission_key) AS BIGINT) AS n_admissions
FROM code_dim d LEFT JOIN tokens t ON t.token = d.code
GROUP BY d.ord, d.code, d.system, d.condition""", "code_dim", "tokens"))
def k01_code_dimension_usage(spark, sf):
    """The 96-code dimension with the admissions that carry each code."""
    dim = K.code_dimension(spark)
    used = tokens(spark, sf).groupBy("token").agg(F.count_distinct("admission_key").alias("n_admissions"))
    return (dim.join(used, dim.code == used.token, "left")
            .select("ord", "code", "system", "condition",
                    F.coalesce("n_admissions", F.lit(0)).alias("n_admissions")))


@register("k02_tokenize_codes", with_ctes(out_sql("admission_key:i token:s", "tokens"), "tokens"))
def k02_tokenize_codes(spark, sf):
    """Code strings -> trimmed, upper-cased, non-blank tokens (one row each)."""
    return tokens(spark, sf)


@register("k03_exact_code_match", with_ctes(out_sql("token:s condition:s", "tok_exact"), "tok_exact"))
def k03_exact_code_match(spark, sf):
    """Distinct tokens with an exact dictionary hit."""
    dim = F.broadcast(K.code_dimension(spark))
    t = tokens(spark, sf).select("token").distinct()
    return t.join(dim, t.token == dim.code).select("token", "condition")


@register("k04_prefix_code_match", with_ctes(out_sql("token:s condition:s", "tok_loose"), "tok_loose"))
def k04_prefix_code_match(spark, sf):
    """Residual tokens resolved by the two-way stem prefix rule (first hit wins)."""
    dim = K.code_dimension(spark)
    mapping = K.resolve_tokens(tokens(spark, sf))
    return mapping.join(F.broadcast(dim.select(F.col("code").alias("token"))), "token", "left_anti")


@register("k05_condition_flags", with_ctes(out_sql("admission_key:i " + FLAGS, "coded"), "coded"))
def k05_condition_flags(spark, sf):
    """Seven has_<condition> flags per admission."""
    return derived(spark, sf, *K.FLAG_COLUMNS)


_K06 = " UNION ALL ".join(
    f"SELECT '{c}' AS condition, avg(has_{c}) AS prevalence, sum(has_{c}) AS n FROM coded" for c in K.CONDITIONS)


@register("k06_condition_summary", with_ctes(
    f"SELECT s.condition, round(s.prevalence, 6) AS prevalence, CAST(s.n AS BIGINT) AS count, d.description "
    f"FROM ({_K06}) s JOIN cond_dim d ON s.condition = d.condition", "coded", "cond_dim"))
def k06_condition_summary(spark, sf):
    """Prevalence, count and description per condition."""
    return K.condition_summary(coded(spark, sf))


@register("k07_conditions_per_code_string", with_ctes("""
SELECT c.diagnosis_codes, coalesce(array_to_string(list_sort(list(DISTINCT p.condition) FILTER (WHERE p.condition IS NOT NULL)), ','), '') AS conditions
FROM (SELECT DISTINCT admission_key, diagnosis_codes FROM clean) c
LEFT JOIN cond_pairs p ON c.admission_key = p.admission_key
GROUP BY c.diagnosis_codes""", "clean", "cond_pairs"))
def k07_conditions_per_code_string(spark, sf):
    """Distinct code strings and the sorted set of conditions they translate to."""
    return K.conditions_per_string(cleaned_columns(spark, sf, ["diagnosis_codes"]))


@register("k08_code_frequency_top15", with_ctes("""
SELECT code, CAST(n AS BIGINT) AS n FROM (
  SELECT trim(t) AS code, count(*) AS n FROM (
    SELECT unnest(string_split(diagnosis_codes, ';')) AS t FROM raw
    WHERE diagnosis_codes IS NOT NULL AND diagnosis_codes <> '') WHERE trim(t) <> ''
  GROUP BY 1) ORDER BY n DESC, code LIMIT 15""", "raw"))
def k08_code_frequency_top15(spark, sf):
    """Most frequent raw codes (split on ';' only), top 15."""
    from wardflow.sources.binding import admissions
    return K.code_frequency(admissions(spark, sf)).orderBy(F.col("n").desc(), "code").limit(15)


@register("k09_code_system_breakdown", with_ctes("""
SELECT CAST(count_if(regexp_matches(code, '\\d{3}\\.\\d')) AS BIGINT) AS icd9_like,
       CAST(count_if(regexp_matches(code, '[A-Z]\\d{2}\\.')) AS BIGINT) AS icd10_like,
       CAST(count_if(NOT regexp_matches(code, '\\d{3}\\.\\d|[A-Z]\\d{2}\\.')) AS BIGINT) AS local_other,
       CAST(count(*) AS BIGINT) AS distinct_codes
FROM (SELECT DISTINCT trim(t) AS code FROM (
    SELECT unnest(string_split(diagnosis_codes, ';')) AS t FROM raw
    WHERE diagnosis_codes IS NOT NULL AND diagnosis_codes <> '') WHERE trim(t) <> '')""", "raw"))
def k09_code_system_breakdown(spark, sf):
    """Distinct raw codes by look: ICD-9-like, ICD-10-like, other."""
    from wardflow.sources.binding import admissions
    freq = K.code_frequency(admissions(spark, sf))
    return K.code_system_breakdown(freq).crossJoin(freq.agg(F.count(F.lit(1)).alias("distinct_codes")))


@register("k10_mapping_inventory", with_ctes("""
SELECT d.condition, CAST(count(DISTINCT d.code) AS BIGINT) AS mapped_codes,
       CAST(count(DISTINCT e.token) AS BIGINT) AS observed_codes
FROM code_dim d LEFT JOIN tok_exact e ON e.token = d.code GROUP BY d.condition""", "code_dim", "tok_exact"))
def k10_mapping_inventory(spark, sf):
    """Codes per condition in the dictionary and how many of them occur."""
    dim = K.code_dimension(spark)
    seen = tokens(spark, sf).select("token").distinct()
    return (dim.join(seen, dim.code == seen.token, "left").groupBy("condition")
            .agg(F.count_distinct("code").alias("mapped_codes"), F.count_distinct("token").alias("observed_codes")))


# ---------------------------------------------------- F: one column each
_F_COLUMNS = [
    ("f01_recent_admission", "recent_admission", "i"),
    ("f02_frequent_readmitter", "frequent_readmitter", "i"),
    ("f03_admission_pattern", "admission_pattern", "s"),
    ("f04_admission_month", "admission_month", "i"),
    ("f05_admission_season", "admission_season", "s"),
    ("f06_admission_day_of_week", "admission_day_of_week", "i"),
    ("f07_weekend_admission", "weekend_admission", "i"),
    ("f08_age_group", "age_group", "s"),
    ("f09_elderly", "elderly", "i"),
    ("f10_age_squared", "age_squared", "d"),
    ("f11_emergency_elderly", "emergency_elderly", "i"),
    ("f12_comorbidity_count", "comorbidity_count", "i"),
    ("f13_multiple_comorbidities", "multiple_comorbidities", "i"),
    ("f14_high_risk_comorbidity", "high_risk_comorbidity", "i"),
    ("f15_cardiovascular_risk", "cardiovascular_risk", "i"),
    ("f16_clinical_risk_score", "clinical_risk_score", "d"),
    ("f17_risk_category", "risk_category", "s"),
    ("f18_high_risk_patient", "high_risk_patient", "i"),
    ("f19_los_category", "los_category", "s"),
    ("f20_long_stay", "long_stay", "i"),
    ("f21_admission_history", "admission_history", "s"),
]


def _feature_query(name: str, column: str, kind: str):
    def q(spark, sf):
        return derived(spark, sf, column)
    q.__name__ = name
    q.__doc__ = f"Feature column {column} per admission."
    register(name, with_ctes(out_sql(f"admission_key:i {column}:{kind}", "featured_pre"), "featured_pre"))(q)


for _n, _c, _k in _F_COLUMNS:
    _feature_query(_n, _c, _k)

_DUMMY_SPEC = " | ".join(f'"{d}"=\"{d}\":i' for _, _, d in dummy_columns())


@register("f22_one_hot_encoding", with_ctes(
    "SELECT CAST(admission_key AS BIGINT) AS admission_key, " + ", ".join(
        f'CAST("{d}" AS BIGINT) AS "{d}"' for _, _, d in dummy_columns()) + " FROM featured", "featured"))
def f22_one_hot_encoding(spark, sf):
    """<column>_std_<value> dummies for the seven categorical columns."""
    df = featured(spark, sf)
    return df.select("admission_key", *[f"`{d}`" for _, _, d in dummy_columns()])


@register("f23_exploration_bins", with_ctes(out_sql(
    f"admission_key:i | explore_age_group={bins_sql('age', CL.AGE_EDGES, CL.EXPLORE_AGE_LABELS)}:s | "
    f"explore_los_group={bins_sql('length_of_stay', CL.EXPLORE_LOS_EDGES, CL.EXPLORE_LOS_LABELS)}:s", "raw"), "raw"))
def f23_exploration_bins(spark, sf):
    """Exploration bins of raw age and length of stay (labels with spaces)."""
    from wardflow.sources.binding import admissions
    df = admissions(spark, sf)
    return df.select("admission_key",
                     CL.right_closed_bins(F.col("age"), CL.AGE_EDGES, CL.EXPLORE_AGE_LABELS).alias("explore_age_group"),
                     CL.right_closed_bins(F.col("length_of_stay"), CL.EXPLORE_LOS_EDGES,
                                          CL.EXPLORE_LOS_LABELS).alias("explore_los_group"))


SCORE_BIN_LABELS = ["Very Low", "Low", "Medium", "High", "Very High"]


def _score_bin_sql() -> str:
    w = "((mx - mn) / 5.0)"
    whens = " ".join(f"WHEN clinical_risk_score <= mn + {k} * {w} THEN {lit(lab)}"
                     for k, lab in enumerate(SCORE_BIN_LABELS[:-1], start=1))
    return f"(CASE {whens} ELSE {lit(SCORE_BIN_LABELS[-1])} END)"


@register("f24_score_equal_width_bins", with_ctes(out_sql(
    f"admission_key:i | risk_score_bin={_score_bin_sql()}:s",
    "featured_pre CROSS JOIN (SELECT min(clinical_risk_score) AS mn, max(clinical_risk_score) AS mx FROM featured_pre) b"),
    "featured_pre"))
def f24_score_equal_width_bins(spark, sf):
    """Five equal-width bins of the clinical risk score over its min..max."""
    df = materialize(derived(spark, sf, "clinical_risk_score"), "score")
    mm = df.select(F.struct(F.min("clinical_risk_score").alias("mn"),
                            F.max("clinical_risk_score").alias("mx")).alias("m")).scalar()
    return df.select("admission_key", CL.equal_width_bin("clinical_risk_score", mm.getField("mn"),
                                                         mm.getField("mx"), SCORE_BIN_LABELS).alias("risk_score_bin"))


def demo_score_sql() -> str:
    n = " + ".join(flag_sql(p) for p in ["age > 75", "has_diabetes = 1", "has_hypertension = 1",
                                          "has_heart_disease = 1", "length_of_stay > 7",
                                          "previous_admissions >= 3", "emergency_admission = 1"])
    return f"least({dbl(CL.DEMO_CAP)}, {dbl(CL.DEMO_BASE)} + ({n}) * {dbl(CL.DEMO_STEP)})"


def tier_sql(p: str) -> str:
    whens = " ".join(f"WHEN {p} < {dbl(b)} THEN {lit(lab)}" for b, lab in CL.TIER_BOUNDS)
    return f"(CASE {whens} ELSE {lit(CL.TIER_TOP)} END)"


def advice_sql(t: str, texts=CL.BATCH_ADVICE) -> str:
    whens = " ".join(f"WHEN {t} = {lit(k)} THEN {lit(v)}" for k, v in texts.items())
    return f"(CASE {whens} ELSE {lit(texts['Low'])} END)"


@register("f25_demo_risk_score", with_ctes(out_sql(f"admission_key:i | demo_score={demo_score_sql()}:d", "coded"), "coded"))
def f25_demo_risk_score(spark, sf):
    """Additive demo score: 0.15 + 0.08 per factor, capped at 0.95."""
    return coded(spark, sf).select("admission_key", CL.demo_risk_score().alias("demo_score"))


@register("f26_probability_tier", with_ctes(out_sql(
    f"admission_key:i | risk_tier={tier_sql(demo_score_sql())}:s", "coded"), "coded"))
def f26_probability_tier(spark, sf):
    """Tier of a probability-like score: Low / Moderate / High / Very High."""
    return coded(spark, sf).select("admission_key", CL.probability_tier(CL.demo_risk_score()).alias("risk_tier"))


@register("f27_recommendation_text", with_ctes(out_sql(
    f"admission_key:i | recommendation={advice_sql(tier_sql(demo_score_sql()))}:s | "
    f"app_recommendation={advice_sql(tier_sql(demo_score_sql()), CL.APP_ADVICE)}:s", "coded"), "coded"))
def f27_recommendation_text(spark, sf):
    """Advice text per tier (batch and interactive wording)."""
    tier = CL.probability_tier(CL.demo_risk_score())
    return coded(spark, sf).select("admission_key", CL.recommendation(tier).alias("recommendation"),
                                   CL.recommendation(tier, CL.APP_ADVICE).alias("app_recommendation"))


@register("f28_legacy_risk_flags", with_ctes(out_sql(
    "admission_key:i | legacy_high_risk=CAST(coalesce(elderly = 1, false) OR coalesce(previous_admissions >= 3, false) "
    "OR coalesce(comorbidity_count >= 3, false) AS INTEGER):i | "
    f"legacy_age_group={bins_sql('age', [float('-inf'), 40, 60, 80, float('inf')], CL.AGE_LABELS, left=True)}:s",
    "featured_pre"), "featured_pre"))
def f28_legacy_risk_flags(spark, sf):
    """Modelling-table variants: high risk without the frequent term, left-closed age groups."""
    df = derived(spark, sf, "elderly", "previous_admissions", "comorbidity_count", "age")
    return df.select("admission_key",
                     CL.high_risk_patient(set(df.columns), include_frequent=False).alias("legacy_high_risk"),
                     CL.age_group_left_closed("age").alias("legacy_age_group"))


def readable_sql(x: str) -> str:
    cap = (f"array_to_string(list_transform(list_filter(string_split(replace(replace(replace({x}, 'has_', ''), "
           f"'_std_', ' '), '_', ' '), ' '), lambda w: w <> ''), lambda w: upper(w[1]) || lower(w[2:])), ' ')")
    for old, new in (("Copd", "COPD"), ("Ppv", "PPV"), ("Npv", "NPV"), ("Auc", "AUC"), ("Los", "Length of Stay")):
        cap = f"replace({cap}, {lit(old)}, {lit(new)})"
    return cap


_HAS_COND = "'has_' || s.condition"


@register("f29_readable_condition_names", with_ctes(
    f"SELECT s.condition, {readable_sql(_HAS_COND)} AS label, round(s.prevalence, 6) AS prevalence "
    f"FROM ({_K06}) s", "coded"))
def f29_readable_condition_names(spark, sf):
    """Readable labels for the condition rows of the prevalence report."""
    s = K.condition_summary(coded(spark, sf))
    return s.select("condition", CL.readable_feature_name(F.concat(F.lit("has_"), F.col("condition"))).alias("label"),
                    "prevalence")


@register("f30_error_type", with_ctes(out_sql(
    f"admission_key:i | error_type=(CASE WHEN readmission_30_day = 1 AND {demo_score_sql()} < 0.35 THEN 'False Negative' "
    f"WHEN readmission_30_day = 0 AND {demo_score_sql()} >= 0.35 THEN 'False Positive' ELSE 'Correct' END):s", "coded"),
    "coded"))
def f30_error_type(spark, sf):
    """Correct / False Negative / False Positive for the score >= 0.35 rule."""
    df = coded(spark, sf)
    pred = (CL.demo_risk_score() >= 0.35).cast("int")
    return df.select("admission_key", CL.error_type("readmission_30_day", pred).alias("error_type"))


# ------------------------------------------------------------------- W
_W_SQL = """
  SELECT admission_key,
    count(*) OVER (PARTITION BY patient_id) AS admissions_last_365d,
    avg(length_of_stay) OVER (PARTITION BY patient_id) AS avg_los_last_365d,
    avg(emergency_admission) OVER (PARTITION BY patient_id) AS emergency_rate_last_365d,
    coalesce(floor((epoch(admission_date) - epoch(lag(admission_date) OVER (PARTITION BY patient_id
        ORDER BY admission_date ASC NULLS LAST, admission_key))) / 86400), 999) AS days_since_last
  FROM clean"""


def _history(spark, sf, *columns):
    """Patient history from the patient, the date and the columns that it summarises."""
    return temporal_aggregates(cleaned_columns(spark, sf, ["patient_id", "admission_date", *columns]), with_days_since=not columns)


@register("w01_days_since_last_admission", with_ctes(out_sql("admission_key:i days_since_last:i", f"({_W_SQL})"), "clean"))
def w01_days_since_last_admission(spark, sf):
    """Days since the patient's previous admission (first -> 999)."""
    return _history(spark, sf).select("admission_key", "days_since_last")


@register("w02_admissions_per_patient", with_ctes(out_sql("admission_key:i admissions_last_365d:i", f"({_W_SQL})"), "clean"))
def w02_admissions_per_patient(spark, sf):
    """Admissions of the patient, on every row."""
    return _history(spark, sf).select("admission_key", "admissions_last_365d")


@register("w03_avg_stay_per_patient", with_ctes(out_sql("admission_key:i avg_los_last_365d:d", f"({_W_SQL})"), "clean"))
def w03_avg_stay_per_patient(spark, sf):
    """Mean length of stay of the patient, on every row."""
    return _history(spark, sf, "length_of_stay").select("admission_key", "avg_los_last_365d")


@register("w04_emergency_rate_per_patient", with_ctes(out_sql("admission_key:i emergency_rate_last_365d:d", f"({_W_SQL})"), "clean"))
def w04_emergency_rate_per_patient(spark, sf):
    """Emergency rate of the patient, on every row."""
    return _history(spark, sf, "emergency_admission").select("admission_key", "emergency_rate_last_365d")


@register("w07_tier_share_of_total", with_ctes(
    f"SELECT risk_tier, CAST(count(*) AS BIGINT) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share "
    f"FROM (SELECT {tier_sql(demo_score_sql())} AS risk_tier FROM coded) GROUP BY risk_tier", "coded"))
def w07_tier_share_of_total(spark, sf):
    """Tier counts and their share of all rows."""
    df = coded(spark, sf).select(CL.probability_tier(CL.demo_risk_score()).alias("risk_tier"))
    counts = df.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("share", F.col("n") / total)


@register("w08_normalised_prevalence", with_ctes(
    f"SELECT condition, round(prevalence / max(prevalence) OVER (), 6) AS relative_prevalence FROM ({_K06})", "coded"))
def w08_normalised_prevalence(spark, sf):
    """Condition prevalence divided by the largest one (top = 1)."""
    s = K.condition_summary(coded(spark, sf))
    top = s.agg(F.max("prevalence")).scalar()
    return s.select("condition", (F.col("prevalence") / top).alias("relative_prevalence"))


# ------------------------------------------------------------------- X
def _featured_spec() -> str:
    base = ("admission_key:i patient_id:s age:d gender:s admission_date:t length_of_stay:d emergency_admission:d "
            "diagnosis_codes:s previous_admissions:i insurance_type:s readmission_30_day:i " + FLAGS +
            " days_since_last_admission:d recent_admission:i frequent_readmitter:i admission_pattern:s "
            "admission_month:i admission_season:s admission_day_of_week:i weekend_admission:i age_group:s elderly:i "
            "age_squared:d emergency_elderly:i comorbidity_count:i multiple_comorbidities:i high_risk_comorbidity:i "
            "cardiovascular_risk:i clinical_risk_score:d risk_category:s high_risk_patient:i los_category:s "
            "long_stay:i admission_history:s")
    return base


@register("x01_feature_pipeline", with_ctes(out_sql(_featured_spec(), "featured_pre"), "featured_pre"))
def x01_feature_pipeline(spark, sf):
    """Whole feature pipeline before encoding (all derived columns)."""
    return featured_pre(spark, sf)


@register("x02_days_since_feature", with_ctes(out_sql("admission_key:i days_since_last_admission:d", "featured_pre"),
                                              "featured_pre"))
def x02_days_since_feature(spark, sf):
    """Days since last admission when there are earlier admissions, else 999."""
    return derived(spark, sf, "days_since_last_admission")


def _final_feature_sql() -> str:
    cols = ("age length_of_stay emergency_admission previous_admissions " + " ".join(K.FLAG_COLUMNS) +
            " days_since_last_admission recent_admission frequent_readmitter admission_month "
            "admission_day_of_week weekend_admission elderly age_squared emergency_elderly comorbidity_count "
            "multiple_comorbidities high_risk_comorbidity cardiovascular_risk clinical_risk_score "
            "high_risk_patient long_stay").split()
    cols += [d for _, _, d in dummy_columns()]
    items = ", ".join(f'round(coalesce(CAST("{c}" AS DOUBLE), 0.0), 6) AS "{c}"' for c in cols)
    return f"SELECT CAST(admission_key AS BIGINT) AS admission_key, {items}, round(CAST(readmission_30_day AS DOUBLE), 6) AS label FROM featured"


@register("x03_final_feature_matrix", with_ctes(_final_feature_sql(), "featured"))
def x03_final_feature_matrix(spark, sf):
    """Numeric model inputs (nulls -> 0, as double) plus the label."""
    return select_final_features(featured(spark, sf))[0]


_X05_COLUMNS = [p.rsplit(":", 1)[0] for p in _featured_spec().split()]


@register("x05_feature_missing_summary", with_ctes(
    "SELECT column_name AS \"column\", CAST(missing AS BIGINT) AS missing FROM (UNPIVOT (SELECT " + ", ".join(
        f'count_if("{c}" IS NULL) AS "{c}"' for c in _X05_COLUMNS) +
    " FROM featured_pre) ON COLUMNS(*) INTO NAME column_name VALUE missing)", "featured_pre"))
def x05_feature_missing_summary(spark, sf):
    """Missing values of every column of the feature table (one pass)."""
    return feature_summary(featured_pre(spark, sf))[0].select("column", "missing")


def _category_sql() -> str:
    names = ", ".join(f"({lit(c)})" for c in _X05_COLUMNS)
    return " UNION ALL ".join(f"SELECT {lit(cat)} AS category, CAST(count_if(regexp_matches(c, {lit(pattern)})) AS BIGINT) AS n_features "
                              f"FROM (VALUES {names}) v(c)" for cat, pattern in FEATURE_CATEGORIES.items())


@register("x05_feature_category_counts", _category_sql())
def x05_feature_category_counts(spark, sf):
    """Columns of the feature table per category (a column may belong to several)."""
    return feature_summary(featured_pre(spark, sf))[1]


# Expected model inputs that the scoring table lacks (defaults by name rule).
_ALIGN_EXTRA = ["has_stroke", "age_years", "insurance_type_std_Tricare", "prior_visits", "recent_admission"]


@register("x04_scoring_alignment", with_ctes(
    "SELECT CAST(admission_key AS BIGINT) AS admission_key, round(CAST(age AS DOUBLE), 6) AS age, "
    "round(CAST(clinical_risk_score AS DOUBLE), 6) AS clinical_risk_score, CAST(0 AS DOUBLE) AS has_stroke, "
    "round(CAST(age AS DOUBLE), 6) AS age_years, CAST(0 AS DOUBLE) AS insurance_type_std_Tricare, "
    "CAST(0 AS DOUBLE) AS prior_visits, CAST(0 AS DOUBLE) AS recent_admission FROM featured_pre", "featured_pre"))
def x04_scoring_alignment(spark, sf):
    """Scoring rows aligned to a model's input list: missing inputs are
    defaulted by name (dummies, flags, admissions, risk -> 0; age-like ->
    age; else 0), in model order."""
    from wardflow.ml.scoring import align_features
    df = derived(spark, sf, "age", "clinical_risk_score")
    aligned, missing = align_features(df, ["age", "clinical_risk_score"] + _ALIGN_EXTRA)
    assert missing == _ALIGN_EXTRA
    return aligned


_BOUNDED_SQL = """
  SELECT admission_key,
    CASE WHEN d IS NOT NULL THEN count(*) OVER w END AS admissions_in_365d,
    CASE WHEN d IS NOT NULL THEN avg(length_of_stay) OVER w END AS avg_los_in_365d,
    CASE WHEN d IS NOT NULL THEN avg(emergency_admission) OVER w END AS emergency_rate_in_365d
  FROM (SELECT *, date_diff('day', DATE '1970-01-01', CAST(admission_date AS DATE)) AS d FROM clean)
  WINDOW w AS (PARTITION BY patient_id ORDER BY d RANGE BETWEEN 365 PRECEDING AND CURRENT ROW)"""


@register("w02_admissions_in_365d_window", with_ctes(out_sql(
    "admission_key:i admissions_in_365d:i avg_los_in_365d:d emergency_rate_in_365d:d", f"({_BOUNDED_SQL})"), "clean"))
def w02_admissions_in_365d_window(spark, sf):
    """Per-patient admissions, mean stay and emergency rate over the
    admissions of the 365 days up to the admission day (documented form)."""
    from wardflow.operators.temporal import bounded_aggregates
    df = cleaned_columns(spark, sf, ["patient_id", "admission_date", "length_of_stay", "emergency_admission"])
    return bounded_aggregates(df).select("admission_key", "admissions_in_365d", "avg_los_in_365d",
                                                         "emergency_rate_in_365d")
