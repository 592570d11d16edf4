"""Queries: admission binding, cleaning and imputation (S, C ids)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow.functions.dates import days_since, parse_date
from wardflow.functions.text import standardize_gender, standardize_insurance
from wardflow.operators import cleaning as CLN
from wardflow.plans.catalog import out_sql, register
from wardflow.plans.sql import gender_sql, insurance_sql, parse_date_sql, sentinel_sql, with_ctes
from wardflow.sources.binding import admissions

RAW_SPEC = ("admission_key:i patient_id:s age:d gender:s admission_date:s length_of_stay:d "
            "emergency_admission:i diagnosis_codes:s previous_admissions:i insurance_type:s "
            "readmission_30_day:i")
CLEAN_SPEC = ("admission_key:i patient_id:s age:d gender:s admission_date:t length_of_stay:d "
              "emergency_admission:d diagnosis_codes:s previous_admissions:i insurance_type:s "
              "readmission_30_day:i")


def texted(spark, sf):
    return CLN.clean_text_fields(admissions(spark, sf))


def standardized(spark, sf):
    from wardflow.session import materialize
    df = texted(spark, sf)
    return materialize(CLN.parse_date_columns(CLN.standardize_insurance_columns(CLN.standardize_gender_columns(df))),
                       "standardised")


def clipped(spark, sf):
    return CLN.handle_outliers(standardized(spark, sf), "length_of_stay", "clip")


def cleaned(spark, sf):
    return CLN.impute_missing_values(clipped(spark, sf))[0]


def cleaned_columns(spark, sf, columns):
    """The key and some columns of :func:`cleaned`, computed from these columns alone:
    every cleaning step of a column looks at that column only."""
    columns = [c for c in columns if c != "admission_key"]
    raw = admissions(spark, sf, ["admission_key", *columns])
    out = CLN.clean_text_fields(raw)
    out = CLN.parse_date_columns(CLN.standardize_insurance_columns(CLN.standardize_gender_columns(out)))
    for c in set(CLN.outlier_columns(out)) & set(columns):
        out = CLN.handle_outliers(out, c, "clip")
    return CLN.impute_missing_values(out, columns=columns)[0]


@register("b00_raw_admissions", with_ctes(out_sql(RAW_SPEC, "raw"), "raw"))
def b00_raw_admissions(spark, sf):
    """Derived raw admission table (dirty values, documented schema)."""
    return admissions(spark, sf)


@register("c01_standardize_gender", with_ctes(out_sql(
    f"admission_key:i | gender={gender_sql('gender')}:s", "raw"), "raw"))
def c01_standardize_gender(spark, sf):
    """Dictionary mapping on the raw text (case-sensitive keys)."""
    return admissions(spark, sf).select("admission_key", standardize_gender("gender").alias("gender"))


@register("c02_standardize_insurance", with_ctes(out_sql(
    f"admission_key:i | insurance_type={insurance_sql('insurance_type')}:s", "raw"), "raw"))
def c02_standardize_insurance(spark, sf):
    """Keyword classifier on the raw text."""
    return admissions(spark, sf).select("admission_key",
                                        standardize_insurance("insurance_type").alias("insurance_type"))


@register("c03_parse_dates", with_ctes(out_sql(
    f"admission_key:i | admission_date={parse_date_sql('admission_date')}:t", "raw"), "raw"))
def c03_parse_dates(spark, sf):
    """Multi-format date parsing of the raw text (first format that parses wins)."""
    return admissions(spark, sf).select("admission_key", parse_date("admission_date").alias("admission_date"))


@register("c04_parse_success", with_ctes(out_sql(
    f"column='admission_date':s | total=count(*):i | failed=count_if({sentinel_sql('admission_date')}):i | "
    f"unparsed=count_if({parse_date_sql('admission_date')} IS NULL):i | "
    f"success_rate=(count(*) - count_if({sentinel_sql('admission_date')})) * 100.0 / count(*):d", "raw"), "raw"))
def c04_parse_success(spark, sf):
    """Parse metric: sentinel failures (as reported) and all unparsed rows."""
    return CLN.date_parse_report(admissions(spark, sf), "admission_date")


@register("c05_clean_text", with_ctes(out_sql(
    "admission_key:i patient_id:s gender:s admission_date:s diagnosis_codes:s insurance_type:s", "texted"),
    "texted"))
def c05_clean_text(spark, sf):
    """Trim, title-case gender/insurance, strip punctuation from id columns."""
    return texted(spark, sf).select("admission_key", "patient_id", "gender", "admission_date",
                                    "diagnosis_codes", "insurance_type")


def _legacy_sql():
    from wardflow.plans.sql import _clean_text_select
    inner = _clean_text_select("raw", legacy=True)
    return with_ctes(out_sql(f"admission_key:i | gender={gender_sql('gender')}:s | "
                             f"insurance_type={insurance_sql('insurance_type')}:s",
                             f"({inner}) t"), "raw")


@register("c06_legacy_null_text", _legacy_sql())
def c06_legacy_null_text(spark, sf):
    """Legacy text cast: null becomes 'nan' before standardisation."""
    df = CLN.clean_text_fields(admissions(spark, sf), legacy_nulls=True)
    df = CLN.standardize_insurance_columns(CLN.standardize_gender_columns(df))
    return df.select("admission_key", "gender", "insurance_type")


def _bounds_sql(lo: float, hi: float, src: str = "raw") -> str:
    return (f"SELECT quantile_cont(length_of_stay, {lo}) AS lo, "
            f"quantile_cont(length_of_stay, {hi}) AS hi FROM {src}")


CLIP_EXPR = ("CASE WHEN length_of_stay IS NULL THEN NULL "
             "ELSE least(greatest(length_of_stay, b.lo), b.hi) END")


@register("c07_clip_outliers", with_ctes(out_sql(
    f"admission_key:i | length_of_stay={CLIP_EXPR}:d", f"raw CROSS JOIN ({_bounds_sql(0.01, 0.99)}) b"), "raw"))
def c07_clip_outliers(spark, sf):
    """Clip length of stay to its 1st / 99th percentiles (nulls kept)."""
    return CLN.handle_outliers(admissions(spark, sf), "length_of_stay", "clip").select(
        "admission_key", "length_of_stay")


@register("c08_remove_outliers_iqr", with_ctes(out_sql(
    "admission_key:i length_of_stay:d",
    f"raw CROSS JOIN ({_bounds_sql(0.25, 0.75)}) b",
    "length_of_stay >= b.lo - 1.5 * (b.hi - b.lo) AND length_of_stay <= b.hi + 1.5 * (b.hi - b.lo)"), "raw"))
def c08_remove_outliers_iqr(spark, sf):
    """Keep rows inside the 1.5 IQR fences of length of stay."""
    return CLN.handle_outliers(admissions(spark, sf), "length_of_stay", "remove").select(
        "admission_key", "length_of_stay")


@register("c09_cap_outliers", with_ctes(out_sql(
    f"admission_key:i | length_of_stay={CLIP_EXPR}:d", f"raw CROSS JOIN ({_bounds_sql(0.05, 0.95)}) b"), "raw"))
def c09_cap_outliers(spark, sf):
    """Cap length of stay at its 5th / 95th percentiles."""
    return CLN.handle_outliers(admissions(spark, sf), "length_of_stay", "cap").select(
        "admission_key", "length_of_stay")


@register("c10_outliers_none", with_ctes(out_sql("admission_key:i length_of_stay:d", "raw"), "raw"))
def c10_outliers_none(spark, sf):
    """Unknown outlier method: column unchanged."""
    return CLN.handle_outliers(admissions(spark, sf), "length_of_stay", "none").select(
        "admission_key", "length_of_stay")


@register("c11_impute_age_median", with_ctes(out_sql("admission_key:i age:d", "clean"), "clean"))
def c11_impute_age_median(spark, sf):
    """Age-like columns: median fill."""
    return cleaned_columns(spark, sf, ["age"])


@register("c12_impute_previous_zero", with_ctes(out_sql("admission_key:i previous_admissions:i", "clean"), "clean"))
def c12_impute_previous_zero(spark, sf):
    """Previous-admission counts: zero fill."""
    return cleaned_columns(spark, sf, ["previous_admissions"])


@register("c13_impute_stay_median", with_ctes(out_sql("admission_key:i length_of_stay:d", "clean"), "clean"))
def c13_impute_stay_median(spark, sf):
    """Length of stay: median fill after clipping."""
    return cleaned_columns(spark, sf, ["length_of_stay"])


@register("c14_impute_text_mode", with_ctes("""
SELECT CAST(admission_key AS BIGINT) AS admission_key,
       coalesce(gender, (SELECT gender FROM raw WHERE gender IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS gender,
       coalesce(insurance_type, (SELECT insurance_type FROM raw WHERE insurance_type IS NOT NULL
                                 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS insurance_type,
       diagnosis_codes
FROM raw""", "raw"))
def c14_impute_text_mode(spark, sf):
    """Text columns: most frequent value (smallest on ties); code lists stay as they are."""
    df = admissions(spark, sf).select(F.col("admission_key").cast("bigint").alias("admission_key"), "gender", "insurance_type", "diagnosis_codes")
    return CLN.impute_missing_values(df)[0]


@register("c15_impute_numeric_median", with_ctes(out_sql("admission_key:i emergency_admission:d", "clean"), "clean"))
def c15_impute_numeric_median(spark, sf):
    """Other numeric columns: median fill (integers become double)."""
    return cleaned_columns(spark, sf, ["emergency_admission"])


_IMPUTE_REPORT_SQL = with_ctes("""
SELECT column_name AS "column", rule, round(numeric_value, 6) AS numeric_value, text_value,
       CAST(filled AS BIGINT) AS filled FROM (
  SELECT 'age' AS column_name, 'median' AS rule, age_med AS numeric_value, NULL AS text_value,
         (SELECT count(*) FROM clipped WHERE age IS NULL) AS filled FROM clean_stats
  UNION ALL SELECT 'length_of_stay', 'median', los_med, NULL,
         (SELECT count(*) FROM clipped WHERE length_of_stay IS NULL) FROM clean_stats
  UNION ALL SELECT 'emergency_admission', 'median', em_med, NULL,
         (SELECT count(*) FROM clipped WHERE emergency_admission IS NULL) FROM clean_stats
  UNION ALL SELECT 'previous_admissions', 'zero', 0.0, NULL,
         (SELECT count(*) FROM clipped WHERE previous_admissions IS NULL) FROM clean_stats
) r""", "clipped", "clean_stats")


@register("c16_imputation_report", _IMPUTE_REPORT_SQL)
def c16_imputation_report(spark, sf):
    """Column, rule, fill value and filled rows of the imputation step."""
    return CLN.impute_missing_values(clipped(spark, sf))[1]


_COERCED = ["admission_date", "diagnosis_codes", "insurance_type", "gender", "patient_id"]


@register("c17_numeric_coercion", with_ctes(out_sql(
    "admission_key:i | " + " | ".join(f"{c}=try_cast(trim({c}) AS DOUBLE):d" for c in _COERCED) +
    " | first_code_value=try_cast(trim(split_part(diagnosis_codes, ';', 1)) AS DOUBLE):d", "raw"), "raw"))
def c17_numeric_coercion(spark, sf):
    """Text -> number with bad text -> null, for every text column as a whole and
    for the first code of a list."""
    df = admissions(spark, sf, ["admission_key", *_COERCED])
    df = df.withColumn("first_code_value", F.split_part(F.col("diagnosis_codes"), F.lit(";"), F.lit(1)))
    texts = [*_COERCED, "first_code_value"]
    return CLN.coerce_numeric(df.withColumns({c: F.trim(c) for c in texts}), texts)


@register("c18_fill_remaining_zero", with_ctes(out_sql(
    "admission_key:i | age=coalesce(age, 0):d | length_of_stay=coalesce(length_of_stay, 0):d | "
    "emergency_admission=coalesce(emergency_admission, 0):i | previous_admissions=coalesce(previous_admissions, 0):i",
    "raw"), "raw"))
def c18_fill_remaining_zero(spark, sf):
    """Remaining numeric nulls -> 0."""
    df = admissions(spark, sf).select("admission_key", "age", "length_of_stay", "emergency_admission",
                                      "previous_admissions")
    return CLN.fill_remaining(df, 0)


@register("c19_days_since_reference", with_ctes(out_sql(
    "admission_key:i | admission_date_days=date_diff('day', DATE '2014-01-01', CAST(admission_date AS DATE)):i",
    "clean"), "clean"))
def c19_days_since_reference(spark, sf):
    """Dates -> whole days since 2014-01-01."""
    return cleaned_columns(spark, sf, ["admission_date"]).select("admission_key", days_since("admission_date").alias("admission_date_days"))


@register("c20_prepare_for_modeling", with_ctes(out_sql(
    "admission_key:i age:d length_of_stay:d emergency_admission:d previous_admissions:i | "
    "admission_date_days=date_diff('day', DATE '2014-01-01', CAST(admission_date AS DATE)):i | "
    "label=readmission_30_day:i", "clean"), "clean"))
def c20_prepare_for_modeling(spark, sf):
    """Dates -> days, text and identifier columns dropped, target split off."""
    return CLN.prepare_for_modeling(cleaned(spark, sf))


@register("c21_clean_pipeline", with_ctes(out_sql(CLEAN_SPEC, "clean"), "clean"))
def c21_clean_pipeline(spark, sf):
    """Whole cleaning pipeline: text, gender, insurance, dates, clip, impute."""
    return CLN.process_pipeline(admissions(spark, sf), CLN.CleaningOptions(validate_quality=False))[0]
