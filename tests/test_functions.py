"""Expression tests on literal rows: text, dates, bins, scores, tiers."""

import datetime as dt

from pyspark.sql import functions as F

from wardflow.functions import clinical as CL
from wardflow.functions.dates import parse_date
from wardflow.functions.text import standardize_gender, standardize_insurance, title_case


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_title_case_matches_python(spark):
    values = ["self-pay", "o'neil 3rd", "MALE", "m", "", "blue cross", "x-y_z"]
    assert col_values(spark, values, title_case) == [v.title() for v in values]


def test_gender_mapping_is_case_sensitive(spark):
    got = col_values(spark, ["M", "male", "Male", "female", "FEMALE", "", None, "UNK", "x"], standardize_gender)
    assert got == ["Male", "Unknown", "Male", "Female", "Female", "Unknown", "Unknown", "Unknown", "Unknown"]


def test_insurance_keywords_in_order(spark):
    got = col_values(spark, ["medicare", " mcd ", "Commercial", "self pay", "cash", "Unknown", "", None,
                             "MEDICARE/MEDICAID", "Blue Cross"], standardize_insurance)
    assert got == ["Medicare", "Medicaid", "Private", "Self-Pay", "Self-Pay", "Other", "Unknown", "Unknown",
                   "Medicare", "Other"]


def test_date_formats_first_success_wins(spark):
    got = col_values(spark, ["2014-03-15", "01/22/2014", "15-06-2014", "20140812", "01-05-2014", "05/01/2014",
                             "2014/3/5", "2014-03-05 13:00:00", "March 5, 2014", "INVALID_DATE", "", "none", None],
                     parse_date)
    d = dt.datetime
    assert got == [d(2014, 3, 15), d(2014, 1, 22), d(2014, 6, 15), d(2014, 8, 12), d(2014, 5, 1), d(2014, 5, 1),
                   d(2014, 3, 5), d(2014, 3, 5, 13), d(2014, 3, 5), None, None, None, None]


def test_age_groups_right_closed(spark):
    got = col_values(spark, [0.0, 0.5, 40.0, 40.1, 80.0, 100.0, 100.5, None], CL.age_group, "double")
    assert got == [None, "Under_40", "Under_40", "40_60", "60_80", "Over_80", None, None]


def test_risk_category_and_history_bins(spark):
    assert col_values(spark, [0.0, 2.0, 2.1, 4.0, 6.0, 6.1], CL.risk_category, "double") == \
        ["Low", "Low", "Moderate", "Moderate", "High", "Very_High"]
    assert col_values(spark, [0, 1, 2, 3, 5, 6], CL.admission_history, "int") == \
        ["None", "Low", "Low", "Moderate", "Moderate", "High"]


def test_season_null_month_is_fall(spark):
    assert col_values(spark, [12, 1, 3, 6, 9, None], CL.season, "int") == \
        ["Winter", "Winter", "Spring", "Summer", "Fall", "Fall"]


def test_demo_score_profiles(spark):
    rows = [(80.0, 1, 1, 1, 8.0, 4, 1), (50.0, 0, 0, 0, 3.0, 0, 1), (30.0, 0, 0, 0, 2.0, 1, 1)]
    df = spark.createDataFrame(rows, "age double, has_diabetes int, has_hypertension int, has_heart_disease int, "
                                     "length_of_stay double, previous_admissions int, emergency_admission int")
    got = [round(r[0], 6) for r in df.select(CL.demo_risk_score()).collect()]
    assert got == [0.71, 0.23, 0.23]


def test_probability_tiers(spark):
    got = col_values(spark, [0.0, 0.19, 0.2, 0.49, 0.5, 0.79, 0.8, 1.0], CL.probability_tier, "double")
    assert got == ["Low", "Low", "Moderate", "Moderate", "High", "High", "Very High", "Very High"]


def test_readable_feature_names(spark):
    got = col_values(spark, ["has_heart_disease", "gender_std_Male", "has_copd", "los_category_std_Long"],
                     CL.readable_feature_name)
    assert got == ["Heart Disease", "Gender Male", "COPD", "Length of Stay Category Long"]


def test_feature_categories():
    from wardflow.operators.features import feature_category_counts
    got = feature_category_counts(["age", "age_group", "has_copd", "gender_std_Male", "recent_admission", "high_risk_patient", "long_stay"])
    assert got == {"Core Demographics": 2, "Medical Conditions": 1, "Temporal Features": 1, "Clinical Risk": 1, "Utilization": 0,
                   "Categorical Encoded": 1}
