"""The dependency graph gives the columns of the whole pipeline, and plans no more than it is asked for."""

import pytest

from wardflow import session
from wardflow.operators import derive as DV
from wardflow.operators.features import FeatureOptions, engineer_all_features
from wardflow.plans import q_features as QF
from wardflow.plans.q_cleaning import cleaned

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_columns_equal_the_whole_pipeline(spark):
    whole, added = engineer_all_features(cleaned(spark, SF), FeatureOptions(categorical_encoding=False))
    names = sorted(c for columns in added.values() for c in columns)
    assert set(names) == {n for n in DV.GRAPH if not n.startswith("__")}
    part = QF.derived(spark, SF, *names)
    assert sorted(map(str, part.collect())) == sorted(map(str, whole.select("admission_key", *names).collect()))


def test_needed_follows_the_graph():
    assert DV.needed(["admission_season"]) == ["admission_date"]
    assert DV.needed(["risk_category", "age"]) == ["admission_date", "admission_key", "age", "diagnosis_codes",
                                                   "emergency_admission", "patient_id", "previous_admissions"]


def test_a_month_stores_nothing_and_reads_two_columns(spark):
    before = len(session.stored_stages())
    df = QF.derived(spark, SF, "admission_month")
    assert len(session.stored_stages()) == before
    text = plan_text(df)
    assert "Join" not in text and "Window" not in text and "Aggregate" not in text
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:" in scan and "l_orderkey" not in scan


def test_codes_are_resolved_once_for_all_flags(spark):
    text = plan_text(QF.derived(spark, SF, "comorbidity_count"))
    assert text.count("transform(filter(") == 1, text[:2000]


def test_missing_inputs_raise(spark):
    with pytest.raises(ValueError, match="age"):
        DV.derive(spark.createDataFrame([(1,)], "admission_key long"), ["elderly"])
    with pytest.raises(ValueError, match="no_such"):
        DV.derive(spark.createDataFrame([(1,)], "admission_key long"), ["no_such"])


def test_an_existing_column_is_computed_anew_and_steps_are_dropped(spark):
    df = spark.createDataFrame([(1, 80.0, 7), (2, None, 7)], "k long, age double, elderly int")
    out = DV.derive(df, ["elderly"])
    assert out.columns == ["k", "age", "elderly"] and [r.elderly for r in out.orderBy("k").collect()] == [1, 0]
