"""Saved preparation, training job, result document and report."""

import json
import math

import pytest
from pyspark.sql import functions as F

from wardflow.ml import jobs as J
from wardflow.ml.preparation import fit_preparation, load_preparation
from wardflow.ml.scoring import batch_scoring_job, score_raw
from wardflow.ml.training import load_model
from wardflow.plans.q_ml import RAW_SCHEMA
from wardflow.sources import sinks as SK
from wardflow.sources.binding import admissions
from wardflow.streaming.scoring_stream import start_model_scoring

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    admissions(spark, SF).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def run(raw, tmp_path_factory):
    return J.training_job(raw, str(tmp_path_factory.mktemp("run")), "logistic_regression", stamp="x")


def test_a_row_alone_equals_the_row_in_the_table(spark, raw, run):
    model, meta = load_model(spark, run.model_path)
    prepared = load_preparation(spark, run.model_path)
    rows = raw.drop("readmission_30_day")
    odd = rows.where("age IS NULL OR length_of_stay IS NULL OR insurance_type IS NULL OR length_of_stay > 15").limit(2).union(rows.limit(2))
    score = lambda d: score_raw(model, prepared, meta["features"], d, history=False)
    whole = {(r.patient_id, r.age, r.length_of_stay): r for r in score(odd.union(rows)).collect()}
    for r in odd.collect():
        alone = score(spark.createDataFrame([r], rows.schema)).first()
        assert alone == whole[(alone.patient_id, alone.age, alone.length_of_stay)]


def test_statistics_come_from_the_rows_it_was_fitted_on(spark, raw):
    rows = [(i, float(40 + i), "1" * 3, float(i), None if i == 9 else "Private") for i in range(10)]
    train = spark.createDataFrame(rows, "admission_key long, age double, patient_id string, length_of_stay double, ward string")
    p = fit_preparation(train)
    got = p.clean(spark.createDataFrame([(1, None, "A", 500.0, None), (2, 70.0, "B", None, "it's")],
                                        "admission_key long, age double, patient_id string, length_of_stay double, ward string")).collect()
    assert (got[0].age, got[0].length_of_stay, got[0].ward, got[0].patient_id) == (44.5, pytest.approx(8.91), "Private", "A")
    assert (got[1].age, got[1].length_of_stay) == (70.0, 4.5)
    bare = p.clean(spark.createDataFrame([(5, "Q")], "admission_key long, patient_id string")).first()  # missing columns
    assert (bare.age, bare.ward) == (44.5, "Private")


def test_stream_equals_batch(spark, raw, run, tmp_path):
    rows = raw.drop("readmission_30_day")
    rows.write.parquet(str(tmp_path / "src"))
    q = start_model_scoring(spark, run.model_path, str(tmp_path / "src"), rows.schema, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination()
    model, meta = load_model(spark, run.model_path)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = score_raw(model, run.preparation, meta["features"], rows, history=False)
    assert {"risk_category", "clinical_recommendations"} <= set(streamed.columns)
    assert streamed.count() == rows.count() and streamed.exceptAll(batch).count() == 0


def test_scored_file_keeps_all_rows(spark, raw, run, tmp_path):
    SK.write_csv(raw.drop("readmission_30_day", "insurance_type"), str(tmp_path / "in"))
    out = batch_scoring_job(spark, run.model_path, str(tmp_path / "in"), str(tmp_path / "out"))
    assert out.count() == raw.count() and out.where("readmission_probability IS NULL").count() == 0


def test_result_document_and_report(spark, tmp_path):
    scored = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.4), (1, 0, 0.35), (1, 1, 0.8)], "y int, pred int, p double")
    importance = spark.createDataFrame([("b", 0.5, -0.5, "decreases risk"), ("a", 2.0, 2.0, "increases risk")],
                                       "feature string, importance double, coefficient double, direction string")
    doc = J.results_document(scored, importance, {"n_rows": 4, "n_features": 2}, "20200101_000000", "logistic_regression")
    doc.write.json(str(tmp_path / "doc"))
    r = json.loads(spark.read.text(str(tmp_path / "doc")).first().value)["results"]
    e = r["evaluation_results"]
    m = e["clinical_metrics"]
    assert (r["timestamp"], r["model_type"], r["training_results"]) == ("20200101_000000", "logistic_regression", {"n_rows": 4, "n_features": 2})
    assert (m["tn"], m["fp"], m["fn"], m["tp"], m["accuracy"], m["precision"], m["recall"], m["roc_auc"]) == (2, 0, 1, 1, 0.75, 1.0, 0.5, 0.75)
    assert math.isclose(m["brier_score"], (0.01 + 0.16 + 0.65**2 + 0.04) / 4)
    assert [x["feature"] for x in e["feature_importance"]] == ["a", "b"]
    assert [(b["bin"], b["n"]) for b in e["calibration_results"]["calibration_curve"]] == [(0, 1), (3, 2), (7, 1)]
    assert math.isclose(e["calibration_results"]["ece"], (0.1 + 2 * 0.125 + 0.2) / 4) and e["calibration_results"]["calibration_quality"] == "Fair"
    lines = [x.value for x in J.report_lines(spark.read.json(str(tmp_path / "doc"))).orderBy("line").collect()]
    for line in ("- **Dataset:** 4 patients processed", "- **Performance (ROC-AUC):** 0.750", "- **Accuracy:** 0.750", "- a: 2.0000 (increases risk)",
                 "- Catches 50.0% of actual readmissions"):
        assert line in lines


def test_report_is_written(spark, run):
    text = [r.value for r in spark.read.text(run.report_path).collect()]
    assert text[0].startswith("# Hospital") and any(line.startswith("- **Final Features:**") for line in text)
    assert run.results.first().results.model_type == "logistic_regression"
    assert run.test.where(F.col("p").isNull()).count() == 0
