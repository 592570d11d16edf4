"""Model workflow and streaming on small inputs."""

import random

import pytest
from pyspark.sql import functions as F

from wardflow.ml import training as TR


@pytest.fixture(scope="module")
def separable(spark):
    rnd = random.Random(11)
    rows = []
    for k in range(1200):
        y = 1 if rnd.random() < 0.3 else 0
        rows.append((k, float(y) * 2.0 + rnd.gauss(0, 0.7), rnd.gauss(0, 1), float(y)))
    return spark.createDataFrame(rows, "admission_key long, a double, b double, label double")


def test_split_exact_and_disjoint(separable):
    train, test = TR.stratified_split(separable)
    n = {r.label: r["count"] for r in separable.groupBy("label").count().collect()}
    t = {r.label: r["count"] for r in test.groupBy("label").count().collect()}
    assert t == {k: round(v * 0.2) for k, v in n.items()}
    assert train.join(test, "admission_key").count() == 0
    assert train.count() + test.count() == separable.count()


def test_folds_are_stratified(separable):
    f = TR.with_folds(separable, 5)
    counts = f.groupBy("fold", "label").count().collect()
    assert {r.fold for r in counts} == set(range(5))


def test_logistic_regression_learns(separable):
    res = TR.fit(separable, ["a", "b"], "logistic_regression")
    assert res.test_metrics.first().roc_auc > 0.8
    imp = TR.feature_importance(res).collect()
    assert imp[0].feature == "a" and imp[0].direction == "increases risk"


def test_unknown_model_type():
    with pytest.raises(ValueError):
        TR.classifier("svm")


def test_stream_equals_batch(spark, tmp_path):
    from wardflow.plans.q_ml import RAW_SCHEMA
    from wardflow.sources.binding import admissions
    from wardflow.streaming.scoring_stream import score_admission_rows, start_demo_scoring
    raw = admissions(spark, "/root/testdata/sf0.001")
    src = str(tmp_path / "src")
    raw.write.parquet(src)
    fills = {"age": 50.0, "length_of_stay": 5.0, "emergency_admission": 0.0}
    q = start_demo_scoring(spark, src, RAW_SCHEMA, str(tmp_path / "out"), str(tmp_path / "ckpt"), fills)
    q.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = score_admission_rows(spark.read.parquet(src), fills)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_model_input_guards(spark):
    from wardflow.operators.features import check_model_inputs
    df = spark.createDataFrame([(1.0, "x", 1)], "a double, s string, readmission_30_day int")
    check_model_inputs(df, ["a"])
    for feats in ([], ["zz"], ["s"]):
        with pytest.raises(ValueError):
            check_model_inputs(df, feats)
    with pytest.raises(ValueError):
        check_model_inputs(df.limit(0), ["a"])


def test_scores_carry_the_patient_columns_as_read(separable):
    from wardflow.ml.scoring import AS_READ, score_batch
    res = TR.fit(separable, ["a", "b"], "logistic_regression")
    info = F.struct(F.lit("P1").alias("patient_id"), F.lit(None).cast("double").alias("age"), F.lit("m").alias("gender"))
    row = score_batch(res.model, ["a", "b"], separable.withColumn("age", F.lit(40.0)).withColumn(AS_READ, info)).first()
    assert (row.patient_id, row.age, row.gender) == ("P1", None, "m")
