"""Joint logistic fits over packed rows against Spark's learner."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from wardflow.ml import search as SE
from wardflow.ml import training as TR
from wardflow.ml.logistic import Fit, LogisticModel, fit_logistic, pack

FEATURES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    r = np.random.default_rng(1)
    a, b = r.normal(5000, 30, 3000), r.integers(0, 2, 3000).astype(float)
    y = (r.random(3000) < 1 / (1 + np.exp(-((a - 5000) / 30 + b - 1)))).astype(float)
    table = [(i, float(u), float(v), 1.0 - float(v), 7.0, float(w), float(z), i % 3) for i, (u, v, w, z) in enumerate(zip(a, b, r.normal(0, 1, 3000), y))]
    path = str(tmp_path_factory.mktemp("rows"))  # c repeats b, d is constant, e is noise
    spark.createDataFrame(table, "admission_key long, a double, b double, c double, d double, e double, label double, t int").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _spark(train, reg, net):
    scaled = TR.build_pipeline(FEATURES).getStages()[:-1]
    return Pipeline(stages=[*scaled, LogisticRegression(labelCol="label", maxIter=1000, tol=1e-10, standardization=False, regParam=reg, elasticNetParam=net)]).fit(train)


@pytest.mark.parametrize(("reg", "net"), [(0.01, 0.0), (0.02, 1.0), (0.02, 0.5)])
def test_every_fit_equals_its_own_spark_fit(rows, reg, net):
    models = fit_logistic(pack(rows, FEATURES, tag="t"), FEATURES, [Fit(frozenset({0, 1, 2} - {f}), reg, net) for f in (0, 1)])
    for f, m in enumerate(models):
        them = TR.score(_spark(rows.where(F.col("t") != f), reg, net), rows).select("admission_key", F.col("probability_1").alias("q"))
        both = TR.score(m, rows).join(them, "admission_key")
        assert both.select(F.max(F.abs(F.col("probability_1") - F.col("q")))).first()[0] < 1e-5
        assert m.coefficients[3] == 0


def test_one_class_has_no_weights(rows):
    m = fit_logistic(pack(rows.where("label = 0"), FEATURES), FEATURES, [Fit(frozenset([0]))])[0]
    assert TR.score(m, rows).agg(F.max("probability_1")).first()[0] == 0


def test_large_tables_take_it_and_get_the_same(spark, rows, monkeypatch, tmp_path):
    params = TR.lr_params(1.0, "l2", 2400)
    monkeypatch.setattr(SE, "LR_GRID", {"C": [1.0], "penalty": ["l1", "l2"]})
    small = {"m": TR.fit(rows, FEATURES).test_metrics.first(), "cv": SE.cross_validate(rows, FEATURES, k=2, **params).collect(),
             "curve": TR.learning_curve(rows, FEATURES, fractions=(0.5, 1.0)).collect(), "grid": SE.search_logistic(rows, FEATURES, 2, refit=False).folds.collect()}
    monkeypatch.setattr(TR, "SPARK_LOGISTIC_ROWS", 100)
    monkeypatch.setattr(SE, "SPARK_LOGISTIC_ROWS", 100)
    result = TR.fit(rows, FEATURES)
    assert isinstance(result.model, LogisticModel)
    assert result.test_metrics.first().roc_auc == pytest.approx(small["m"].roc_auc, abs=2e-3)
    assert TR.feature_importance(result, 1).first().feature == "a"
    key = lambda r: r[:-1]
    for was, now in ((small["cv"], SE.cross_validate(rows, FEATURES, k=2, **params).collect()),
                     (small["grid"], SE.search_logistic(rows, FEATURES, 2, refit=False).folds.collect())):
        assert {key(r): pytest.approx(r.score, abs=2e-3) for r in was} == {key(r): r.score for r in now}
    for was, now in zip(small["curve"], TR.learning_curve(rows, FEATURES, fractions=(0.5, 1.0)).collect(), strict=True):
        assert tuple(now) == pytest.approx(tuple(was), abs=5e-3)
    TR.save_model(result, str(tmp_path))
    again, _ = TR.load_model(spark, str(tmp_path))
    assert TR.score(again, rows).exceptAll(TR.score(result.model, rows)).count() == 0
