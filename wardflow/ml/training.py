"""Model workflow on pyspark.ml: exact stratified split and folds, the
scaled-classifier pipeline, fit/evaluate, importance, search, curves.

The data never leaves the executors: estimators are fitted by Spark jobs,
metrics are DataFrames; only fitted coefficients (one number per feature)
are read on the driver, to label them with feature names.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.ml.logistic import Fit, LogisticModel, fit_logistic, pack
from wardflow.ml.trees import PartitionedTrees, binned, fit_trees
from wardflow.operators import evaluation as EV
from wardflow.operators.selection import hash_parts
from wardflow.session import is_stored, materialize

MODEL_TYPES = ("logistic_regression", "decision_tree", "random_forest")
# Search grids (C of the penalised logistic loss, penalty;
# tree depth (None = unlimited), minimum leaf size, impurity).
LR_GRID = {"C": [0.01, 0.1, 1.0, 10.0, 100.0], "penalty": ["l1", "l2"]}
TREE_GRID = {"max_depth": [3, 5, 7, 10, None], "min_samples_leaf": [1, 2, 5, 10],
             "criterion": ["gini", "entropy"]}
SPARK_MAX_DEPTH = 30  # deepest tree Spark grows; stands in for "unlimited"
# Default depth of a forest's trees (parameter maxDepth; the original is unlimited,
# which costs minutes for 100 trees of depth 30 on a few thousand rows).
FOREST_MAX_DEPTH = 15
FOREST_TREES = 100
# Spark's learner holds all nodes on the driver, about one per three rows at full
# depth; trees over more rows are grown by :mod:`wardflow.ml.trees`.
SPARK_TREE_ROWS = 200_000
# Spark's logistic learner caches a scaled copy of the rows for every fit; fits on more
# rows share one stored copy (:mod:`wardflow.ml.logistic`).
SPARK_LOGISTIC_ROWS = 200_000


def stratified_split(df: DataFrame, label: str = "label", key: str = "admission_key",
                     test_fraction: float = 0.2, seed: int = 42, store: bool = False) -> tuple[DataFrame, DataFrame]:
    """M1: exact stratified split: the first round(f * n_class) rows of each
    class in the seeded hash order of the (unique) key form the test part; a
    threshold per class, no ranking. ``store=True`` writes the labelled rows once
    (checkpoint folder) for the several passes of a fit, unless ``df`` is stored
    already: its rows are then filtered by their hash as they are read."""
    r = hash_parts(df, label, key, seed, lambda n: [math.floor(n * test_fraction + 0.5)], "_test")
    if store and not is_stored(df):
        r = materialize(r, "split")
    return r.where(F.col("_test") > 0).drop("_test"), r.where(F.col("_test") == 0).drop("_test")


def with_folds(df: DataFrame, k: int = 5, label: str = "label", key: str = "admission_key",
               seed: int = 42, fold_col: str = "fold", store: bool = False) -> DataFrame:
    """Stratified fold ids 0..k-1: k equal stretches of every class's hash
    order. ``store=True`` writes the folded rows once: a search filters them 2k
    times."""
    out = hash_parts(df, label, key, seed, lambda n: [math.floor(n * i / k + 0.5) for i in range(1, k)], fold_col)
    if store:
        out = materialize(out, "folds")
    return out


def classifier(model_type: str, **params):
    """M3-M6: the estimator for a model type name (unknown -> ValueError)."""
    if model_type == "logistic_regression":
        # tol 1e-4: the stopping tolerance of the original solver.
        return LogisticRegression(featuresCol="features", labelCol="label", maxIter=1000, tol=1e-4,
                                  standardization=False, **params)
    if model_type == "decision_tree":
        return DecisionTreeClassifier(featuresCol="features", labelCol="label", seed=42,
                                      maxDepth=params.pop("maxDepth", SPARK_MAX_DEPTH), **params)
    if model_type == "random_forest":
        return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=FOREST_TREES, seed=42,
                                      maxDepth=params.pop("maxDepth", FOREST_MAX_DEPTH), **params)
    raise ValueError(f"Unknown model type: {model_type}")


def lr_params(C: float, penalty: str, n_train: int) -> dict:
    """sklearn-style C / penalty -> Spark regParam / elasticNetParam on the
    mean loss: regParam = 1 / (C * n)."""
    return {"regParam": 1.0 / (C * n_train), "elasticNetParam": 1.0 if penalty == "l1" else 0.0}


def build_pipeline(features: list[str], model_type: str = "logistic_regression", scale: bool = True,
                   **params) -> Pipeline:
    """M2 + M3-M5: assemble -> (standardise) -> classifier. Spark scales by
    the sample standard deviation (the original used the population one)."""
    stages = [VectorAssembler(inputCols=features, outputCol="raw_features", handleInvalid="keep")]
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    else:
        stages[0].setOutputCol("features")
    stages.append(classifier(model_type, **params))
    return Pipeline(stages=stages)


def fit_model(df: DataFrame, features: list[str], model_type: str = "logistic_regression", scale: bool = True, **params) -> PipelineModel | PartitionedTrees | LogisticModel:
    """The fitted pipeline; trees over more than :data:`SPARK_TREE_ROWS` rows are
    grown in partitions (scaling does not change where a tree cuts), a scaled logistic
    regression over more than :data:`SPARK_LOGISTIC_ROWS` takes passes over stored rows."""
    if model_type == "logistic_regression" and scale and set(params) <= {"regParam", "elasticNetParam"} and df.count() > SPARK_LOGISTIC_ROWS:
        return fit_logistic(pack(df, features), features, [Fit(frozenset([0]), **params)])[0]
    if model_type in ("decision_tree", "random_forest") and df.count() > SPARK_TREE_ROWS:
        forest = model_type == "random_forest"
        return fit_trees(*binned(df, features), features, params.get("maxDepth", FOREST_MAX_DEPTH if forest else SPARK_MAX_DEPTH), params.get("minInstancesPerNode", 1),
                         params.get("impurity", "gini"), FOREST_TREES if forest else 1)
    return build_pipeline(features, model_type, scale, **params).fit(df)


def score(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """M8 + M9: class and probability of the positive class; a threshold
    other than 0.5 re-derives the class from the probability."""
    out = model.transform(df)
    if not isinstance(model, (PartitionedTrees, LogisticModel)):
        out = out.withColumn("probability_1", vector_to_array("probability")[1])
    pred = (F.col("probability_1") >= threshold).cast("int") if threshold != 0.5 else F.col("prediction").cast("int")
    return out.withColumn("predicted", pred).drop("raw_features", "features", "rawPrediction", "probability")


@dataclass
class FitResult:
    model: PipelineModel
    model_type: str
    features: list[str]
    train_metrics: DataFrame
    test_metrics: DataFrame
    training_seconds: float
    history: dict = field(default_factory=dict)
    train: DataFrame | None = None
    test: DataFrame | None = None


def fit(df: DataFrame, features: list[str], model_type: str = "logistic_regression",
        test_fraction: float = 0.2, seed: int = 42, C: float = 1.0, penalty: str = "l2",
        **params) -> FitResult:
    """M7: split, scale, train, score both parts, metric rows, timing."""
    train, test = stratified_split(df, "label", "admission_key", test_fraction, seed, store=True)
    if model_type == "logistic_regression" and "regParam" not in params:
        params.update(lr_params(C, penalty, train.count()))
    t0 = time.time()
    model = fit_model(train, features, model_type, **params)
    took = time.time() - t0

    def metrics(part: DataFrame, name: str) -> DataFrame:
        s = score(model, part).select(F.col("label").cast("int").alias("y"), F.col("predicted").alias("pred"),
                                      F.col("probability_1").alias("p"))
        return EV.clinical_metrics(s, model=name)

    return FitResult(model, model_type, list(features), metrics(train, f"{model_type}:train"),
                     metrics(test, f"{model_type}:test"), took,
                     {"n_features": len(features), "training_seconds": took, "params": dict(params)},
                     train, test)


def feature_importance(result: FitResult, top_n: int | None = 10) -> DataFrame:
    """M10 + M11: |coefficient| (with sign and direction) or impurity
    importance per feature, most important first."""
    spark = result.train_metrics.sparkSession
    clf = result.model.stages[-1]
    if hasattr(clf, "coefficients"):
        values = [float(v) for v in clf.coefficients.toArray()]
    else:
        values = [float(v) for v in clf.featureImportances.toArray()]
    rows = [(f, abs(v), v) for f, v in zip(result.features, values)]
    df = spark.createDataFrame(rows, "feature string, importance double, coefficient double")
    df = df.withColumn("direction", F.when(F.col("coefficient") > 0, "increases risk")
                       .when(F.col("coefficient") < 0, "decreases risk").otherwise("no effect"))
    df = df.orderBy(F.col("importance").desc(), "feature")
    return df.limit(top_n) if top_n else df


def tree_shape(result: FitResult) -> dict:
    """Depth and leaf count of a fitted tree (binary tree: leaves = (nodes + 1) / 2)."""
    tree = result.model.stages[-1]
    return {"depth": tree.depth, "leaves": (tree.numNodes + 1) // 2, "nodes": tree.numNodes}


def auc_evaluator() -> BinaryClassificationEvaluator:
    """Exact area under ROC (numBins=0: no down-sampling of thresholds)."""
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC", numBins=0)


# Qualitative columns of the model comparison table.
MODEL_NOTES = {
    "logistic_regression": ("Logistic Regression", "High", "Fast", "High"),
    "decision_tree": ("Decision Tree", "Very High", "Fast", "Very High"),
}


def learning_curve(df: DataFrame, features: list[str], model_type: str = "logistic_regression",
                   fractions=(0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0), seed: int = 42) -> DataFrame:
    """Fit on nested prefixes (by the seeded hash rank) of the training
    part; AUC on that prefix and on the test part."""
    from wardflow.session import materialize
    train, test = stratified_split(df, seed=seed, store=True)
    ranked = materialize(hash_parts(train, "label", "admission_key", seed + 1, lambda n: [math.ceil(n * f) for f in sorted(fractions)]), "curve")
    spark = df.sparkSession
    ev = auc_evaluator()
    rows = []
    if model_type == "logistic_regression" and ranked.count() > SPARK_LOGISTIC_ROWS:
        # Every part is a tag; all fractions are fitted in the same passes.
        fits = [Fit(frozenset(range(i + 1)), C=1.0) for i in range(len(fractions))]
        for i, (f, m) in enumerate(zip(sorted(fractions), fit_logistic(pack(ranked, features, tag="_part"), features, fits))):
            part = ranked.where(F.col("_part") <= i)
            rows.append((float(f), *(float(ev.evaluate(m.transform(d).select("label", "rawPrediction"))) for d in (part, test))))
        return spark.createDataFrame(rows, "fraction double, train_auc double, test_auc double")
    for i, f in enumerate(sorted(fractions)):
        part = ranked.where(F.col("_part") <= i).drop("_part")
        params = lr_params(1.0, "l2", max(part.count(), 1)) if model_type == "logistic_regression" else {}
        m = build_pipeline(features, model_type, **params).fit(part)
        rows.append((float(f), float(ev.evaluate(m.transform(part))), float(ev.evaluate(m.transform(test)))))
    return spark.createDataFrame(rows, "fraction double, train_auc double, test_auc double")


def save_model(result: FitResult, path: str) -> None:
    """The fitted pipeline plus a metadata record (type, features, history)."""
    partitioned = isinstance(result.model, PartitionedTrees)
    if partitioned:
        result.model.save(f"{path}/trees")
    elif isinstance(result.model, LogisticModel):
        result.model.save(f"{path}/logistic")
    else:
        result.model.write().overwrite().save(f"{path}/pipeline")
    spark = result.train_metrics.sparkSession
    meta = spark.createDataFrame([(result.model_type, result.features, result.training_seconds,
                                   str(result.history), partitioned, isinstance(result.model, LogisticModel))],
                                 "model_type string, features array<string>, training_seconds double, history string, partitioned boolean, coefficients boolean")
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def load_model(spark, path: str) -> tuple[PipelineModel, dict]:
    """The pipeline (or partitioned trees) and its metadata (model type, feature names)."""
    meta = spark.read.json(f"{path}/metadata").first()
    partitioned = "partitioned" in meta.asDict() and meta["partitioned"]
    if partitioned:
        model = PartitionedTrees.load(spark, f"{path}/trees")
    elif "coefficients" in meta.asDict() and meta["coefficients"]:
        model = LogisticModel.load(spark, f"{path}/logistic")
    else:
        model = PipelineModel.load(f"{path}/pipeline")
    return model, {"model_type": meta["model_type"], "features": list(meta["features"])}
