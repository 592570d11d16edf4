"""The training job: load, prepare, fit or choose, evaluate, save, report."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.ml import search as SE
from wardflow.ml import training as TR
from wardflow.ml.preparation import Preparation, fit_preparation
from wardflow.operators import evaluation as EV
from wardflow.operators.features import check_model_inputs, select_final_features
from wardflow.session import materialize
from wardflow.sources import sinks as SK

# Fixed text of the report.
REPORT = [
    "# Hospital Readmission Risk Model - Pipeline Execution Report", "",
    "**Run:** {stamp}", "", "## Pipeline Results",
    "- **Dataset:** {n_rows} patients processed", "- **Final Features:** {n_features}", "- **Model Type:** {model_type}",
    "- **Performance (ROC-AUC):** {roc_auc:.3f}", "- **Sensitivity:** {sensitivity:.3f}", "- **Specificity:** {specificity:.3f}", "",
    "## Model Performance", "- **Accuracy:** {accuracy:.3f}", "- **Precision:** {precision:.3f}", "- **Recall:** {recall:.3f}",
    "- **PPV:** {ppv:.3f}", "- **NPV:** {npv:.3f}", "", "## Calibration", "- **Brier score:** {brier_score:.3f}",
    "- **Expected calibration error:** {ece:.3f} ({calibration_quality})", "", "## Most important features", "{importance}", "",
    "## Clinical Interpretation", "- Model achieves {roc_auc:.1%} discrimination (AUC)",
    "- Catches {sensitivity:.1%} of actual readmissions", "- {ppv:.1%} of high-risk predictions are correct",
    "- Suitable for clinical decision support with human oversight",
]


def results_document(scored: DataFrame, importance: DataFrame, training: dict, stamp: str, model_type: str) -> DataFrame:
    """One row of one nested struct column ``results``: run stamp, model type,
    training record, and under ``evaluation_results`` the clinical metrics,
    calibration (curve, error, grade) and feature importance of the scored rows
    (``y``, ``pred``, ``p``). All parts are one-row or bounded aggregates."""
    metrics = EV.clinical_metrics(scored, model=model_type)
    curve = EV.calibration_curve(scored).agg(F.array_sort(F.collect_list(F.struct("bin", "mean_predicted", "fraction_positives", "n"))).alias("curve"))
    ranked = importance.agg(F.array_sort(F.collect_list(F.struct((-F.col("importance")).alias("o"), "feature", "importance", "coefficient", "direction"))).alias("i"))
    one = (metrics.select(F.struct(*[c for c in metrics.columns if c != "model"]).alias("m"))
           .crossJoin(F.broadcast(curve)).crossJoin(F.broadcast(EV.expected_calibration_error(scored)))
           .crossJoin(F.broadcast(ranked)))  # one row each
    calibration = F.struct(F.col("curve").alias("calibration_curve"), "ece", "calibration_quality")
    features = F.transform("i", lambda x: F.struct(x["feature"].alias("feature"), x["importance"].alias("importance"),
                                                  x["coefficient"].alias("coefficient"), x["direction"].alias("direction")))
    evaluation = F.struct(F.col("m").alias("clinical_metrics"), calibration.alias("calibration_results"), features.alias("feature_importance"))
    record = F.struct(*[F.lit(v).alias(k) for k, v in training.items()])
    return one.select(F.struct(F.lit(stamp).alias("timestamp"), F.lit(model_type).alias("model_type"), record.alias("training_results"),
                               evaluation.alias("evaluation_results")).alias("results"))


def report_lines(results: DataFrame, top: int = 5) -> DataFrame:
    """The report, a row (``line``, ``value``) per line, rendered from the
    one-row result document."""
    r = results.first().results.asDict(recursive=True)
    e = r["evaluation_results"]
    importance = "\n".join(f"- {x['feature']}: {x['importance']:.4f} ({x['direction']})" for x in e["feature_importance"][:top])
    known = {**e["clinical_metrics"], **e["calibration_results"], **r["training_results"], "stamp": r["timestamp"], "model_type": r["model_type"],
             "importance": importance}
    known = {k: float("nan") if v is None else v for k, v in known.items()}
    lines = "\n".join(x.format(**known) for x in REPORT).split("\n")
    return results.sparkSession.createDataFrame(list(enumerate(lines)), "line int, value string")


@dataclass
class TrainingRun:
    model_path: str
    results_path: str
    report_path: str
    model_type: str
    preparation: Preparation
    results: DataFrame      # the written document, read back
    test: DataFrame         # held-out rows with label and probability_1


def training_job(raw: DataFrame, output: str, model_type: str = "auto", k: int = 5, test_fraction: float = 0.2, seed: int = 42,
                 stamp: str | None = None, parallelism: int = 4) -> TrainingRun:
    """Train on raw rows and write ``<output>/run_ts=<stamp>/`` with the model, its
    preparation, ``results`` (JSON) and ``report`` (text).

    The raw rows are split first; fills and clip bounds are learned on the training
    part only. ``model_type="auto"`` searches both model types and keeps the
    fitted winner; else that type is fitted with its defaults."""
    spark = raw.sparkSession
    stamp = stamp or SK.run_stamp()
    base = f"{output.rstrip('/')}/run_ts={stamp}"
    began = time.time()
    train_raw, test_raw = TR.stratified_split(raw, "readmission_30_day", "admission_key", test_fraction, seed, store=True)
    preparation = fit_preparation(train_raw)
    # A patient's previous admission is looked up among all rows, whichever part they are in.
    part = train_raw.withColumn("__test", F.lit(False)).unionByName(test_raw.withColumn("__test", F.lit(True)))
    matrix, features = select_final_features(preparation.features(part.drop("__test")))
    check_model_inputs(matrix, features, "label")
    matrix = materialize(matrix.join(part.select("admission_key", "__test"), "admission_key"), "matrix")
    train, test = (matrix.where(F.col("__test") == x).drop("__test") for x in (False, True))
    n_rows = train.count()
    if model_type == "auto":
        found = SE.compare_models(train, features, k, parallelism)
        chosen, model, params = found.best_type, found.best_model, found.best_params
    else:
        params = TR.lr_params(1.0, "l2", n_rows) if model_type == "logistic_regression" else {}
        chosen, model = model_type, TR.fit_model(train, features, model_type, **params)
    training = {"model_type": chosen, "n_rows": n_rows + test.count(), "n_features": len(features), "cv_folds": k if model_type == "auto" else 0,
                "params": SE._text(params), "training_seconds": time.time() - began}
    scored = materialize(TR.score(model, test).select("admission_key", "label", F.col("label").cast("int").alias("y"), F.col("predicted").alias("pred"),
                                                      F.col("probability_1").alias("p")), "scored")
    result = TR.FitResult(model, chosen, features, scored, scored, training["training_seconds"], training)
    TR.save_model(result, f"{base}/model")
    preparation.save(f"{base}/model")
    results_document(scored, TR.feature_importance(result, None), training, stamp, chosen).write.mode("overwrite").json(f"{base}/results")
    results = spark.read.json(f"{base}/results")
    SK.write_text(report_lines(results).orderBy("line").select("value"), f"{base}/report")
    return TrainingRun(f"{base}/model", f"{base}/results", f"{base}/report", chosen, preparation, results, scored)
