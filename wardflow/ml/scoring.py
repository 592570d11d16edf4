"""Batch scoring: align features to a fitted model, score, tier, advise."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions import clinical as CL
from wardflow.ml.training import score

DEFAULT_AGE = 65.0
OUTPUT_INFO = ["patient_id", "age", "gender", "length_of_stay", "emergency_admission"]
AS_READ = "__as_read"  # struct of the OUTPUT_INFO columns before cleaning


def align_features(df: DataFrame, expected: list[str]) -> tuple[DataFrame, list[str]]:
    """The model's inputs in model order; a missing input is defaulted:
    dummies (``*_std_*``), ``has_*``, ``*_admission`` and ``*risk*`` -> 0,
    other ``*age*`` names -> the age column (65 without one), else 0.
    Returns the frame and the list of defaulted names."""
    present = set(df.columns)
    missing = [f for f in expected if f not in present]
    cols = {}
    for f in missing:
        if "_std_" in f or f.startswith("has_") or f.endswith("_admission") or "risk" in f:
            cols[f] = F.lit(0.0)
        elif "age" in f:
            cols[f] = F.col("age").cast("double") if "age" in present else F.lit(DEFAULT_AGE)
        else:
            cols[f] = F.lit(0.0)
    out = df.withColumns(cols) if cols else df
    return out.withColumns({f: F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) for f in expected}), missing


def score_batch(model: PipelineModel, features: list[str], featured: DataFrame, threshold: float = 0.5,
                include_probabilities: bool = True) -> DataFrame:
    """M20 core: align -> score -> tier -> advice, one lazy plan. The patient
    columns are those of the struct :data:`AS_READ`, else of the frame itself."""
    aligned, _ = align_features(featured, features)
    s = score(model, aligned, threshold)
    info = s.schema[AS_READ].dataType.names if AS_READ in s.columns else []
    cols = [F.col(f"{AS_READ}.{c}") for c in info] or [F.col(c) for c in OUTPUT_INFO if c in s.columns]
    out = s.select(*cols, F.col("predicted").alias("predicted_readmission"),
                   CL.probability_tier("probability_1").alias("risk_category"),
                   F.col("probability_1").alias("readmission_probability"))
    out = out.withColumn("clinical_recommendations", CL.recommendation("risk_category"))
    return out if include_probabilities else out.drop("readmission_probability")


def score_raw(model: PipelineModel, preparation, features: list[str], raw: DataFrame, threshold: float = 0.5,
              history: bool = True) -> DataFrame:
    """Raw admission rows -> scored rows, by the fills and bounds that were saved
    with the model (:mod:`wardflow.ml.preparation`). With ``history=False`` a
    row is scored without a look at any other, so it works on a stream."""
    if history and "admission_key" not in raw.columns:
        raw = raw.withColumn("admission_key", F.monotonically_increasing_id())
    info = [c for c in OUTPUT_INFO if c in raw.columns]
    raw = raw.withColumn(AS_READ, F.struct(*info)) if info else raw
    return score_batch(model, features, preparation.features(raw, history), threshold)


def batch_scoring_job(spark: SparkSession, model_path: str, input_path: str, output_path: str,
                      file_type: str = "csv", threshold: float = 0.5, history: bool = True) -> DataFrame:
    """Load model and preparation, read the input once, clean by the saved
    statistics, featurise, align, score, write the scored rows with the patient
    columns as read (CSV with header)."""
    from wardflow.ml.preparation import load_preparation
    from wardflow.ml.training import load_model
    from wardflow.sources.readers import load_raw_data, read_csv
    from wardflow.sources.sinks import write_csv

    model, meta = load_model(spark, model_path)
    # By header name: files to score lack the target, and may lack other columns.
    raw = read_csv(spark, input_path, allow_missing=True) if file_type == "csv" else load_raw_data(spark, input_path, file_type)
    out = score_raw(model, load_preparation(spark, model_path), meta["features"], raw, threshold, history)
    write_csv(out, output_path)
    return spark.read.option("header", True).csv(output_path)
