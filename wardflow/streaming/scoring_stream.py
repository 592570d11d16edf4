"""Structured Streaming scoring: the batch column functions on a stream.

Every step here is stateless (row-wise), so the stream needs no watermark
and no state store: text standardisation, date parsing, per-row condition
flags (:func:`wardflow.operators.codes.condition_flags`: map probe plus the
ordered prefix rule against the fixed 96-code dictionary, no join), the additive score, tier
and advice. Fills use statistics fitted on a batch and passed in, so a
row's score does not depend on which micro-batch it arrives in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions import clinical as CL
from wardflow.functions.dates import parse_date
from wardflow.functions.text import standardize_gender, standardize_insurance, title_case
from wardflow.operators.codes import condition_flags


def score_admission_rows(df: DataFrame, fills: dict[str, float] | None = None) -> DataFrame:
    """Stateless per-row scoring of raw admission rows."""
    fills = fills or {}
    out = df.withColumns({
        "gender": standardize_gender(title_case(F.trim("gender"))),
        "insurance_type": standardize_insurance(title_case(F.trim("insurance_type"))),
        "admission_date": parse_date(F.trim("admission_date")),
        "age": F.coalesce(F.col("age"), F.lit(fills.get("age"))).cast("double"),
        "length_of_stay": F.coalesce(F.col("length_of_stay"), F.lit(fills.get("length_of_stay"))).cast("double"),
        "previous_admissions": F.coalesce(F.col("previous_admissions"), F.lit(0)),
        "emergency_admission": F.coalesce(F.col("emergency_admission").cast("double"),
                                          F.lit(fills.get("emergency_admission"))),
    })
    out = out.withColumns(condition_flags(F.col("diagnosis_codes")))
    p = CL.demo_risk_score()
    return out.select("admission_key", "patient_id", "age", "gender", "length_of_stay", "emergency_admission",
                      p.alias("risk_probability"), CL.probability_tier(p).alias("risk_category"),
                      CL.recommendation(CL.probability_tier(p), CL.APP_ADVICE).alias("recommendations"))


def start_demo_scoring(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str,
                       checkpoint_dir: str, fills: dict[str, float] | None = None, available_now: bool = True):
    """File stream of admission rows -> scores -> Parquet sink."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    q = (score_admission_rows(stream, fills).writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="10 seconds")
    return q.start()


def start_model_scoring(spark: SparkSession, model_path: str, source_dir: str, schema: T.StructType,
                        sink_dir: str, checkpoint_dir: str, threshold: float = 0.5, available_now: bool = True):
    """R2: a stream of raw rows cleaned by the saved statistics, scored by the
    saved model, with tier and advice; row by row, so the previous admission is
    unknown unless the rows carry ``days_since_last_admission``."""
    from wardflow.ml.preparation import load_preparation
    from wardflow.ml.scoring import score_raw
    from wardflow.ml.training import load_model
    model, meta = load_model(spark, model_path)
    stream = spark.readStream.schema(schema).parquet(source_dir)
    scored = score_raw(model, load_preparation(spark, model_path), meta["features"], stream, threshold, history=False)
    q = (scored.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="10 seconds")
    return q.start()
