"""Queries: sources / sinks round trips (S), model workflow (M), streaming
scoring (R). Model outputs depend on solver internals, so most of these
have no SQL twin (rows-only check); the file and stream round trips do."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.ml import search as SE
from wardflow.ml import training as TR
from wardflow.ml.scoring import score_batch
from wardflow.operators import evaluation as EV
from wardflow.operators.features import select_final_features
from wardflow.plans.catalog import register
from wardflow.plans.q_cleaning import RAW_SPEC
from wardflow.plans.q_features import engineered
from wardflow.plans.catalog import out_sql
from wardflow.plans.sql import with_ctes
from wardflow.session import ensure_checkpoint_dir, materialize
from wardflow.sources import readers as RD
from wardflow.sources import sinks as SK
from wardflow.sources.binding import admissions

RAW_SCHEMA = T.StructType([
    T.StructField("admission_key", T.LongType()), T.StructField("patient_id", T.StringType()),
    T.StructField("age", T.DoubleType()), T.StructField("gender", T.StringType()),
    T.StructField("admission_date", T.StringType()), T.StructField("length_of_stay", T.DoubleType()),
    T.StructField("emergency_admission", T.IntegerType()), T.StructField("diagnosis_codes", T.StringType()),
    T.StructField("previous_admissions", T.IntegerType()), T.StructField("insurance_type", T.StringType()),
    T.StructField("readmission_30_day", T.IntegerType())])


def scratch(spark, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/wardflow-{label}-{uuid.uuid4().hex}"


def matrix(spark, sf):
    """Model table: key, numeric features, label (stored once)."""
    df, feats = select_final_features(engineered(spark, sf))
    return materialize(df, "matrix"), feats


# ------------------------------------------------------------ sources
_CSV_SPEC = " | ".join(f"{c}=nullif({c}, ''):s" if k == "s" else f"{c}:{k}"
                      for c, k in (x.split(":") for x in RAW_SPEC.split()))


@register("s01_csv_round_trip", with_ctes(out_sql(_CSV_SPEC, "raw"), "raw"))
def s01_csv_round_trip(spark, sf):
    """Raw rows -> CSV sink -> CSV source (encoding detected, explicit schema).
    As with the original reader, an empty text field reads back as missing."""
    path = scratch(spark, "csv")
    SK.write_csv(admissions(spark, sf), path)
    return RD.load_raw_data(spark, path, "csv", schema=RAW_SCHEMA)


@register("s02_csv_inferred_schema", with_ctes(out_sql(_CSV_SPEC, "raw"), "raw"))
def s02_csv_inferred_schema(spark, sf):
    """Raw rows -> CSV -> CSV source with inferred column types."""
    path = scratch(spark, "csv-infer")
    SK.write_csv(admissions(spark, sf), path)
    return RD.load_raw_data(spark, path, "csv", infer=True)


@register("s03_json_round_trip", with_ctes(out_sql(RAW_SPEC, "raw"), "raw"))
def s03_json_round_trip(spark, sf):
    """Raw rows -> JSON lines sink -> JSON source."""
    path = scratch(spark, "json")
    admissions(spark, sf).write.mode("overwrite").json(path)
    return RD.load_raw_data(spark, path, "json", schema=RAW_SCHEMA, multi_line=False)


@register("s03_json_arrays", with_ctes(out_sql(RAW_SPEC, "raw"), "raw"))
def s03_json_arrays(spark, sf):
    """Raw rows -> files that each hold an array of records -> JSON source."""
    path = scratch(spark, "json-arrays")
    SK.write_json_arrays(admissions(spark, sf), path, "admission_key")
    return RD.load_raw_data(spark, path, "json", schema=RAW_SCHEMA)


@register("s05_required_columns", with_ctes("""
SELECT CAST(readmission_30_day AS INTEGER) AS readmission_30_day, count(*) AS "count" FROM raw GROUP BY 1""", "raw"))
def s05_required_columns(spark, sf):
    """Required-column check passes on the derived table (raises otherwise)."""
    df = admissions(spark, sf)
    return RD.check_required_columns(df).groupBy("readmission_30_day").count()


@register("s07_metrics_as_json")
def s07_metrics_as_json(spark, sf):
    """Metric row serialised as one JSON document."""
    from wardflow.plans.q_evaluation import scored
    return SK.metrics_as_json_text(EV.clinical_metrics(scored(spark, sf), model="Demo score"))


@register("s08_text_report")
def s08_text_report(spark, sf):
    """Text report lines rendered from the metric row."""
    from wardflow.plans.q_evaluation import scored
    m = EV.clinical_metrics(scored(spark, sf), model="Demo score")
    return SK.render_report(m, "Model %s: AUC %.3f, accuracy %.3f, precision %.3f, recall %.3f",
                            ["model", "roc_auc", "accuracy", "precision", "recall"])


# ---------------------------------------------------------------- ML
@register("m01_stratified_split", with_ctes("""
SELECT p.part, CAST(c.label AS DOUBLE) AS label, CAST(CASE p.part WHEN 'test' THEN c.test ELSE c.n - c.test END AS BIGINT) AS "count"
FROM (SELECT readmission_30_day AS label, count(*) AS n, round(count(*) * 0.2) AS test FROM raw GROUP BY 1) c
CROSS JOIN (VALUES ('train'), ('test')) p(part)""", "raw"))
def m01_stratified_split(spark, sf):
    """Exact stratified 80/20 split: rows per (part, class)."""
    df, _ = matrix(spark, sf)
    train, test = TR.stratified_split(df)
    return (train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
            .groupBy("part", "label").count())


@register("m02_scaling_check")
def m02_scaling_check(spark, sf):
    """Standardised inputs: largest |mean| and largest std over columns."""
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    df, feats = matrix(spark, sf)
    v = VectorAssembler(inputCols=feats, outputCol="v").transform(df)
    s = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(v).transform(v)
    arr = s.select(vector_to_array("s").alias("a"))
    stats = arr.agg(*[F.avg(F.col("a")[i]).alias(f"m{i}") for i in range(len(feats))],
                    *[F.stddev_samp(F.col("a")[i]).alias(f"s{i}") for i in range(len(feats))])
    return stats.select(F.greatest(*[F.abs(F.col(f"m{i}")) for i in range(len(feats))]).alias("max_abs_mean"),
                        F.greatest(*[F.col(f"s{i}") for i in range(len(feats))]).alias("max_std"))


def _fit(spark, sf, model_type):
    df, feats = matrix(spark, sf)
    return TR.fit(df, feats, model_type), df


@register("m03_logistic_regression")
def m03_logistic_regression(spark, sf):
    """L2 logistic regression (C = 1): held-out probabilities."""
    res, _ = _fit(spark, sf, "logistic_regression")
    return TR.score(res.model, res.test).select("admission_key", "probability_1", "predicted")


@register("m04_decision_tree")
def m04_decision_tree(spark, sf):
    """Decision tree (gini, deepest allowed): held-out predictions + shape."""
    res, _ = _fit(spark, sf, "decision_tree")
    shape = TR.tree_shape(res)
    return (TR.score(res.model, res.test).select("admission_key", "probability_1", "predicted")
            .withColumn("tree_depth", F.lit(shape["depth"])).withColumn("tree_leaves", F.lit(shape["leaves"])))


@register("m05_random_forest")
def m05_random_forest(spark, sf):
    """Random forest (100 trees): held-out probabilities."""
    res, _ = _fit(spark, sf, "random_forest")
    return TR.score(res.model, res.test).select("admission_key", "probability_1", "predicted")


@register("m09_custom_threshold")
def m09_custom_threshold(spark, sf):
    """Class from probability >= 0.3 instead of the model's 0.5 cut."""
    res, _ = _fit(spark, sf, "logistic_regression")
    return TR.score(res.model, res.test, threshold=0.3).groupBy("predicted").count()


@register("m07_fit_metrics")
def m07_fit_metrics(spark, sf):
    """Clinical metric rows on the training and the held-out part."""
    res, _ = _fit(spark, sf, "logistic_regression")
    return res.train_metrics.unionByName(res.test_metrics)


@register("m10_feature_importance")
def m10_feature_importance(spark, sf):
    """Top-10 |coefficient| with sign and direction text."""
    res, _ = _fit(spark, sf, "logistic_regression")
    return TR.feature_importance(res, 10)


@register("m12_cross_validation")
def m12_cross_validation(spark, sf):
    """5-fold stratified CV AUC (scaler fitted inside each fold): a row per
    fold, with the mean and the population deviation of all."""
    df, feats = matrix(spark, sf)
    n = df.count() * 4 // 5
    folds = SE.cross_validate(df, feats, "logistic_regression", 5, **TR.lr_params(1.0, "l2", n))
    return folds.join(SE.summarise(folds).drop("folds"), ["model", "params"])


@register("m13_lr_grid_search")
def m13_lr_grid_search(spark, sf):
    """Logistic regression grid: C x penalty, 5-fold AUC, best first."""
    df, feats = matrix(spark, sf)
    return SE.search_logistic(df, feats, 5, parallelism=8, refit=False).summary


@register("m14_tree_grid_search")
def m14_tree_grid_search(spark, sf):
    """Decision tree grid: depth x min leaf x impurity, 5-fold AUC; every depth
    is scored from one deep tree."""
    df, feats = matrix(spark, sf)
    return SE.search_tree(df, feats, 5, parallelism=8, refit=False).summary


@register("m15_compare_models")
def m15_compare_models(spark, sf):
    """Best CV score and parameters per model type, best first."""
    df, feats = matrix(spark, sf)
    return SE.compare_models(df, feats, 5, parallelism=8).table


@register("m16_best_model")
def m16_best_model(spark, sf):
    """The winner of the model search, chosen and fitted on the training part:
    held-out probabilities."""
    df, feats = matrix(spark, sf)
    train, test = TR.stratified_split(df, store=True)
    best = SE.compare_models(train, feats, 5, parallelism=8)
    return (TR.score(best.best_model, test).select("admission_key", "probability_1", "predicted")
            .withColumn("model", F.lit(best.best_type)))


@register("m17_learning_curve")
def m17_learning_curve(spark, sf):
    """AUC on nested training fractions and on the held-out part."""
    df, feats = matrix(spark, sf)
    return TR.learning_curve(df, feats)


@register("m19_model_comparison")
def m19_model_comparison(spark, sf):
    """Held-out clinical metric rows of the plain and the tuned logistic
    regression and decision tree."""
    df, feats = matrix(spark, sf)
    return SE.plain_and_tuned(df, feats, 5, parallelism=8)


def _raw(spark, sf):
    """Raw rows, stored once for the passes that split, train on and score them."""
    return materialize(admissions(spark, sf), "raw")


def _trained(spark, raw, model_type="logistic_regression"):
    from wardflow.ml.jobs import training_job
    return training_job(raw, scratch(spark, "run"), model_type, stamp="run")


def _scored_file(spark, sf):
    from wardflow.ml.scoring import batch_scoring_job
    raw = _raw(spark, sf)
    run = _trained(spark, raw)
    in_path, out_path = scratch(spark, "in"), scratch(spark, "out")
    SK.write_csv(raw.drop("readmission_30_day"), in_path)
    return batch_scoring_job(spark, run.model_path, in_path, out_path)


@register("m20_batch_scoring_job")
def m20_batch_scoring_job(spark, sf):
    """Train and save (model, preparation, results), then score a CSV of raw rows
    with what was saved: clean, featurise, align, score, tier, advise, write."""
    return _scored_file(spark, sf)


@register("m20_patient_columns", with_ctes("""
SELECT patient_id, round(age, 6) AS age, nullif(gender, '') AS gender, round(length_of_stay, 6) AS length_of_stay,
       CAST(emergency_admission AS INTEGER) AS emergency_admission FROM raw""", "raw"))
def m20_patient_columns(spark, sf):
    """The patient columns of the scored file, which are those of the rows as read."""
    d = _scored_file(spark, sf)
    return d.select("patient_id", F.round(F.col("age").cast("double"), 6).alias("age"), "gender",
                    F.round(F.col("length_of_stay").cast("double"), 6).alias("length_of_stay"), F.col("emergency_admission").cast("int").alias("emergency_admission"))


@register("m20_training_results")
def m20_training_results(spark, sf):
    """Nested result document of a training run: metrics, calibration, importance."""
    return _trained(spark, _raw(spark, sf)).results


@register("m20_training_report")
def m20_training_report(spark, sf):
    """Lines of the report that the training run wrote."""
    return spark.read.text(_trained(spark, _raw(spark, sf), "decision_tree").report_path)


@register("s09_model_save_load")
def s09_model_save_load(spark, sf):
    """Saved and reloaded pipeline gives the same probabilities."""
    res, df = _fit(spark, sf, "logistic_regression")
    path = scratch(spark, "model")
    TR.save_model(res, path)
    model, meta = TR.load_model(spark, path)
    a = TR.score(res.model, df).select("admission_key", F.col("probability_1").alias("a"))
    b = TR.score(model, df).select("admission_key", F.col("probability_1").alias("b"))
    # Not to be broadcast, however small the files of the narrow columns look.
    return a.join(b.hint("merge"), "admission_key").agg(F.count(F.lit(1)).alias("rows"),
                                          F.max(F.abs(F.col("a") - F.col("b"))).alias("max_abs_diff"),
                                          F.lit(len(meta["features"])).alias("features"))


# ---------------------------------------------------------- streaming
def _stream_fills_sql() -> str:
    return "(SELECT median(age) AS fa, median(length_of_stay) AS fl, median(CAST(emergency_admission AS DOUBLE)) AS fe FROM raw)"


def _r01_sql() -> str:
    from wardflow.plans.sql import gender_sql, title_sql
    from wardflow.plans.q_features import demo_score_sql, tier_sql, advice_sql
    from wardflow.functions.clinical import APP_ADVICE
    from wardflow.operators.codes import CONDITIONS
    flags = ", ".join(f"coalesce(f.has_{c}, 0) AS has_{c}" for c in CONDITIONS)
    base = f"""
SELECT r.admission_key, r.patient_id, coalesce(r.age, s.fa) AS age, {gender_sql(title_sql('trim(r.gender)'))} AS gender,
       coalesce(r.length_of_stay, s.fl) AS length_of_stay,
       coalesce(CAST(r.emergency_admission AS DOUBLE), s.fe) AS emergency_admission,
       coalesce(r.previous_admissions, 0) AS previous_admissions, {flags}
FROM raw r CROSS JOIN {_stream_fills_sql()} s LEFT JOIN rflags f ON r.admission_key = f.admission_key"""
    return f"""SELECT CAST(admission_key AS BIGINT) AS admission_key, patient_id, round(age, 6) AS age, gender,
       round(length_of_stay, 6) AS length_of_stay, round(emergency_admission, 6) AS emergency_admission,
       round({demo_score_sql()}, 6) AS risk_probability, {tier_sql(demo_score_sql())} AS risk_category,
       {advice_sql(tier_sql(demo_score_sql()), APP_ADVICE)} AS recommendations FROM ({base})"""


def _rflags_cte():
    from wardflow.plans.sql import cte
    from wardflow.operators.codes import CONDITIONS
    cte("rtokens", ("raw",), """
  SELECT admission_key, token FROM (
    SELECT admission_key, upper(trim(unnest(string_split_regex(diagnosis_codes, '[;,|]')))) AS token FROM raw
  ) WHERE token <> ''""")
    cte("rtok_map", ("rtokens", "code_dim"), """
  SELECT t.token, coalesce(min_by(CASE WHEN t.token = d.code THEN d.condition END, CASE WHEN t.token = d.code THEN d.ord END),
                           arg_min(d.condition, d.ord)) AS condition
  FROM (SELECT DISTINCT token FROM rtokens) t
  JOIN code_dim d ON t.token = d.code OR starts_with(t.token, split_part(d.code, '.', 1))
                     OR starts_with(d.code, split_part(t.token, '.', 1))
  GROUP BY t.token""")
    cte("rflags", ("rtokens", "rtok_map"), "  SELECT admission_key, " + ", ".join(
        f"max(CASE WHEN m.condition = '{c}' THEN 1 ELSE 0 END) AS has_{c}" for c in CONDITIONS)
        + " FROM rtokens k JOIN rtok_map m ON k.token = m.token GROUP BY admission_key")


_rflags_cte()


@register("r01_stream_demo_scoring", with_ctes(_r01_sql(), "raw", "rflags"))
def r01_stream_demo_scoring(spark, sf):
    """Raw rows as a file stream -> stateless cleaning, row-wise condition
    flags, additive score, tier, advice -> Parquet sink (availableNow)."""
    from wardflow.operators.quantiles import quantile_columns
    from wardflow.streaming.scoring_stream import start_demo_scoring
    raw = admissions(spark, sf)
    src, sink, ckpt = scratch(spark, "stream-src"), scratch(spark, "stream-out"), scratch(spark, "stream-ckpt")
    raw.write.parquet(src)
    stats = quantile_columns(raw, {c: (c, 0.5) for c in ("age", "length_of_stay", "emergency_admission")}).first()
    q = start_demo_scoring(spark, src, RAW_SCHEMA, sink, ckpt, fills=stats.asDict())
    q.awaitTermination()
    return spark.read.parquet(sink)


@register("r02_stream_model_scoring")
def r02_stream_model_scoring(spark, sf):
    """Raw rows as a file stream, cleaned by the saved statistics and scored by
    the saved model, with tier and advice."""
    from wardflow.streaming.scoring_stream import start_model_scoring
    raw = _raw(spark, sf)
    run = _trained(spark, raw)
    src, sink, ckpt = scratch(spark, "mstream-src"), scratch(spark, "mstream-out"), scratch(spark, "mstream-ckpt")
    raw.drop("readmission_30_day").write.parquet(src)
    schema = T.StructType([f for f in RAW_SCHEMA if f.name != "readmission_30_day"])
    q = start_model_scoring(spark, run.model_path, src, schema, sink, ckpt)
    q.awaitTermination()
    return spark.read.parquet(sink)
