"""Cleaning whose statistics are learned once, on the training rows, and saved.

Clip bounds, medians and modes become literals of a ``SQLTransformer``, so the
preparation is a ``PipelineModel`` like the classifier: it is written beside it,
holds no state, and gives a row the same values alone, in a batch or in a stream.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators import cleaning as CL
from wardflow.operators.features import FeatureOptions, engineer_all_features
from wardflow.session import materialize

TARGET = "readmission_30_day"
CLIP = (0.01, 0.99)


def standardise(raw: DataFrame, options: CL.CleaningOptions = CL.CleaningOptions()) -> DataFrame:
    """The steps without statistics: text, categories, dates."""
    return reduce(lambda d, step: step[1](d, options) if getattr(options, step[0]) else d, CL.PROJECTIONS, raw)


def _number(v: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if v is None else f"CAST('{v!r}' AS DOUBLE)"  # repr is exact


def _text(v: str | None) -> str:
    return "'" + (v if v is not None else "Unknown").replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass
class Preparation:
    """``model``: the saved statistics as one SQL stage; ``inputs``: DDL of the
    raw columns it was fitted on (a missing one counts as all null)."""

    model: PipelineModel
    inputs: str

    def clean(self, raw: DataFrame) -> DataFrame:
        """Standardised, clipped and filled rows; stateless."""
        fields = T._parse_datatype_string(self.inputs).fields
        absent = {f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in raw.columns}
        typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in fields if f.name in raw.columns and raw.schema[f.name].dataType != f.dataType}
        return self.model.transform(standardise(raw.withColumns(absent | typed) if absent or typed else raw))

    def features(self, raw: DataFrame, history: bool = True) -> DataFrame:
        """Cleaned rows with all features. ``history=True`` looks up a patient's
        previous admission among the rows given; without it (single rows,
        streams) the previous admission is unknown, unless the rows carry
        ``days_since_last_admission`` themselves. The look-up reads the cleaned
        rows several times, so they are stored for it."""
        rows = self.clean(raw)
        return engineer_all_features(materialize(rows, "cleaned") if history else rows, FeatureOptions(history=history))[0]

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/preparation")
        SparkSession.active().createDataFrame([(self.inputs,)], "inputs string").coalesce(1).write.mode("overwrite").json(f"{path}/preparation-inputs")


def load_preparation(spark: SparkSession, path: str) -> Preparation:
    return Preparation(PipelineModel.load(f"{path}/preparation"), spark.read.json(f"{path}/preparation-inputs").first().inputs)


def fit_preparation(raw: DataFrame, exact: bool = True) -> Preparation:
    """C7, C11-C15 as a fitted stage: clip bounds of the stay columns, then a fill
    for every column that has a rule (whether or not it has gaps in the training
    rows), by the statistics of the clipped training rows. Identifiers, the
    target and code lists are never filled."""
    keep = [c for c in raw.columns if c != TARGET]
    inputs = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw.select(*keep).schema if f.name != "admission_key")
    d = materialize(standardise(raw.select(*keep)), "standardised")
    fields = [f for f in d.schema.fields if not f.name.endswith(("_id", "_key"))]
    rules = {f.name: CL.imputation_rule(f.name, f.dataType) for f in fields}
    clipped = [c for c in CL.outlier_columns(d) if c in rules]
    bounds = CL.quantile_stats(d, {f"{c}:{i}": (c, q) for c in clipped for i, q in enumerate(CLIP)}, exact) if clipped else {}
    value = {f.name: f"`{f.name}`" for f in fields}
    for c in clipped:
        lo, hi = (_number(bounds[f"{c}:{i}"]) for i in (0, 1))
        value[c] = f"CASE WHEN `{c}` IS NOT NULL THEN least(greatest(CAST(`{c}` AS DOUBLE), {lo}), {hi}) END"
    bounded = d.select(*[F.expr(v).alias(c) for c, v in value.items()])
    medians = [c for c, r in rules.items() if r == "median"]
    med = CL.quantile_stats(bounded, {c: (c, 0.5) for c in medians}, exact) if medians else {}
    for f in fields:
        c, rule = f.name, rules[f.name]
        if rule == "median":
            value[c] = f"coalesce(CAST({value[c]} AS DOUBLE), {_number(med[c])})"
        elif rule == "zero":
            value[c] = f"coalesce({value[c]}, CAST(0 AS {f.dataType.simpleString()}))"
        elif rule == "mode":
            top = CL.mode_value(bounded, c)
            value[c] = f"coalesce({value[c]}, {_text(bounded.sparkSession.range(1).select(top).first()[0])})"
    new = {c: v for c, v in value.items() if v != f"`{c}`"}
    statement = "SELECT * FROM __THIS__"
    if new:
        statement = f"SELECT * EXCEPT ({', '.join(f'`{c}`' for c in new)}), {', '.join(f'{v} AS `{c}`' for c, v in new.items())} FROM __THIS__"
    return Preparation(PipelineModel(stages=[SQLTransformer(statement=statement)]), inputs)
