"""Per-patient history features (days since last admission, patient totals).

All of them come from one :func:`entity_sequence` pass: rows are shuffled
once on (patient, day), so a patient with a huge history is spread over its
days instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions.dates import floor_days_between
from wardflow.operators.sequence import entity_sequence

FIRST_ADMISSION_DAYS = 999


def days_since_last_admission(df: DataFrame, patient_col: str = "patient_id",
                              date_col: str = "admission_date", key: str = "admission_key",
                              out_col: str = "days_since_last") -> DataFrame:
    """Whole days since the patient's previous admission, ordered by
    date (missing dates last) then key; first admission or a missing date
    -> 999."""
    seq = entity_sequence(df, entity=patient_col, ts=date_col, tie=key,
                          seq_col="_seq", prev_col="_prev", next_col=None)
    days = F.coalesce(floor_days_between(F.col(date_col), F.col("_prev")), F.lit(FIRST_ADMISSION_DAYS))
    return seq.withColumn(out_col, days.cast("long")).drop("_seq", "_prev")


def temporal_aggregates(df: DataFrame, patient_col: str = "patient_id",
                        date_col: str = "admission_date", key: str = "admission_key",
                        timeframe_days: int = 365, with_days_since: bool = False) -> DataFrame:
    """Per-patient admission count, mean length of stay and
    emergency rate on every row (whole history, as the original computes
    them, whatever ``timeframe_days`` says; the value only names the
    columns). ``with_days_since`` adds W1 from the same pass."""
    totals = {"_cnt": F.lit(1)}
    has_los = "length_of_stay" in df.columns
    has_em = "emergency_admission" in df.columns
    if has_los:
        totals["_los_s"] = F.col("length_of_stay").cast("double")
        totals["_los_n"] = F.col("length_of_stay").isNotNull().cast("long")
    if has_em:
        totals["_em_s"] = F.col("emergency_admission").cast("double")
        totals["_em_n"] = F.col("emergency_admission").isNotNull().cast("long")
    seq = entity_sequence(df, entity=patient_col, ts=date_col, tie=key, seq_col="_seq",
                          prev_col="_prev" if with_days_since else None, next_col=None,
                          totals=totals)
    out = seq.withColumn(f"admissions_last_{timeframe_days}d", F.col("_cnt").cast("long"))
    if has_los:
        out = out.withColumn(f"avg_los_last_{timeframe_days}d", F.try_divide("_los_s", "_los_n"))
    if has_em:
        out = out.withColumn(f"emergency_rate_last_{timeframe_days}d", F.try_divide("_em_s", "_em_n"))
    if with_days_since:
        out = out.withColumn("days_since_last", F.coalesce(
            floor_days_between(F.col(date_col), F.col("_prev")), F.lit(FIRST_ADMISSION_DAYS)).cast("long"))
    drop = [c for c in out.columns if c.startswith("_")]
    return out.drop(*drop)


def bounded_aggregates(df: DataFrame, patient_col: str = "patient_id", date_col: str = "admission_date",
                       days: int = 365) -> DataFrame:
    """W2-W4 in the documented form: over the patient's admissions whose day
    lies in [day - days, day] (same-day admissions included): count, mean
    length of stay, emergency rate. Rows without a date or patient get null.

    Rows are never windowed per patient: one summary row per (patient, day)
    carries running sums; the running sums just before the look-back start
    come from an as-of lookup (summary rows and probe rows in one window per
    patient, bounded by the patient's distinct days); the result joins back
    on (patient, day), the rows' own partitioning."""
    day = F.datediff(F.to_date(F.col(date_col)), F.lit("1970-01-01").cast("date"))
    x = df.withColumn("_day", day)
    keyed = x.where(F.col(patient_col).isNotNull() & F.col("_day").isNotNull())
    los = F.col("length_of_stay").cast("double") if "length_of_stay" in df.columns else F.lit(None).cast("double")
    em = F.col("emergency_admission").cast("double") if "emergency_admission" in df.columns \
        else F.lit(None).cast("double")
    parts = {"n": F.count(F.lit(1)), "ls": F.sum(los), "ln": F.count(los), "es": F.sum(em), "en": F.count(em)}
    summ = keyed.groupBy(patient_col, "_day").agg(*[v.alias(f"_{k}") for k, v in parts.items()])
    run = Window.partitionBy(patient_col).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    summ = summ.select(patient_col, "_day", *[F.coalesce(F.sum(f"_{k}").over(run), F.lit(0)).alias(f"_c{k}")
                                              for k in parts])
    cums = [f"_c{k}" for k in parts]
    probes = summ.select(patient_col, (F.col("_day") - days - 1).alias("_at"), F.col("_day").alias("_for"),
                         F.lit(1).alias("_probe"), *[F.lit(None).cast("double").alias(c) for c in cums])
    marks = summ.select(patient_col, F.col("_day").alias("_at"), F.lit(None).cast("int").alias("_for"),
                        F.lit(0).alias("_probe"), *[F.col(c).cast("double").alias(c) for c in cums])
    asof = Window.partitionBy(patient_col).orderBy("_at", "_probe").rowsBetween(Window.unboundedPreceding, 0)
    base = (marks.unionByName(probes)
            .select(patient_col, "_for", "_probe", *[F.last(c, ignorenulls=True).over(asof).alias(f"_b{c}")
                                                     for c in cums])
            .where(F.col("_probe") == 1).select(F.col(patient_col).alias("_bp"), F.col("_for").alias("_bd"),
                                                *[f"_b{c}" for c in cums]))
    cond = (F.col(patient_col) == F.col("_bp")) & (F.col("_day") == F.col("_bd"))
    win = summ.join(base, cond, "left").select(
        patient_col, "_day", *[(F.col(c) - F.coalesce(F.col(f"_b{c}"), F.lit(0.0))).alias(f"_w{c}") for c in cums])
    out = x.join(win, [patient_col, "_day"], "left")
    return (out.withColumn(f"admissions_in_{days}d", F.col("_w_cn").cast("long"))
            .withColumn(f"avg_los_in_{days}d", F.try_divide(F.col("_w_cls"), F.col("_w_cln")))
            .withColumn(f"emergency_rate_in_{days}d", F.try_divide(F.col("_w_ces"), F.col("_w_cen")))
            .drop("_day", *[f"_w{c}" for c in cums]))
