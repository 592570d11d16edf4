"""Exact quantiles (linear interpolation) computed as distributed jobs.

Whole columns are searched by narrowing histograms
(:mod:`wardflow.operators.selection`); quantiles per group as follows.

Spark's ``percentile`` merges one value -> count map per group in a single
task, which grows with the number of distinct values. Here the distinct
values are counted with a map-side combine, ranked with
:func:`running_counts`, and only the (at most two per probability) values
that bracket the interpolation position are kept: position
``h = (n - 1) * q``, result ``v[floor h] + (v[ceil h] - v[floor h]) * (h - floor h)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.prefix import running_counts
from wardflow.operators.selection import quantiles


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Long result: ``*by, q, value`` for every probability (groups without
    values are absent)."""
    by = list(by)
    v = (df.where(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("_v"))
         .groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("cnt")))
    r = running_counts(v, "_v", ["cnt"], by)
    qs = F.array(*[F.lit(float(q)) for q in probs])
    r = r.select(*by, "_v", "cnt", "cnt_below", "total_cnt", F.explode(qs).alias("q"))
    h = (F.col("total_cnt") - 1) * F.col("q")
    lo, hi = F.floor(h), F.ceil(h)
    covers = lambda k: (F.col("cnt_below") <= k) & (k < F.col("cnt_below") + F.col("cnt"))
    hits = r.where(covers(lo) | covers(hi)).select(
        *by, "q", h.alias("_h"), lo.alias("_lo"),
        F.when(covers(lo), F.col("_v")).alias("_lv"), F.when(covers(hi), F.col("_v")).alias("_hv"))
    agg = hits.groupBy(*by, "q").agg(F.max("_lv").alias("_lv"), F.max("_hv").alias("_hv"),
                                     F.first("_h").alias("_h"), F.first("_lo").alias("_lo"))
    val = F.col("_lv") + (F.col("_hv") - F.col("_lv")) * (F.col("_h") - F.col("_lo"))
    return agg.select(*by, "q", val.alias("value"))


def quantile_row(df: DataFrame, column: str, probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """One row with one column per probability (null when no values)."""
    names = list(names or [f"q{i}" for i in range(len(probs))])
    return quantile_columns(df, {n: (column, float(q)) for n, q in zip(names, probs)})


def quantile_columns(df: DataFrame, specs: dict[str, tuple[str, float]]) -> DataFrame:
    """One row: name -> quantile of (column, q), by narrowing histograms over all
    columns at once (:mod:`wardflow.operators.selection`)."""
    found = quantiles(df, specs)
    return df.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(n) for n, v in found.items()])


def clamp(c: Column, lo: Column, hi: Column) -> Column:
    """least(greatest(c, lo), hi) with nulls kept null."""
    return F.when(c.isNull(), c).otherwise(F.least(F.greatest(c.cast("double"), lo), hi))
