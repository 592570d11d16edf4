"""Group-by analytics: rates by group, relative risks, crosstabs,
histograms, box statistics, correlations, top-k.

Every function is one or two aggregate jobs with map-side partial
aggregation; ``min``/``max`` needed for equal-width bins come from a
one-row aggregate that is broadcast (its size is fixed at one row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rate_by(df: DataFrame, group: str | Column, target: str = "readmission_30_day",
            name: str | None = None) -> DataFrame:
    """Mean of the 0/1 target and row count per group (null group dropped)."""
    g = F.col(group) if isinstance(group, str) else group
    gname = name or (group if isinstance(group, str) else "group")
    return (df.select(g.alias(gname), F.col(target).alias("_t")).where(F.col(gname).isNotNull())
            .groupBy(gname).agg(F.avg("_t").alias("rate"), F.count(F.lit(1)).alias("n")))


def relative_risk(df: DataFrame, flags: Sequence[str], target: str = "readmission_30_day") -> DataFrame:
    """Per 0/1 flag: rate with the flag, rate without, their ratio (null
    when the rate without is 0). One pass with conditional averages."""
    structs = [F.struct(F.lit(f).alias("flag"),
                        F.avg(F.when(F.col(f) == 1, F.col(target))).alias("rate_with"),
                        F.avg(F.when(F.col(f) == 0, F.col(target))).alias("rate_without")) for f in flags]
    out = df.agg(F.array(*structs).alias("s")).select(F.inline("s"))
    return out.withColumn("relative_risk", F.try_divide("rate_with", "rate_without"))


def crosstab_normalized(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts per (row, col) divided by the row total (long format)."""
    c = df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row, col).agg(
        F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(row)))


def crosstab_counts(df: DataFrame, row: str, col: str) -> DataFrame:
    return df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, column: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max] of the whole column (last bin
    closed): bin index, lower edge, count and density per (group, bin)."""
    x = F.col(column)
    mm = df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"))
    rows = df.where(x.isNotNull()).crossJoin(F.broadcast(mm))
    width = (F.col("_mx") - F.col("_mn")) / F.lit(float(bins))
    idx = F.least(F.lit(bins - 1), F.floor((x - F.col("_mn")) * F.lit(float(bins)) / (F.col("_mx") - F.col("_mn"))))
    idx = F.coalesce(idx, F.lit(0)).cast("int")
    keys = ([by] if by else []) + ["bin"]
    h = (rows.withColumn("bin", idx).withColumn("_w", width).withColumn("_lo", F.col("_mn") + F.col("bin") * width)
         .groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.first("_lo").alias("lower_edge"),
                             F.first("_w").alias("_w")))
    part = Window.partitionBy(*([by] if by else []))
    return h.withColumn("density", F.col("n") / (F.sum("n").over(part) * F.col("_w"))).drop("_w")


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers (clamped to the data) per group;
    exact quartiles by the distributed quantile job."""
    from wardflow.operators.quantiles import exact_quantiles
    q = (exact_quantiles(df, value, [0.25, 0.5, 0.75], [by]).groupBy(by)
         .pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value")).toDF(by, "q1", "median", "q3"))
    s = df.groupBy(by).agg(F.min(value).alias("min"), F.max(value).alias("max"), F.count(F.lit(1)).alias("n"))
    iqr = F.col("q3") - F.col("q1")
    return s.join(q, by).select(by, "n", "q1", "median", "q3",
                                F.greatest(F.col("min"), F.col("q1") - 1.5 * iqr).alias("whisker_low"),
                                F.least(F.col("max"), F.col("q3") + 1.5 * iqr).alias("whisker_high"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, pairwise-complete rows,
    all pairs in one aggregate."""
    structs = []
    for a in columns:
        for b in columns:
            structs.append(F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                                    F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("corr")))
    return df.agg(F.array(*structs).alias("s")).select(F.inline("s"))


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First n rows in the given order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)
