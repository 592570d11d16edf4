"""Data-quality profiling: one aggregate pass for all per-column metrics.

Everything is returned as tidy DataFrames ``(metric, column, value)`` so a
report of any width is one small table, not a nested dict on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.cleaning import NUMERIC_TYPES, string_columns


def _age_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if "age" in f.name.lower() and isinstance(f.dataType, NUMERIC_TYPES)]


# Index of the element that stands for a whole row in the profile's counts.
_ROW = -1


def _fingerprint(columns: list[Column]) -> list[Column]:
    """Two 64-bit hashes of some values; nulls count as values of their own."""
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns]) if columns else F.lit("")
    return [F.xxhash64(F.lit(seed), nulls, *columns) for seed in (1, 2)]


def _profile(df: DataFrame, approx_distinct: bool, duplicates: bool) -> DataFrame:
    """One row ``(rows, duplicates, cols)``; ``cols`` holds a struct per column.

    The rows are read once. Each becomes a few small elements (one per text
    value, one per missing or invalid value, one for the row), counted by
    (column, state, value hash) with a map-side combine; distinct values,
    missing values and duplicates are all sums over these counts."""
    texts, ages = set(string_columns(df)), set(_age_columns(df))
    none = [F.lit(0).cast("long")] * 2

    def element(i: int, state: Column, h: list[Column]) -> Column:
        return F.struct(F.lit(i).alias("i"), state.alias("state"), h[0].alias("h1"), h[1].alias("h2"))

    values = [F.array_sort(F.map_entries(F.col(f"`{f.name}`"))) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
              for f in df.schema.fields]
    elements = [element(_ROW, F.lit("value"), _fingerprint(values) if duplicates else none)]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        seen = F.when(c.isNull(), element(i, F.lit("missing"), none))
        if f.name in texts and not approx_distinct:
            seen = seen.otherwise(element(i, F.lit("value"), _fingerprint([c])))
        elif f.name in ages:
            seen = seen.when((c < 0) | (c > 120), element(i, F.lit("invalid"), none))
        elements.append(seen)
    counts = (df.select(F.explode(F.array_compact(F.array(*elements))).alias("e"))
              .groupBy("e.i", "e.state", "e.h1", "e.h2").agg(F.count(F.lit(1)).alias("n")))
    per = counts.groupBy("i").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("groups"),
        F.count_if(F.col("state") == "value").alias("distinct"),
        F.coalesce(F.sum(F.when(F.col("state") == "missing", F.col("n"))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.when(F.col("state") == "invalid", F.col("n"))), F.lit(0)).alias("invalid"))
    one = per.agg(F.map_from_entries(F.collect_list(F.struct(
        "i", F.struct("total", "groups", "distinct", "missing", "invalid")))).alias("m"))
    if approx_distinct:
        sketches = df.agg(F.array(*[F.approx_count_distinct(F.col(f"`{c}`")) if c in texts else F.lit(None).cast("long")
                                    for c in df.columns]).alias("sketch"))
        one = one.crossJoin(F.broadcast(sketches))  # one row each

    def got(i: int, field: str) -> Column:
        return F.coalesce(F.try_element_at("m", F.lit(i))[field], F.lit(0)).cast("long")

    cols = []
    for i, f in enumerate(df.schema.fields):
        distinct = F.lit(None) if f.name not in texts else F.col("sketch")[i] if approx_distinct else got(i, "distinct")
        invalid = got(i, "invalid") if f.name in ages else F.lit(None)
        cols.append(F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                             got(i, "missing").alias("missing"), distinct.cast("long").alias("distinct"),
                             invalid.cast("long").alias("invalid_age"),
                             F.try_divide(got(i, "missing") * F.lit(100.0), got(_ROW, "total")).alias("missing_pct")))
    return one.select(got(_ROW, "total").alias("rows"), (got(_ROW, "total") - got(_ROW, "groups")).alias("duplicates"),
                      F.array(*cols).alias("cols"))


def column_profile(df: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """One row per column: type, missing count and percent (null for a table
    without rows), distinct count (text columns), invalid ages (numeric '*age*'
    columns). The table is read once.

    Distinct values are told apart by two 64-bit hashes;
    ``approx_distinct=True`` takes HyperLogLog sketches instead, with a second
    read of the text columns."""
    return _profile(df, approx_distinct, duplicates=False).select("rows", F.inline("cols"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier row over all columns (nulls equal): one
    shuffle of the rows grouped by all columns, then a one-row sum."""
    return (df.groupBy(*df.columns).count()
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicates")))


def quality_report(df: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Tidy report ``(metric, column, value)``: totals, missing counts and
    percents, duplicates, and the issue flags (> 50% missing, text column
    with distinct values above 90% of rows, ages outside 0..120). Every metric
    comes from one read of the table (:func:`_profile`); rows are equal, and so
    duplicates, where two 64-bit hashes of all their values are."""
    def item(metric: str, column: Column, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), column.cast("string").alias("column"), value.cast("double").alias("value"))

    def of_column(c: Column) -> Column:
        name, rows = c["column"], F.col("rows")
        issues = F.filter(F.array(
            item("issue_missing_gt_50", name, F.when(c["missing_pct"] > 50, c["missing_pct"])),
            item("issue_high_cardinality", name, F.when(c["distinct"] > rows * 0.9, c["distinct"])),
            item("issue_invalid_age", name, F.when(c["invalid_age"] > 0, c["invalid_age"]))), lambda m: m["value"].isNotNull())
        return F.concat(F.array(item("missing_count", name, c["missing"]), item("missing_pct", name, c["missing_pct"])), issues)

    no = F.lit(None)
    totals = F.array(item("total_records", no, F.col("rows")), item("total_columns", no, F.lit(float(len(df.columns)))),
                     item("duplicates", no, F.col("duplicates")))
    return (_profile(df, approx_distinct, duplicates=True)
            .select(F.inline(F.concat(totals, F.flatten(F.transform("cols", of_column))))))


def missing_summary(df: DataFrame) -> DataFrame:
    """Columns with missing values: count and percent, most missing first."""
    return (column_profile(df).where(F.col("missing") > 0)
            .select("column", F.col("missing").cast("long").alias("missing"),
                    F.round("missing_pct", 6).alias("missing_pct"))
            .orderBy(F.col("missing").desc(), F.col("column")))


def dtype_counts(df: DataFrame) -> DataFrame:
    """Number of columns per data type (schema only, no job)."""
    spark = df.sparkSession
    types = [f.dataType.simpleString() for f in df.schema.fields]
    counts = [(t, types.count(t)) for t in sorted(set(types))]
    return spark.createDataFrame(counts, "dtype string, columns long")


def dtype_profile(df: DataFrame) -> DataFrame:
    """Columns per data type with their values and missing values."""
    return column_profile(df).groupBy("dtype").agg(F.count(F.lit(1)).alias("columns"), F.sum(F.col("rows") - F.col("missing")).alias("present"),
                                                   F.sum("missing").alias("missing"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max per column
    (``summary()`` would give approximate quartiles). Moments in one aggregate;
    the quartiles of all columns come from one search by narrowing histograms."""
    from wardflow.operators.selection import quantiles
    marks = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    found = quantiles(df, {f"{i} {m}": (c, q) for i, c in enumerate(columns) for m, q in marks.items()})
    structs = []
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`").cast("double")
        quartiles = [F.lit(found[f"{i} {m}"]).cast("double").alias(m) for m in marks]
        structs.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                                F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"), *quartiles))
    return df.agg(F.array(*structs).alias("s")).select(F.inline("s"))


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Non-null value counts, most frequent first (ties by value)."""
    out = (df.where(F.col(column).isNotNull()).groupBy(column)
           .agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(column)))
    return out.limit(n) if n else out


def distinct_with_null(df: DataFrame, column: str) -> DataFrame:
    """Distinct values counting null as one value (like ``unique()``)."""
    c = F.col(column)
    return df.agg((F.count_distinct(c) + F.max(c.isNull().cast("int"))).cast("long").alias("n_unique"))
