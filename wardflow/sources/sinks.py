"""Sinks: scored rows, metric tables, text reports, run-stamped paths."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row, no index column; values written as they
    are (no whitespace trimming), null as an empty field."""
    (df.write.mode(mode).option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Default sink for large outputs; optional partition columns."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_metrics_json(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tidy metric rows as JSON lines; nested values as JSON text."""
    metrics.write.mode(mode).json(path)


def write_json_arrays(df: DataFrame, path: str, key: str, block: int = 16384, mode: str = "overwrite") -> None:
    """JSON files of one array of records each: the rows whose integer ``key`` lies
    in the same block of ``block`` values (so a file is bounded where keys are
    unique), one sub-folder per block. Nulls are written as fields."""
    rows = df.groupBy(F.floor(F.col(key) / block).alias("block")).agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("rows"))
    text = F.to_json("rows", {"ignoreNullFields": "false"})
    rows.select("block", text.alias("value")).write.mode(mode).partitionBy("block").text(path)


def metrics_as_json_text(metrics: DataFrame) -> DataFrame:
    """S7 nested form: every row serialised to one JSON document."""
    return metrics.select(F.to_json(F.struct(*metrics.columns)).alias("json"))


def render_report(metrics_row: DataFrame, template: str, columns: list[str]) -> DataFrame:
    """One text line per metric row from a printf-style template."""
    return metrics_row.select(F.format_string(template, *[F.col(c) for c in columns]).alias("value"))


def write_text(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    lines.coalesce(1).write.mode(mode).text(path)


def run_stamp(now: _dt.datetime | None = None) -> str:
    """Run identifier used as a ``run_ts=`` path partition."""
    return (now or _dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


def stamped_path(base: str, now: _dt.datetime | None = None) -> str:
    return f"{base.rstrip('/')}/run_ts={run_stamp(now)}"
