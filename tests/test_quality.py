"""The one-pass profile equals plain counts, on gaps, repeats, odd values and empty tables."""

import pytest
from pyspark.sql import functions as F

from wardflow.operators import quality as QA

ROWS = [("a", "x", 10.0, 1, {"k": 1}), ("a", "x", 10.0, 1, {"k": 1}), (None, "x", 130.0, None, None), ("x", None, -1.0, 2, None),
        ("", None, None, 2, {}), (None, "", None, 2, {}), ("a", "x", 10.0, 1, {"k": 1})]
SCHEMA = "name string, other string, age double, `a.b` int, tags map<string,int>"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_profile_counts(table):
    got = {r["column"]: r for r in QA.column_profile(table).collect()}
    assert {c: r.missing for c, r in got.items()} == {"name": 2, "other": 2, "age": 2, "a.b": 1, "tags": 2}
    assert (got["name"].distinct, got["other"].distinct, got["age"].distinct) == (3, 2, None)
    assert (got["age"].invalid_age, got["name"].invalid_age) == (2, None)
    assert got["a.b"].rows == 7 and got["a.b"].missing_pct == 1 * 100.0 / 7 and got["a.b"].dtype == "int"


def test_report_duplicates_and_issues(table):
    got = {(r.metric, r["column"]): r.value for r in QA.quality_report(table).collect()}
    assert got["duplicates", None] == 2 and got["total_records", None] == 7 and got["total_columns", None] == 5
    assert got["issue_invalid_age", "age"] == 2 and ("issue_missing_gt_50", "name") not in got
    assert got["missing_count", "tags"] == 2


def test_swapped_nulls_are_no_duplicates(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("aa", None), (None, None), (None, None)], "x string, y string")
    got = {(r.metric, r["column"]): r.value for r in QA.quality_report(df).collect()}
    assert got["duplicates", None] == 1 == QA.duplicate_count(df).first().duplicates


def test_sketches_and_empty_tables(table):
    got = {r["column"]: r.distinct for r in QA.column_profile(table, approx_distinct=True).collect()}
    assert got["name"] == 3 and got["age"] is None
    empty = table.where(F.lit(False))
    assert all(r.rows == 0 and r.missing == 0 and r.missing_pct is None for r in QA.column_profile(empty).collect())
    got = {(r.metric, r["column"]): r.value for r in QA.quality_report(empty).collect()}
    assert got["duplicates", None] == 0 and got["total_records", None] == 0
    assert not [k for k in got if k[0].startswith("issue")]


def test_report_reads_its_table_once_with_few_exchanges(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QA.quality_report(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange") <= 4 and "Expand" not in plan
