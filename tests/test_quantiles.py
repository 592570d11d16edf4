"""Distributed exact quantiles against numpy / pandas."""

import random

import numpy as np
import pytest

from wardflow.operators.quantiles import exact_quantiles, quantile_columns


def test_matches_numpy_with_ties_and_groups(spark):
    rnd = random.Random(5)
    rows = [(g, float(rnd.randint(0, 300)) / 7) for g in ("a", "b", "c") for _ in range(400 if g != "c" else 3)]
    rows += [("a", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r.g, r.q): r.value for r in exact_quantiles(df, "x", probs, ["g"]).collect()}
    for g in ("a", "b", "c"):
        xs = np.array([x for gg, x in rows if gg == g and x is not None])
        for q in probs:
            assert got[(g, q)] == pytest.approx(float(np.quantile(xs, q)), rel=1e-12, abs=1e-12)


def test_quantile_columns_one_row(spark):
    df = spark.createDataFrame([(float(i), float(i % 5)) for i in range(1, 11)], "a double, b double")
    row = quantile_columns(df, {"a_med": ("a", 0.5), "b_p90": ("b", 0.9)}).first()
    assert row.a_med == pytest.approx(5.5) and row.b_p90 == pytest.approx(float(np.quantile([i % 5 for i in range(1, 11)], 0.9)))


def test_quantile_columns_against_numpy(spark):
    rows = [(float(i) / 3, float(i % 7)) for i in range(1, 500)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = quantile_columns(df, {"a_p01": ("a", 0.01), "a_med": ("a", 0.5), "b_p75": ("b", 0.75)}).first()
    a, b = zip(*rows)
    assert got.a_p01 == pytest.approx(np.quantile(a, 0.01)) and got.a_med == pytest.approx(np.quantile(a, 0.5))
    assert got.b_p75 == pytest.approx(np.quantile(b, 0.75))


def test_patient_ids_are_never_cut(spark):
    from pyspark.sql import functions as F

    from wardflow.sources.binding import padded_id
    got = spark.createDataFrame([(7,), (123456,), (1234567,), (1234568,)], "k long").select(padded_id(F.col("k"))).collect()
    assert [r[0] for r in got] == ["PID_000007", "PID_123456", "PID_1234567", "PID_1234568"]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    from pyspark.sql import types as T

    from wardflow.sources.readers import read_csv
    path = str(tmp_path / "x.csv")
    with open(path, "w") as f:
        f.write("gender,age,patient_id,note\nF,71,PID_1,a\nM,,PID_2,b\n")
    schema = T.StructType([T.StructField("patient_id", T.StringType()), T.StructField("age", T.DoubleType()), T.StructField("gender", T.StringType())])
    assert [tuple(r) for r in read_csv(spark, path, schema).collect()] == [("PID_1", 71.0, "F", "a"), ("PID_2", None, "M", "b")]
    schema.add("stay", T.DoubleType())
    with pytest.raises(ValueError):
        read_csv(spark, path, schema)
    assert read_csv(spark, path, schema, allow_missing=True).columns == ["patient_id", "age", "gender", "note"]
