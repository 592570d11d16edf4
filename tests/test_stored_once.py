"""Raw and cleaned rows are derived once for the training and the scoring job."""

from types import SimpleNamespace

from conftest import SF_SMALL
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from wardflow.ml import jobs, scoring
from wardflow.ml import training as TR
from wardflow.ml.preparation import fit_preparation
from wardflow.plans import q_ml
from wardflow.session import materialize, stored_stages
from wardflow.sources import binding

write = DataFrameWriter.parquet


def test_raw_rows_are_derived_once(spark, monkeypatch):
    calls, given, plain = [], [], q_ml.admissions
    monkeypatch.setattr(q_ml, "admissions", lambda *a: calls.append(a) or plain(*a))
    monkeypatch.setattr(jobs, "training_job", lambda raw, *a, **k: given.append(raw) or SimpleNamespace(model_path=""))
    monkeypatch.setattr(scoring, "batch_scoring_job", lambda s, model, path, out: s.read.option("header", True).csv(path))
    scored = q_ml._scored_file(spark, SF_SMALL)
    assert len(calls) == 1 and scored.count() == plain(spark, SF_SMALL).count()
    assert given[0].inputFiles() and all("wardflow-raw-" in f for f in given[0].inputFiles())


def test_cleaned_rows_are_stored_for_the_history(spark):
    raw = spark.createDataFrame([(k, f"P{k % 3}", 40.0 + k, "M", f"2024-01-{k + 1:02d}", 2.0, 1, "250.00", k, "Medicare") for k in range(9)],
                                ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in q_ml.RAW_SCHEMA if f.name != "readmission_30_day"))
    p = fit_preparation(raw)
    before = len(stored_stages())
    with_history, alone = p.features(raw), p.features(raw, history=False)
    assert [x.rsplit("/", 1)[1][:16] for x in stored_stages()[before:]] == ["wardflow-cleaned"]
    assert {r.admission_key: r.days_since_last_admission for r in with_history.collect()} == {k: 999 if k < 3 else 3 for k in range(9)}
    assert alone.count() == 9


def test_a_stored_table_is_not_stored_again_for_its_split(spark):
    rows = spark.range(500).selectExpr("id AS admission_key", "CAST(id % 3 = 0 AS DOUBLE) AS label", "CAST(id % 7 AS DOUBLE) AS a")
    stored = materialize(rows, "matrix")
    before = len(stored_stages())
    parts = [TR.stratified_split(df, store=True) for df in (stored, rows)]
    assert [x.rsplit("/", 1)[1].rsplit("-", 1)[0] for x in stored_stages()[before:]] == ["wardflow-hashes", "wardflow-hashes", "wardflow-split"]
    for a, b in zip(*parts):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert parts[0][1].count() == 100


def test_the_model_table_is_stored_once(spark):
    before = len(stored_stages())
    q_ml.matrix(spark, SF_SMALL)
    names = [x.rsplit("/", 1)[1].split("-")[1] for x in stored_stages()[before:]]
    assert names.count("matrix") == 1 and "featured" not in names


def test_codes_are_joined_after_the_rows_have_moved(spark):
    token = lambda *i: sum(1 << k for k in i)
    rows = spark.createDataFrame([(0, token(0, 2)), (1, 0), (2, None), (3, token(45, 44, 1))], "k int, bits long")
    got = rows.select("k", binding._joined_codes(F.col("bits"), F.when(F.col("k") == 0, ";").otherwise("|")).alias("c"))
    assert {r.k: r.c for r in got.collect()} == {0: "250.00;E11.9", 1: "", 2: None, 3: "  |401.9|HBP"}
    plan = binding.admissions(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "concat_ws" in plan.split("Window")[0]  # above the shuffle by patient


def test_stored_stages_run_compiled_methods(spark, monkeypatch):
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, **k: seen.append(spark.conf.get(name)) or write(self, path, **k))
    assert materialize(spark.range(3), "x").count() == 3
    assert seen == ["8000"] and spark.conf.get(name) == before
