"""Date texts and code sets: the cheap forms give what the plain ones give."""

from pyspark.sql import functions as F

from wardflow.functions import dates as D
from wardflow.sources import binding as B


def test_shapes_let_every_readable_text_through(spark):
    texts = ["2014-03-15", "2014-3-5", "+12014-3-5", "0003/15/2014", "3/15/2014", "15-06-2014", "06-15-2014", "1/22/14", "22/01/2014", "2014/1/2", "20140812", "201408123",
             "-20140812", "2014-03-15 07:00:00", "2014-03-15T07:00:00Z", " March 5, 2014 ", "MAR 5, 2014", "5 march 2014", "5 Mar 2014", "March 5,2014", "2014", "2014-02-30",
             "٢٠١٤-٠٣-١٥", "2014-03-15\n", "2014--3-15", "none", "", None, "x", "12/31/+2014", "2014-03", "1-1-0001"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    c = F.col("t")
    tries = [F.try_to_timestamp(c, F.lit(f)) for f in D.SPARK_DATE_FORMATS] + [F.try_to_timestamp(F.trim(c))]
    tries += [F.try_to_timestamp(F.trim(c), F.lit(f)) for f in D.SPARK_FREEFORM_FORMATS]
    plain = F.when(D.is_date_sentinel(c), None).otherwise(F.coalesce(*tries))
    assert df.where(~plain.cast("string").eqNullSafe(D.parse_date("t").cast("string"))).collect() == []
    # A pattern is tried on texts of its shape only.
    assert "RLIKE" in str(D.parse_date("t")).upper()


def test_codes_of_an_order_are_a_sorted_set_without_collecting_values(spark, tmp_path):
    lines = [(1, p, n, 3.0) for p, n in ((5, 1), (5, 1), (45, 1), (7, 3), (None, 2), (44, 1))] + [(2, None, 1, 6.0), (None, 1, 1, 9.0), (3, -3, 1, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = B._per_order(spark, str(tmp_path))
    token = lambda p, n: B.CODE_TOKENS[(p + n) % len(B.CODE_TOKENS)]
    want = {1: (1.0, sorted({token(5, 1), token(45, 1), token(7, 3), token(44, 1)})), 2: (2.0, []), None: (3.0, [token(1, 1)]), 3: (None, [token(-3, 1)])}
    assert {r.l_orderkey: (r._los, r._codes) for r in got.collect()} == want
    assert "collect_set" not in got._jdf.queryExecution().toString()
