"""The compiled probe of template windows gives the rows of the plain join, and all results are the same with either form."""

import pytest
from pyspark.sql import functions as F

from wardflow.llm import decontaminate as D
from wardflow.llm.common import table

SF = "/root/testdata/sf0.001"
ITEMS = [(1, "Anna has 12 apples, and Tom gives her 30 kg more; how many apples does Anna have in total now?"),
         (2, "one two three four five six seven eight nine ten"), (3, "add 5 6 7 8 and 9 then 10 to the sum"), (4, None), (5, ""), (6, "two words")]
TEXTS = [(1, "x, Anna has 12 apples, and Tom gives her 30 kg more; how many apples does Anna have in total now?"),
         (2, "ANNA HAS 12 APPLES, AND TOM GIVES HER 30 KG MORE; HOW MANY APPLES DOES ANNA HAVE IN TOTAL NOW?"),
         (3, "so Eve has 7 apples, and Jim gives her 8 kg more; how many apples does Eve have in total now?"),
         (4, "one two three four five six seven eight"), (5, "now add 5 6 7 8 and 9 then 10 to the sum"), (6, "two words"), (7, None), (8, ""),
         (None, "one two three four five six seven eight nine ten"), (8, "one two three four five six seven eight nine, Ten"),
         (9, "9" * 200000 + " one two three four five six seven eight " + "Word, Word " * 20000)]


def frames(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("window, whole_only", [(8, False), (4, False), (2, True)])
def test_probe_equals_join(spark, window, whole_only):
    docs, bench = frames(spark)
    docs = docs.unionByName(table(spark, SF, "documents").select("doc_id", "text"))
    bench = bench.unionByName(table(spark, SF, "benchmark").select(F.col("item_id").cast("long"), "text"))
    b = D.template_windows(bench, ["item_id"], window, whole_only=whole_only).select(
        "item_id", F.col("pos").alias("b_pos"), "h", F.col("slots").alias("b_slots"), F.col("way").alias("b_way"))
    got = D.window_hits(docs, ["doc_id"], b, window, whole_only=whole_only)
    exp = D.template_windows(docs, ["doc_id"], window, whole_only=whole_only).join(b, "h").where(F.size("slots") == F.size("b_slots"))
    rows = sorted(map(str, exp.select(*got.columns).collect()))
    assert rows and sorted(map(str, got.collect())) == rows


def test_results_do_not_depend_on_the_form(spark, monkeypatch):
    docs, bench = frames(spark)
    got = sorted(map(str, D.contaminated(docs, bench).collect()))
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert sorted(map(str, D.contaminated(docs, bench).collect())) == got
    found = {r.doc_id for r in D.contaminated(docs, bench.where("item_id <= 2")).collect()}
    assert {1, 2, 3, 4, 8, 9, None} <= found and 7 not in found
