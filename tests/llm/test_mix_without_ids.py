"""Rows without an id are dealt over the ranges by their text, and the mix still meets its targets."""

from pyspark.sql import functions as F

from wardflow.llm.source_mix import mix_sources


def test_rows_without_ids_spread_and_meet_the_target(spark):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("doc_id"),
                                    F.concat(F.lit("w "), F.repeat(F.lit("x "), (F.col("id") % 5).cast("int")), F.col("id").cast("string")).alias("text"),
                                    F.when(F.col("id") % 2 == 0, "a").alias("source"))
    m = mix_sources(docs, (2, 3), 1.2, rows_per_range=64)
    for r in m.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"),
                                     F.count_if(F.expr("part > 0 AND part < size")).alias("cut"), F.max(F.col("taken") / F.col("size")).alias("most")).collect():
        assert r.taken == int(r.target + 0.5) and r.cut <= 1 and r.most <= 2
    # The cut falls inside the rows without an id, not before or after all of them.
    none = m.where("doc_id IS NULL AND source IS NULL").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr("part = 0")).alias("left")).first()
    again = mix_sources(docs, (2, 3), 1.2, rows_per_range=64)
    assert sorted(map(str, m.collect())) == sorted(map(str, again.collect()))
    assert 0 < none.left < none.n
