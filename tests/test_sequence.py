"""entity_sequence equals a plain per-entity window, also with a hot entity,
null entities and null times."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from wardflow.operators.sequence import entity_sequence


def test_matches_plain_window(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(3000):
        ent = "hot" if rnd.random() < 0.4 else (None if rnd.random() < 0.02 else f"e{rnd.randint(0, 50)}")
        day = None if rnd.random() < 0.03 else dt.datetime(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 60),
                                                                                       hours=rnd.randint(0, 23))
        rows.append((k, ent, day, float(rnd.randint(0, 9))))
    df = spark.createDataFrame(rows, "k long, e string, ts timestamp, v double")
    got = entity_sequence(df, "e", "ts", "k", totals={"tot": F.col("v")})
    w = Window.partitionBy("e").orderBy(F.col("ts").asc_nulls_last(), "k")
    exp = (df.where(F.col("e").isNotNull())
           .select("k", F.row_number().over(w).alias("seq"), F.lag("ts").over(w).alias("prev_ts"),
                   F.lead("ts").over(w).alias("next_ts"), F.sum("v").over(Window.partitionBy("e")).alias("tot")))
    a = {r.k: (r.seq, r.prev_ts, r.next_ts, r.tot) for r in got.where(F.col("e").isNotNull()).collect()}
    b = {r.k: (r.seq, r.prev_ts, r.next_ts, r.tot) for r in exp.collect()}
    assert a == b
    nulls = got.where(F.col("e").isNull()).collect()
    assert all(r.seq is None for r in nulls) and len(a) + len(nulls) == 3000


def _undated_rows(n: int, rnd: random.Random) -> list:
    rows = []
    for k in range(n):
        ent = "hot" if rnd.random() < 0.9 else f"e{rnd.randint(0, 5)}"
        x = rnd.random()
        day = None if x < 0.6 else dt.datetime(1900, 1, 1) if x < 0.9 else \
            dt.datetime(1900, 1, 1, rnd.randint(0, 2)) if x < 0.93 else dt.datetime(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 9))
        tie = None if rnd.random() < 0.0002 else (k * 7 - 20000 if rnd.random() < 0.9 else k)
        rows.append((k, tie, ent, day))
    return rows


def test_undated_rows_of_one_entity_are_cut_and_keep_their_order(spark):
    rows = _undated_rows(6000, random.Random(5))
    df = spark.createDataFrame(rows, "k long, tie long, e string, ts timestamp")
    ties = [r[1] for r in rows if r[1] is not None]
    unique = df.where(F.col("tie").isNull() | F.col("tie").isin([t for t in set(ties) if ties.count(t) == 1]))
    unique = unique.dropDuplicates(["e", "ts", "tie"])
    for data in (unique, unique.withColumn("ts", F.to_date("ts"))):
        got = entity_sequence(data, "e", "ts", "tie", totals={"tot": F.lit(1)}, block_bits=8)
        w = Window.partitionBy("e").orderBy(F.col("ts").asc_nulls_last(), F.col("tie").asc_nulls_last())
        exp = data.withColumns({"seq": F.row_number().over(w).cast("long"), "prev_ts": F.lag("ts").over(w), "next_ts": F.lead("ts").over(w),
                                "tot": F.count(F.lit(1)).over(Window.partitionBy("e"))})
        cols = ["e", "ts", "tie", "seq", "prev_ts", "next_ts", "tot"]
        assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, exp.select(cols).collect()))


def test_undated_rows_of_one_entity_spread_over_partitions(spark):
    df = spark.range(40000).select(F.col("id").alias("k"), F.lit("hot").alias("e"),
                                   F.when(F.col("id") % 10 == 0, F.lit("2020-01-01")).cast("timestamp").alias("ts"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables that are not small
    try:
        seq = entity_sequence(df, "e", "ts", "k", block_bits=8).withColumn("p", F.spark_partition_id())
        sizes = [r.n for r in seq.groupBy("p").agg(F.count("seq").alias("n"), F.max("seq").alias("top"), F.max("prev_ts")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(sizes) == 40000 and len(sizes) == partitions and max(sizes) < 40000 / partitions * 1.6, sizes


def test_bounded_aggregates_match_range_window(spark):
    from wardflow.operators.temporal import bounded_aggregates
    rnd = random.Random(9)
    rows = []
    for k in range(2000):
        p = "hot" if rnd.random() < 0.35 else f"p{rnd.randint(0, 40)}"
        d = None if rnd.random() < 0.03 else dt.datetime(2019, 1, 1) + dt.timedelta(days=rnd.randint(0, 900))
        rows.append((k, p, d, float(rnd.randint(1, 9)), float(rnd.randint(0, 1))))
    df = spark.createDataFrame(rows, "k long, patient_id string, admission_date timestamp, length_of_stay double, "
                                     "emergency_admission double")
    got = {r.k: (r.admissions_in_365d, r.avg_los_in_365d, r.emergency_rate_in_365d)
           for r in bounded_aggregates(df).collect()}
    day = F.datediff(F.to_date("admission_date"), F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy("patient_id").orderBy("_d").rangeBetween(-365, 0)
    exp = df.withColumn("_d", day).select(
        "k", F.when(F.col("_d").isNotNull(), F.count(F.lit(1)).over(w)).alias("n"),
        F.when(F.col("_d").isNotNull(), F.avg("length_of_stay").over(w)).alias("los"),
        F.when(F.col("_d").isNotNull(), F.avg("emergency_admission").over(w)).alias("em"))
    for r in exp.collect():
        g = got[r.k]
        assert g[0] == r.n
        assert (g[1] is None and r.los is None) or abs(g[1] - r.los) < 1e-9
        assert (g[2] is None and r.em is None) or abs(g[2] - r.em) < 1e-9
