"""Mixing sources to target weights: hash-random order per source, cut at the
exact budget by distributed prefix sums, repeated for whole epochs.

The order key of a row is md5(seed + doc_id, or the text's md5 where there is no id), so its leading bits cut each
source into ranges of about ``rows_per_range`` rows without sampling. Range
totals give every range its offset (two levels, so that no task orders all
ranges of one source), and only rows of one range are ordered together.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import WORD, table, text_col

SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """One row per source: ``__src, source_size, target``.

    Weights go to the sources by code point (null last), repeating; the total
    ``share`` x all sizes is poured by weight until a source holds ``most``
    times its size. In closed form: ordered by limit / weight, the level is
    what is left per unit of weight at the first source that stays below its
    limit. The table has one row per source."""
    by_name = Window.orderBy(F.col("__src").isNull(), "__src")
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (((F.col("__rn") - 1) % len(weights)) + 1).cast("int"))
    s = (sizes.withColumn("__rn", F.row_number().over(by_name)).withColumn("__w", w)
         .withColumn("__cap", F.lit(float(most)) * F.col("source_size")))
    order = Window.orderBy(F.col("__cap") / F.col("__w"), "__rn")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    s = (s.withColumn("__left", F.sum("source_size").over(every) * F.lit(float(share))
                      - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
          .withColumn("__rest", F.sum("__w").over(every) - F.coalesce(F.sum("__w").over(before), F.lit(0)))
          .withColumn("__level", F.col("__left") / F.col("__rest"))
          .withColumn("__pos", F.row_number().over(order)))
    below = F.col("__level") <= F.col("__cap") / F.col("__w")
    s = s.withColumn("__level", F.min_by(F.when(below, F.col("__level")), F.when(below, F.col("__pos"))).over(every))
    return s.select("__src", "source_size", F.least("__cap", F.col("__w") * F.col("__level")).alias("target"))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2,
                seed: str = SEED, rows_per_range: int = 1024) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target``, ``epochs``
    (whole repeats of the source), ``part`` (words taken once more) and
    ``taken`` = epochs x size + part.

    The words taken from a source sum to its target rounded to an integer; at
    most one document per source is cut. Null text has size 0; a null source
    is a source of its own, last in order; rows without an id
    are ordered by a hash of their text; very long texts are only counted; repeated rows are separate rows of the mix; an empty table
    gives an empty result; existing columns of these names are replaced."""
    # Rows without an id are dealt by their text, so that many of them do not share one range.
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.md5(text_col()))))
    bits = max(0, math.ceil(math.log2(max(1, docs.count()) / rows_per_range)))
    d = (docs.drop("size", "source_size", "target", "epochs", "part", "taken")
         .withColumn("size", F.regexp_count(text_col(), F.lit(WORD)).cast("long")).withColumn("__key", key)
         .withColumn("__src", F.col("source"))
         .withColumn("__range", F.shiftright(F.conv(F.substring("__key", 1, 12), 16, 10).cast("long"), 48 - bits))
         .withColumn("__hi", F.shiftright("__range", bits // 2)))
    ranges = d.groupBy("__src", "__hi", "__range").agg(F.sum("size").alias("__n"))
    tops = ranges.groupBy("__src", "__hi").agg(F.sum("__n").alias("__n"))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    tops = tops.select("__src", "__hi", zero(F.sum("__n").over(before("__src").orderBy("__hi"))).alias("__top"))
    lows = ranges.select("__src", "__hi", "__range",
                         zero(F.sum("__n").over(before("__src", "__hi").orderBy("__range"))).alias("__low"))
    targets = source_targets(ranges.groupBy("__src").agg(F.sum("__n").alias("source_size")), weights, share, most)
    t, lo = tops.alias("t"), lows.alias("l")
    offsets = lo.join(t, F.col("l.__src").eqNullSafe(F.col("t.__src")) & (F.col("l.__hi") == F.col("t.__hi"))).select(
        F.col("l.__src").alias("__s"), F.col("l.__range").alias("__r"), (F.col("__low") + F.col("__top")).alias("__off"))
    offsets = offsets.join(targets, F.col("__s").eqNullSafe(F.col("__src"))).drop("__src")
    inside = before("__src", "__range").orderBy("__key", "doc_id", "size")
    d = d.withColumn("__in", zero(F.sum("size").over(inside)))
    d = d.join(offsets, F.col("__src").eqNullSafe(F.col("__s")) & (F.col("__range") == F.col("__r")))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    left = budget - F.col("epochs") * F.col("source_size") - F.col("__off") - F.col("__in")
    d = (d.withColumn("epochs", whole)
          .withColumn("part", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left)))
          .withColumn("taken", F.col("epochs") * F.col("size") + F.col("part")))
    return d.drop("__key", "__src", "__range", "__hi", "__in", "__s", "__r", "__off")


def mixed_rows(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of the mix: each document once per repeat, also one without
    words (a source of such documents only has no repeats). The one document
    per source at which the budget ends keeps its first ``part`` words there
    (separated by single spaces); ``__cut`` is their number there, else null."""
    full = F.col("part") == F.col("size")
    words = F.filter(F.split(text_col(), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    copies = F.concat(F.array_repeat(F.lit(None).cast("long"), F.col("epochs").cast("int")),
                      F.when((F.col("size") == 0) | (F.col("part") == 0), F.array().cast("array<bigint>"))
                      .when(full, F.array(F.lit(None).cast("long"))).otherwise(F.array("part")))
    out = mixed.where((F.col("taken") > 0) | (F.col("epochs") > 0)).withColumn("__cut", F.explode(copies))
    cut = F.col("__cut").isNotNull()
    out = out.withColumn("text", F.when(cut, F.array_join(F.slice(words, 1, F.greatest(F.lit(1), F.coalesce("__cut", F.lit(1))).cast("int")), " "))
                         .otherwise(F.col("text")))
    return out.select(*columns)


def op5_source_mix(spark, sf_dir: str) -> DataFrame:
    """Words that the 3 : 1 : 2 mix takes from every document."""
    m = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return m.select("doc_id", "size", "source_size", "target", "taken", "epochs", "part")


SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             md5('mix-1' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS rn FROM s),
w AS (SELECT *, [3, 1, 2][((rn - 1) % 3 + 1)::INT] AS w, 2.0::DOUBLE * source_size AS cap FROM r),
o AS (SELECT *, row_number() OVER (ORDER BY cap / w, rn) AS pos,
        (sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce(sum(cap) OVER (ORDER BY cap / w, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
        sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest FROM w),
l AS (SELECT min_by(lft / rest, pos) AS level FROM o WHERE lft / rest <= cap / w),
t AS (SELECT source, source_size, least(cap, w * level) AS target FROM o, l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS b,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ex
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, (CASE WHEN source_size > 0 THEN b // source_size ELSE 0 END)::BIGINT AS epochs FROM p),
f AS (SELECT *, greatest(0, least(size, b - epochs * source_size - ex))::BIGINT AS part FROM e)
SELECT doc_id, size, source_size, target, (epochs * size + part)::BIGINT AS taken, epochs, part FROM f
"""
