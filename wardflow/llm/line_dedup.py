"""Line dedup: windows of three consecutive lines that occur before are removed.

Every window is reduced to a 128-bit hash of its three line hashes. The first
place (smallest doc_id, then position) of each hash stays; all later places
lose the lines they cover. Windows overlap, so covered positions are merged:
a line goes if any later window covers it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import table, text_col
from wardflow.session import materialize

SPAN = 3


def _lines() -> Column:
    """The lines without surrounding blanks and tabs."""
    return F.transform(F.split(text_col(), "\n"), lambda x: F.regexp_replace(x, r"^[ \t\r]+|[ \t\r]+$", ""))


def _windows(span: int) -> Column:
    """128-bit hashes of every window, position 0 first; empty when there are fewer lines."""
    at = lambda a, i, j: F.get(a, i + F.lit(j))
    n = F.size("__l") - span + 1
    one = lambda i: F.struct(i.alias("pos"), *[F.xxhash64(F.lit(s), *[at(F.col(c), i, j) for j in range(span)]).alias(c)
                                               for s, c in ((11, "__a"), (29, "__b"))])
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), one)).otherwise(F.array().cast(
        "array<struct<pos:int,__a:bigint,__b:bigint>>"))


def line_windows(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, __t, pos, a, b) of every window; ``__t`` tells rows with one
    id but different texts apart."""
    d = docs.select("doc_id", F.xxhash64(text_col()).alias("__t"), _lines().alias("__l"))
    d = d.select("doc_id", "__t", "__l", F.transform("__l", lambda x: F.xxhash64(x)).alias("__a"),
                 F.transform("__l", lambda x: F.xxhash64(F.lit(7), x)).alias("__b"))
    return (d.select("doc_id", "__t", F.explode(_windows(span)).alias("__w"))
             .select("doc_id", "__t", "__w.pos", F.col("__w.__a").alias("a"), F.col("__w.__b").alias("b")))


def drop_repeated_lines(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """``docs`` with ``text`` replaced by the kept lines, and ``n_lines``,
    ``n_removed``.

    Lines compare without surrounding blanks, tabs and carriage returns; blank
    lines count as lines. A text of fewer than ``span`` lines has no window and
    stays as it is; null text stays null (no line). Rows with one id and one
    text are the same place and get the same result; a null id comes first.
    Existing columns ``n_lines`` and ``n_removed`` are replaced."""
    w = line_windows(docs, span)
    first = w.groupBy("a", "b").agg(F.min(F.struct("doc_id", "__t", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
    # Stored, so that both sides of the join are dealt anew and a very common
    # window (many places, one row here) can be split by the skew-join rule.
    first = materialize(first.where("n > 1").select("a", "b", "first"), "llm-windows")
    later = (w.join(first, ["a", "b"]).where(~F.struct("doc_id", "__t", "pos").eqNullSafe(F.col("first")))
              .groupBy(F.col("doc_id").alias("__id"), "__t").agg(F.collect_set("pos").alias("__pos")))
    later = later.withColumnRenamed("__t", "__u")
    d = docs.drop("n_lines", "n_removed").withColumn("__t", F.xxhash64(text_col()))
    d = d.join(later, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__t") == F.col("__u")), "left")
    # Merge: positions pos .. pos + span - 1 of every later window.
    gone = F.array_distinct(F.flatten(F.transform(F.col("__pos"), lambda p: F.sequence(p, p + F.lit(span - 1)))))
    d = d.withColumn("__gone", F.when(F.col("__pos").isNotNull(), F.map_from_entries(F.transform(gone, lambda x: F.struct(x, F.lit(True))))))
    lines = F.split("text", "\n")
    kept = F.array_join(F.transform(F.filter(F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                                             lambda s: ~F.coalesce(F.map_contains_key("__gone", s["i"]), F.lit(False))),
                                    lambda s: s["x"]), "\n")
    return (d.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"))
             .withColumn("n_removed", F.coalesce(F.size("__gone"), F.lit(0)).cast("long"))
             .withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept))
             .drop("__t", "__id", "__u", "__pos", "__gone"))


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Lines, removed lines and the md5 of the kept text of every document."""
    d = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_removed", F.length(text_col()).cast("long").alias("kept_chars"),
                    F.md5(text_col()).alias("kept_md5"))


SQL = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS raw,
             list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^[ \t\r]+|[ \t\r]+$', '', 'g')) AS ls FROM documents),
w AS (SELECT doc_id, pos, ls[pos + 1] || chr(10) || ls[pos + 2] || chr(10) || ls[pos + 3] AS win
      FROM (SELECT doc_id, ls, unnest(range(0, greatest(len(ls) - 2, 0))) AS pos FROM l)),
x AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id NULLS FIRST, pos) AS k FROM w),
g AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS p FROM x WHERE k > 1) GROUP BY doc_id),
k AS (SELECT l.doc_id, coalesce(len(raw), 0) AS n_lines, coalesce(len(gone), 0) AS n_removed,
        CASE WHEN gone IS NULL THEN coalesce(text, '') ELSE coalesce(array_to_string(list_transform(
          list_filter(range(0, len(raw)), lambda i: NOT list_contains(gone, i)), lambda i: raw[i + 1]), chr(10)), '') END AS kept
      FROM l LEFT JOIN g USING (doc_id))
SELECT doc_id, n_lines::BIGINT AS n_lines, n_removed::BIGINT AS n_removed, length(kept)::BIGINT AS kept_chars, md5(kept) AS kept_md5 FROM k
"""
