"""Per-entity ordered sequences that stay balanced when one entity is huge.

``Window.partitionBy(patient)`` puts every row of a patient in one task. A
patient (or a null / placeholder id) can hold a large share of all rows, so
the operators here never partition by the entity alone on the row level:

1. rows are windowed per ``(entity, chunk)`` where ``chunk`` is a coarse,
   order-preserving key (the calendar day of the ordering timestamp), which
   splits a hot entity over all of its days; rows without a time, or at
   midnight of a placeholder day, are ordered by their tie alone, so their
   chunk is split further into blocks of neighbouring tie values;
2. one small summary row per ``(entity, chunk)`` (count, first/last time,
   partial sums) is windowed per entity to produce offsets and neighbours;
   its size per entity is bounded by the number of distinct days and blocks;
3. the summary is joined back on ``(entity, chunk)``. The row side is already
   hash-partitioned on exactly those keys by step 1, so only the summary moves
   (or is broadcast by AQE when it is measured small).

Result: one shuffle of the rows, exact ``row_number`` / ``lag`` / ``lead`` /
per-entity totals in the order ``(ts asc nulls last, tie asc)``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Chunk used for rows whose ordering time is null: sorts after every real day.
_NULL_CHUNK = "9999-12-31"
# Days that systems write where the date is not known: a chunk of such a day can be as hot as the null chunk.
PLACEHOLDER_DAYS = ("0001-01-01", "1900-01-01", "1970-01-01")
# A block holds 2 ** 16 neighbouring tie values.
BLOCK_BITS = 16


def _blocks(df: DataFrame, ts: str, tie: str, bits: int) -> tuple[Column, Column]:
    """(0 or 1, block): rows of a day that are ordered by their tie alone get the
    leading part of the tie as their block; on a placeholder day the rows after
    midnight follow them as one block."""
    zero = F.lit(0).cast("long")
    if not isinstance(df.schema[tie].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.lit(0), zero
    t = F.col(ts)
    day = F.to_date(t)
    placeholder = day.isin(*[F.lit(d).cast("date") for d in PLACEHOLDER_DAYS])
    late = placeholder & (t > day.cast(df.schema[ts].dataType))
    # Rows without a tie come last.
    block = F.coalesce(F.shiftright(F.col(tie).cast("long"), bits), F.lit(2 ** 63 - 1))
    return F.coalesce(late, F.lit(False)).cast("int"), F.when(t.isNull() | (placeholder & ~late), block).otherwise(zero)


def entity_sequence(df: DataFrame, entity: str, ts: str, tie: str,
                    seq_col: str = "seq", prev_col: str | None = "prev_ts",
                    next_col: str | None = "next_ts",
                    totals: Mapping[str, Column] | None = None,
                    chunk: Column | None = None, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Add position, neighbour times and per-entity totals to every row.

    ``seq_col``: 1-based position of the row within its entity, ordered by
    ``ts`` (nulls last) then ``tie``. ``prev_col`` / ``next_col``: ``ts`` of
    the previous / next row of the same entity (null at the ends).
    ``totals``: name -> numeric Column; each becomes the sum of that column
    over the whole entity (nulls ignored), e.g. counts and sums for means.
    Rows with a null ``entity`` are kept with null outputs. A custom
    ``chunk`` must be non-null and non-decreasing in the row order.

    Undated rows of an entity are cut into blocks of ``2 ** block_bits`` tie
    values where ``tie`` is an integer column; with unique ties no task holds
    more of them than that. Other types of ``tie`` are not cut: there, the
    undated rows of one entity stay together.
    """
    totals = dict(totals or {})
    if chunk is None:  # calendar day; null times go to a chunk after every day
        chunk = F.coalesce(F.to_date(F.col(ts)), F.lit(_NULL_CHUNK).cast("date"))
        late, block = _blocks(df, ts, tie, block_bits)
    else:
        late, block = F.lit(0), F.lit(0).cast("long")
    base = df.withColumns({"_chunk": chunk, "_late": late, "_block": block})
    part = [entity, "_chunk", "_late", "_block"]
    for name, expr in totals.items():
        base = base.withColumn(f"_t_{name}", expr)

    keyed = base.filter(F.col(entity).isNotNull())
    w_local = Window.partitionBy(*part).orderBy(
        F.col(ts).asc_nulls_last(), F.col(tie).asc_nulls_last())
    rows = (keyed
            .withColumn("_lrank", F.row_number().over(w_local))
            .withColumn("_lprev", F.lag(ts).over(w_local))
            .withColumn("_lnext", F.lead(ts).over(w_local)))

    aggs = [F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_last")]
    aggs += [F.sum(f"_t_{name}").alias(f"_s_{name}") for name in totals]
    summary = rows.groupBy(*part).agg(*aggs)
    w_chunks = Window.partitionBy(entity).orderBy("_chunk", "_late", "_block")
    w_entity = Window.partitionBy(entity)
    summary = summary.select(
        *part,
        F.coalesce(F.sum("_n").over(w_chunks.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"),
        F.lag("_last").over(w_chunks).alias("_prev_last"),
        F.lead("_first").over(w_chunks).alias("_next_first"),
        *[F.sum(f"_s_{name}").over(w_entity).alias(f"_tot_{name}") for name in totals])

    joined = rows.join(summary, on=part, how="inner")
    out_cols = [F.col(c) for c in df.columns]
    out_cols.append((F.col("_offset") + F.col("_lrank")).cast("long").alias(seq_col))
    if prev_col:
        out_cols.append(F.when(F.col("_lrank") > 1, F.col("_lprev"))
                        .otherwise(F.col("_prev_last")).alias(prev_col))
    if next_col:
        # A null-time row has a null _lnext only when it is the last of its chunk.
        out_cols.append(F.coalesce(F.col("_lnext"), F.col("_next_first")).alias(next_col))
    out_cols += [F.col(f"_tot_{name}").alias(name) for name in totals]
    result = joined.select(*out_cols)

    orphans = base.filter(F.col(entity).isNull()).select(
        *[F.col(c) for c in df.columns],
        F.lit(None).cast("long").alias(seq_col),
        *([F.lit(None).cast(df.schema[ts].dataType).alias(prev_col)] if prev_col else []),
        *([F.lit(None).cast(df.schema[ts].dataType).alias(next_col)] if next_col else []),
        *[F.lit(None).cast(result.schema[name].dataType).alias(name) for name in totals])
    return result.unionByName(orphans)
