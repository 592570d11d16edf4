"""Exclusive running sums over an ordered value, without a global sort task.

Input: a table already aggregated to one row per (group, value) with count
columns. Output: each row plus, per count column, the sum over rows of the
same group with a strictly smaller value, and the group total.

The aggregated table is stored once, so its size is known and its source is
read once. Up to :data:`RANGE_ROWS` rows make one range, ordered per group;
a larger table is cut into as many ranges of neighbouring values as its size
asks for, and a range's running sums are shifted by the totals of the ranges
below it. No task orders more than about one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.session import materialize

RANGE_ROWS = 200_000


def running_counts(g: DataFrame, value: str, counts: Sequence[str], by: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """``*by, value, *counts, *carry``, ``<count>_below`` and ``total_<count>``.
    Equal values of a group must be one row already; nulls order first."""
    by, carry = list(by), list(carry)
    g = materialize(g.select(*by, value, *counts, *carry), "ranked")
    ranges = -(-g.count() // RANGE_ROWS)
    before = (Window.unboundedPreceding, -1)
    if ranges <= 1:
        group = Window.partitionBy(*(by or [F.lit(0)]))  # the whole table is one bounded range
        return g.select("*", *[F.coalesce(F.sum(c).over(group.orderBy(value).rowsBetween(*before)), F.lit(0)).alias(f"{c}_below") for c in counts],
                        *[F.sum(c).over(group).alias(f"total_{c}") for c in counts])
    # Stored with the number of its range, so that every later read agrees on it.
    g = materialize(g.repartitionByRange(ranges, value).withColumn("_range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy(*by, "_range").orderBy(value).rowsBetween(*before)
    totals = g.groupBy(*by, "_range").agg(*[F.sum(c).alias(c) for c in counts])  # a row per group and range
    group = Window.partitionBy(*(by or [F.lit(0)]))
    totals = totals.select(*by, "_range", *[F.coalesce(F.sum(c).over(group.orderBy("_range").rowsBetween(*before)), F.lit(0)).alias(f"_off_{c}") for c in counts],
                           *[F.sum(c).over(group).alias(f"total_{c}") for c in counts])
    g = g.withColumns({f"_in_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in counts})
    on = F.lit(True)
    for c in [*by, "_range"]:
        on = on & g[c].eqNullSafe(totals[c])
    return g.join(totals, on).select(*[g[c] for c in by], value, *counts, *carry,
                                     *[(F.col(f"_off_{c}") + F.col(f"_in_{c}")).alias(f"{c}_below") for c in counts],
                                     *[f"total_{c}" for c in counts])
