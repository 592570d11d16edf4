"""Exact k-th values by narrowing histograms: no sort and no shuffle of rows.

Every pass counts, for each value range still in question, how many rows fall
into each of :data:`BINS` equal bins and the least and largest value of each
bin (a map-side combine to a few rows). The bin that holds the wanted rank is
the next range; a bin with one value, or a rank at a bin's edge, ends the search.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.session import materialize

BINS = 1024
_INF = float("inf")


def kth_values(df: DataFrame, ranks: Mapping[str, Callable[[int], Sequence[int]]]) -> dict[str, tuple[int, dict[int, tuple[float, int]]]]:
    """column -> (n, {rank: (value, rows with a smaller value)}).

    ``ranks`` gives, for a column's number of non-null values, the wanted 0-based
    ranks (those outside 0..n-1 are left out). Values are doubles; -inf comes
    first, inf and then NaN last. ``df`` is read once a pass (a handful of
    passes), so its columns should be stored."""
    x = {c: F.col(f"`{c}`").cast("double") for c in ranks}
    finite = {c: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < _INF) for c, v in x.items()}
    names = list(ranks)
    first = df.agg(*[e.alias(f"{k}{i}") for i, c in enumerate(names) for k, e in (
        ("n", F.count(x[c])), ("low", F.count_if(x[c] == -_INF)), ("nan", F.count_if(F.isnan(x[c]))), ("high", F.count_if(x[c] == _INF)),
        ("min", F.min(F.when(finite[c], x[c]))), ("max", F.max(F.when(finite[c], x[c]))))]).first().asDict()
    found: dict[str, tuple[int, dict]] = {}
    search: dict[tuple[str, float, float, int], list[int]] = {}  # (column, lo, hi, rows below lo) -> ranks
    for i, c in enumerate(names):
        n, low, nan, high = (first[f"{k}{i}"] for k in ("n", "low", "nan", "high"))
        done: dict[int, tuple[float, int]] = {}
        found[c] = (n, done)
        for k in sorted({k for k in ranks[c](n) if 0 <= k < n}):
            if k < low:
                done[k] = (-_INF, 0)
            elif k >= n - nan:
                done[k] = (float("nan"), n - nan)
            elif k >= n - nan - high:
                done[k] = (_INF, n - nan - high)
            else:
                search.setdefault((c, first[f"min{i}"], first[f"max{i}"], low), []).append(k)
    while search:
        for (c, lo, hi, below), ks in list(search.items()):
            if lo == hi:
                found[c][1].update((k, (lo, below)) for k in ks)
                del search[c, lo, hi, below]
        if not search:
            break
        ranges = list(search)
        tags = []
        for i, (c, lo, hi, _) in enumerate(ranges):
            v = x[c]
            # In halves where the difference exceeds the largest double.
            place = ((v - lo) / (hi - lo) if hi - lo < _INF else (v / 2 - lo / 2) / (hi / 2 - lo / 2)) * BINS
            inside = finite[c] & (v >= lo) & (v <= hi)
            tags.append(F.when(inside, F.struct(F.lit(i).alias("r"), F.least(F.lit(BINS - 1), F.floor(place)).cast("int").alias("b"), v.alias("v"))))
        bins: dict[int, list] = {}
        for r in (df.select(F.explode(F.filter(F.array(*tags), lambda t: t.isNotNull())).alias("t")).groupBy("t.r", "t.b")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("t.v").alias("lo"), F.max("t.v").alias("hi")).collect()):
            bins.setdefault(r.r, []).append((r.b, r.n, r.lo, r.hi))
        narrower: dict[tuple[str, float, float, int], list[int]] = {}
        for i, (c, lo, hi, below) in enumerate(ranges):
            for k in search[c, lo, hi, below]:
                under = below
                for _, n, least, most in sorted(bins[i]):
                    if k < under + n:
                        if k == under or least == most:
                            found[c][1][k] = (least, under)
                        else:
                            narrower.setdefault((c, least, most, under), []).append(k)
                        break
                    under += n
        search = narrower
    return found


def quantiles(df: DataFrame, specs: Mapping[str, tuple[str, float]]) -> dict[str, float | None]:
    """name -> quantile of (column, q) with linear interpolation, None without values."""
    columns = sorted({c for c, _ in specs.values()})
    wanted = {c: [q for d, q in specs.values() if d == c] for c in columns}

    def both(n: int, qs: Sequence[float]) -> list[int]:
        return [k for q in qs for k in (int((n - 1) * q), min(n - 1, int((n - 1) * q) + 1))]

    stored = materialize(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]), "values")
    found = kth_values(stored, {c: (lambda n, qs=wanted[c]: both(n, qs)) for c in columns})
    out: dict[str, float | None] = {}
    for name, (c, q) in specs.items():
        n, at = found[c]
        if not n:
            out[name] = None
            continue
        h = (n - 1) * q
        lo = int(h)
        a = at[lo][0]
        out[name] = a if h == lo else a + (at[min(n - 1, lo + 1)][0] - a) * (h - lo)
    return out


# ------------------------------------------------------ parts by hash order
def hash_parts(df: DataFrame, label: str, key: str, seed: int, ends: Callable[[int], Sequence[int]], out: str = "_part") -> DataFrame:
    """Add ``out``: within every class (value of ``label``; a bounded number of
    them), rows are ordered by a seeded hash of ``key`` and cut after ``ends(rows of
    the class)`` rows; the column counts the cuts before a row. Parts have exactly these
    sizes where keys are unique (rows of equal key stay together).

    The cut is a hash threshold found by :func:`kth_values` on 53 bits of the
    hash, and exact on the whole hash and key among the rows of that value; adding
    the column shuffles nothing."""
    h = F.xxhash64(F.col(key), F.lit(seed))
    short = F.shiftright(h, 11).cast("double")
    stored = materialize(df.select(F.col(label).alias("c"), h.alias("h"), F.col(key).alias("k"), short.alias("d")), "hashes")
    classes = [r.c for r in stored.select("c").distinct().collect()]
    wide = stored.select(*[F.when(F.col("c").eqNullSafe(F.lit(c)), F.col("d")).alias(str(i)) for i, c in enumerate(classes)])
    found = kth_values(wide, {str(i): (lambda n: [e - 1 for e in ends(n)]) for i in range(len(classes))})
    near = {(i, v) for i in range(len(classes)) for v, _ in found[str(i)][1].values()}
    edge = None
    for i, v in near:
        here = F.col("c").eqNullSafe(F.lit(classes[i])) & (F.col("d") == v)
        edge = here if edge is None else edge | here
    rows = [] if edge is None else stored.where(edge).groupBy("c", "d", "h", "k").count().collect()  # rows of equal 53 bits
    part: Column = F.lit(None).cast("int")
    for i, c in enumerate(classes):
        n, at = found[str(i)]
        cuts = F.lit(0)
        for e in ends(n):
            if e <= 0:
                cuts = cuts + 1
            elif e < n:
                value, below = at[e - 1]
                for r in sorted((r for r in rows if r.c == c and r.d == value), key=lambda r: (r.h, r.k)):
                    below += r["count"]
                    if below >= e:
                        break
                cuts = cuts + ((h > r.h) | ((h == r.h) & (F.col(key) > F.lit(r.k)))).cast("int")
        part = F.when(F.col(label).eqNullSafe(F.lit(c)), cuts).otherwise(part)
    return df.withColumn(out, part)
