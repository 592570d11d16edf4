"""Registered queries: one per operator id of the inventory.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver tables (via
the admission binding), with a twin SQL text for the oracle check. Outputs
are normalised the same way on both sides: doubles rounded to 6 places,
integers as BIGINT, timestamps as ``yyyy-MM-dd HH:mm:ss`` text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Text dates are wall-clock values: evaluate them in UTC so that
            # day arithmetic never crosses a daylight-saving shift.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return finalize(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def finalize(df: DataFrame) -> DataFrame:
    """Normalise output types so both engines hash the same values."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("long")
        elif isinstance(t, T.BooleanType):
            c = c.cast("long")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def ts_sql(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def out_sql(spec: str, src: str = "", where: str = "", order: str = "") -> str:
    """Final SELECT with the same normalisation as :func:`finalize`.

    ``spec``: space-separated ``name:kind`` or ``name=expr:kind`` items, kind
    i (BIGINT), d (double, rounded), s (text), t (timestamp text), D (date text).
    """
    parts = []
    for seg in spec.split("|"):
        seg = seg.strip()
        if not seg:
            continue
        parts += [seg] if "=" in seg else seg.split()
    items = []
    for part in parts:
        body, kind = part.rsplit(":", 1)
        name, expr = (body.split("=", 1) if "=" in body else (body, body))
        name, expr = name.strip(), expr.strip()
        if kind == "i":
            e = f"CAST({expr} AS BIGINT)"
        elif kind == "d":
            e = f"round(CAST({expr} AS DOUBLE), 6)"
        elif kind == "t":
            e = f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"
        elif kind == "D":
            e = f"strftime({expr}, '%Y-%m-%d')"
        else:
            e = expr
        items.append(f"{e} AS {name}")
    sql = "SELECT " + ", ".join(items)
    if src:
        sql += f" FROM {src}"
    if where:
        sql += f" WHERE {where}"
    if order:
        sql += f" ORDER BY {order}"
    return sql
