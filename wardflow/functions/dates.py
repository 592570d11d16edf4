"""Multi-format date parsing and day arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardflow.functions.text import col_

# The accepted input formats in the order they are tried (the
# first that parses wins), as strptime patterns.
DATE_FORMATS = ["%Y-%m-%d", "%m/%d/%Y", "%d-%m-%Y", "%Y%m%d", "%m-%d-%Y", "%d/%m/%Y", "%Y/%m/%d"]
# Same list as Spark datetime patterns (one-letter fields accept 1 or 2 digits).
SPARK_DATE_FORMATS = ["yyyy-M-d", "M/d/yyyy", "d-M-yyyy", "yyyyMMdd", "M-d-yyyy", "d/M/yyyy", "yyyy/M/d"]
# Shape of every text that the pattern can read (or more): a failed attempt costs far more than this test.
SHAPES = {
    "yyyy-M-d": "^[+-]?[0-9]{4,}-[+-]?[0-9]+-[+-]?[0-9]+$", "yyyy/M/d": "^[+-]?[0-9]{4,}/[+-]?[0-9]+/[+-]?[0-9]+$",
    "d-M-yyyy": "^[+-]?[0-9]+-[+-]?[0-9]+-[+-]?[0-9]{4,}$", "M-d-yyyy": "^[+-]?[0-9]+-[+-]?[0-9]+-[+-]?[0-9]{4,}$",
    "M/d/yyyy": "^[+-]?[0-9]+/[+-]?[0-9]+/[+-]?[0-9]{4,}$", "d/M/yyyy": "^[+-]?[0-9]+/[+-]?[0-9]+/[+-]?[0-9]{4,}$",
    "yyyyMMdd": "^[+-]?[0-9]{8,}$",
    "MMMM d, yyyy": ", ", "MMM d, yyyy": ", ", "d MMMM yyyy": " ", "d MMM yyyy": " ",
}
# Free-form fallbacks after the list: ISO text with a time (cast), then
# month names, which a timestamp cast does not read.
SPARK_FREEFORM_FORMATS = ["MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy"]
# Texts meaning "no date" (compared upper-cased).
DATE_SENTINELS = ["INVALID_DATE", "NULL", "NONE"]

REFERENCE_DAY = "2014-01-01"


def is_date_sentinel(c: Column | str) -> Column:
    """Null, empty, or one of the sentinel words (case-insensitive)."""
    c = col_(c)
    return c.isNull() | (c == "") | F.upper(c).isin(*DATE_SENTINELS)


def _attempt(c: Column, fmt: str) -> Column:
    return F.when(c.rlike(SHAPES[fmt]), F.try_to_timestamp(c, F.lit(fmt)))


def parse_date(c: Column | str) -> Column:
    """Text -> timestamp: sentinels -> null; formats in order; free-form."""
    c = col_(c)
    attempts = [_attempt(c, fmt) for fmt in SPARK_DATE_FORMATS]
    attempts.append(F.try_to_timestamp(F.trim(c)))  # cast rules: ISO date / date-time
    attempts += [_attempt(F.trim(c), fmt) for fmt in SPARK_FREEFORM_FORMATS]
    return F.when(is_date_sentinel(c), F.lit(None).cast("timestamp")).otherwise(F.coalesce(*attempts))


def days_since(c: Column | str, reference: str = REFERENCE_DAY) -> Column:
    """Whole days from ``reference`` (floor), for dates or timestamps."""
    return F.datediff(F.to_date(col_(c)), F.lit(reference).cast("date"))


def floor_days_between(later: Column | str, earlier: Column | str) -> Column:
    """floor((later - earlier) / 1 day) for timestamps (time of day counts)."""
    secs = F.unix_seconds(col_(later).cast("timestamp")) - F.unix_seconds(col_(earlier).cast("timestamp"))
    return F.floor(secs / F.lit(86400)).cast("long")
