"""Column -> Column text standardisation (all JVM-side, no Python UDF)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw gender spelling -> standard value (null and anything not
# listed -> 'Unknown'). Keys are case-sensitive, as in the source mapping.
GENDER_MAPPING = {
    "M": "Male", "MALE": "Male", "Male": "Male", "m": "Male",
    "F": "Female", "FEMALE": "Female", "Female": "Female", "f": "Female", "female": "Female",
    "": "Unknown", "Unknown": "Unknown", "UNK": "Unknown", "U": "Unknown",
}

# Insurance class -> keywords; tested in this order as
# substrings of the upper-cased, trimmed value; no hit -> 'Other'.
INSURANCE_KEYWORDS = {
    "Medicare": ["MEDICARE", "medicare", "Medicare", "MCR"],
    "Medicaid": ["MEDICAID", "medicaid", "Medicaid", "MCD"],
    "Private": ["PRIVATE", "private", "Private", "Commercial", "COMMERCIAL"],
    "Self-Pay": ["SELF", "self", "Self", "CASH", "cash", "Cash", "Uninsured"],
}

GENDER_VALUES = ["Female", "Male", "Unknown"]
INSURANCE_VALUES = ["Medicaid", "Medicare", "Other", "Private", "Self-Pay", "Unknown"]


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c: Column | str) -> Column:
    """Python ``str.title`` semantics: a letter is upper-cased when the
    character before it is not a cased letter, every other letter is
    lower-cased. (``initcap`` only restarts words after white space:
    'self-pay' -> 'Self-pay', while the expected form is 'Self-Pay'.)
    A character is cased when its upper and lower forms differ."""
    c = col_(c)
    chars = F.split(c, "")

    def step(x, i):
        prev = F.element_at(chars, i)
        return F.when((i == 0) | (F.upper(prev) == F.lower(prev)), F.upper(x)).otherwise(F.lower(x))

    # Strings that are already one lower/upper-case-insensitive word skip the per-character pass.
    simple = c.rlike(r"^[A-Za-z]*$")
    fast = F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))
    return F.when(simple, fast).otherwise(F.array_join(F.transform(chars, step), ""))


def standardize_gender(c: Column | str) -> Column:
    """Dictionary lookup with 'Unknown' as default (null -> 'Unknown')."""
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(GENDER_MAPPING.items())])
    return F.coalesce(F.try_element_at(mapping, col_(c)), F.lit("Unknown"))


def standardize_insurance(c: Column | str) -> Column:
    """Keyword classifier: null/'' -> Unknown, first class with a keyword
    contained in ``upper(trim(value))`` wins, else Other."""
    c = col_(c)
    up = F.upper(F.trim(c))
    expr = F.when(c.isNull() | (c == ""), F.lit("Unknown"))
    for label, words in INSURANCE_KEYWORDS.items():
        keys = sorted({w.upper() for w in words})
        hit = None
        for k in keys:
            cond = up.contains(k)
            hit = cond if hit is None else (hit | cond)
        expr = expr.when(hit, F.lit(label))
    return expr.otherwise(F.lit("Other"))


def strip_non_word(c: Column | str) -> Column:
    r"""Remove every character that is neither a word character nor space."""
    return F.regexp_replace(col_(c), r"(?U)[^\w\s]", "")
