"""Derive the raw (dirty) admission table from the driver's tables.

No hospital data ships with the project, so an admission table with the raw
schema of the documented input is derived, deterministically, from
``orders`` + ``lineitem``. Every dirty value follows a fixed rule on the keys,
so Spark and an SQL engine can compute the same table:

* one admission per order, ``admission_key = o_orderkey``;
* ``patient_id = 'PID_' + o_custkey``, zero-padded to at least six digits;
* ``admission_date``: the order date rendered as text in one of the
  documented formats (chosen by the key), or a null sentinel;
* ``length_of_stay = avg(l_quantity) / 3`` per order (null without lines);
* ``diagnosis_codes``: the distinct code tokens picked by the order's lines,
  sorted, joined by ``;`` ``,`` or a vertical bar;
* ``previous_admissions``: earlier admissions of the patient;
* ``readmission_30_day``: the patient's next admission is <= 30 days later.

The per-patient ordering uses :func:`entity_sequence`, which stays balanced
when one patient holds a large share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.operators.sequence import entity_sequence
from wardflow.sources.readers import read_table

# Raw spellings used to dirty the derived table (variants from
# the input dictionary, plus blank and null).
GENDER_VARIANTS = ["M", "Male", "MALE", "m", "F", "Female", "FEMALE", "f", "female",
                   "", "U", " male ", None]
INSURANCE_VARIANTS = ["Medicare", "MEDICARE", "medicare", "Private", "Commercial",
                      "Medicaid", "Self-Pay", "Unknown", "", "MCR", "cash", None,
                      " mcd ", "Blue Cross", "self pay", "uninsured"]
DATE_SENTINELS = ["INVALID_DATE", "", "NULL", "none", None]
CODE_DELIMITERS = [";", ",", "|"]
# Diagnosis tokens a line can contribute (mapped codes of all
# three systems, loose local spellings, unmapped codes, blanks).
CODE_TOKENS = ["250.00", "401.9", "E11.9", "I10", "I50.9", "DM2", "HTN", "HF",
               "DIABETES", "KIDNEY", "HEART", "250.01", "COPD", "Z99", "H", "4",
               "MISC", ".5", "C", "585.9", "272.4", "F32.9", "n18.3", " e78.5 ",
               "mdd", "496", "J44.1", "chol", "I25.10", "428.0", "585.3", "250.02",
               "311", "V45.81", "R07.9", "786.50", "CAD", "ckd", "E78.5", "I21.9",
               "N18.6", "J45.9", "296.2", "T2DM", "  ", "HBP"]

RAW_COLUMNS = ["admission_key", "patient_id", "age", "gender", "admission_date",
               "length_of_stay", "emergency_admission", "diagnosis_codes",
               "previous_admissions", "insurance_type", "readmission_30_day"]


def padded_id(key: Column) -> Column:
    """``PID_`` and the key with at least six digits (longer keys stay whole)."""
    text = key.cast("string")
    return F.concat(F.lit("PID_"), F.repeat(F.lit("0"), F.greatest(F.lit(0), F.lit(6) - F.length(text))), text)


def _pick(values: list, index: Column) -> Column:
    """``values[index]`` for a 0-based integer Column (JVM-side array literal)."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]),
                        (index + 1).cast("int"))


def _date_text(d: Column, key: Column) -> Column:
    """Render date ``d`` in the format selected by ``key % 12``."""
    k = F.pmod(key, F.lit(12))
    sentinel = _pick(DATE_SENTINELS, F.pmod(F.floor(key / 12), F.lit(len(DATE_SENTINELS))))
    with_time = F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" "),
                         F.lpad(F.pmod(key, F.lit(24)).cast("string"), 2, "0"), F.lit(":00:00"))
    return (F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
            .when(k == 1, F.date_format(d, "MM/dd/yyyy"))
            .when(k == 2, F.date_format(d, "dd-MM-yyyy"))
            .when(k == 3, F.date_format(d, "yyyyMMdd"))
            .when(k == 4, F.date_format(d, "MM-dd-yyyy"))
            .when(k == 5, F.date_format(d, "dd/MM/yyyy"))
            .when(k == 6, F.date_format(d, "yyyy/MM/dd"))
            .when(k == 7, with_time)
            .when(k == 8, sentinel)
            .when(k == 9, F.date_format(d, "MMMM d, yyyy"))
            .when(k == 10, F.date_format(d, "M/d/yyyy"))
            .otherwise(F.date_format(d, "yyyy-MM-dd")))


def admissions(spark: SparkSession, sf_dir: str, columns: Iterable[str] = RAW_COLUMNS) -> DataFrame:
    """Raw admission table (schema: :data:`RAW_COLUMNS`), lazily derived.
    With ``columns`` only these, in this order: the lines are read only for the
    stay and the codes, and the patients' order is computed only for the columns
    that depend on it."""
    columns = list(columns)
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    base = orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("_d"), "o_orderpriority")
    if {"length_of_stay", "diagnosis_codes"} & set(columns):
        base = base.join(_per_order(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey", "_codes")
    if {"previous_admissions", "readmission_30_day"} & set(columns):
        base = entity_sequence(base, entity="o_custkey", ts="_d", tie="o_orderkey",
                               seq_col="_rn", prev_col=None, next_col="_next")
    exprs = _raw_columns()
    return base.select(*[exprs[c].alias(c) for c in columns])


def _per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean quantity / 3 and the set of code tokens, as a bit each and as a sorted array, of every order with lines."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")

    # Partial (map-side) aggregation; the code set per order is a bit per token of
    # the list (46 of them), so no group can grow with the data.
    index = F.pmod(F.col("l_partkey") + F.col("l_linenumber"), F.lit(len(CODE_TOKENS)))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), index.cast("int"))
    per = lines.groupBy("l_orderkey").agg((F.avg("l_quantity") / F.lit(3.0)).alias("_los"), F.bit_or(bit).alias("_bits"))
    per = per.withColumn("_bits", F.coalesce(F.col("_bits"), F.lit(0).cast("long")))
    return per.select("l_orderkey", "_los", "_bits", F.array_compact(F.array(*_tokens(F.col("_bits")))).alias("_codes"))


def _joined_codes(bits: Column, delimiter: Column) -> Column:
    """The tokens of the bits, sorted and joined (null without bits); the rows are shuffled with the bits."""
    return F.when(bits.isNotNull(), F.call_function("concat_ws", delimiter, *_tokens(bits)))


def _tokens(bits: Column) -> list[Column]:
    """Every token in order where its bit is set, else null."""
    in_order = sorted((t, i) for i, t in enumerate(CODE_TOKENS))
    return [F.when(bits.bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(t)) for t, i in in_order]


def _raw_columns() -> dict[str, Column]:
    """Raw column -> its expression over orders, lines per order and the patient's order."""
    key = F.col("o_orderkey")
    cust = F.col("o_custkey")
    age = (F.when(F.pmod(key, F.lit(41)) == 7, F.lit(None))
           .when(F.pmod(key, F.lit(199)) == 3, F.lit(150.0))
           .when(F.pmod(key, F.lit(211)) == 5, F.lit(-2.0))
           .otherwise(F.lit(18) + F.pmod(cust * 37, F.lit(83)))).cast("double")
    codes = (F.when(F.pmod(key, F.lit(23)) == 9, F.lit(""))
             .when(F.pmod(key, F.lit(23)) == 10, F.lit(" ; "))
             .otherwise(_joined_codes(F.col("_bits"), F.when(F.pmod(key, F.lit(3)) == 0, CODE_DELIMITERS[0])
                                      .when(F.pmod(key, F.lit(3)) == 1, CODE_DELIMITERS[1]).otherwise(CODE_DELIMITERS[2]))))
    emergency = (F.when(F.pmod(key, F.lit(31)) == 4, F.lit(None))
                 .when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(1))
                 .otherwise(F.lit(0))).cast("int")
    previous = (F.when(F.pmod(key, F.lit(17)) == 6, F.lit(None))
                .otherwise(F.col("_rn") - 1)).cast("int")
    insurance = (F.when(F.pmod(key, F.lit(13)) == 2, F.lit(None).cast("string"))
                 .otherwise(_pick(INSURANCE_VARIANTS, F.pmod(cust, F.lit(len(INSURANCE_VARIANTS))))))
    readmit = F.coalesce((F.datediff(F.col("_next"), F.col("_d")) <= 30), F.lit(False)).cast("int")

    return {
        "admission_key": key,
        "patient_id": padded_id(cust),
        "age": age,
        "gender": _pick(GENDER_VARIANTS, F.pmod(cust, F.lit(len(GENDER_VARIANTS)))),
        "admission_date": _date_text(F.col("_d"), key),
        "length_of_stay": F.col("_los"),
        "emergency_admission": emergency,
        "diagnosis_codes": codes,
        "previous_admissions": previous,
        "insurance_type": insurance,
        "readmission_30_day": readmit,
    }
