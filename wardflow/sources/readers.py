"""Readers: driver tables, raw admission files (CSV / JSON), schema checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Explicit schema of the raw admission file (documented input dictionary).
# Dates stay text: parsing them is a cleaning step with its own rules.
RAW_ADMISSION_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("age", T.DoubleType()),
    T.StructField("gender", T.StringType()),
    T.StructField("admission_date", T.StringType()),
    T.StructField("discharge_date", T.StringType()),
    T.StructField("length_of_stay", T.DoubleType()),
    T.StructField("emergency_admission", T.IntegerType()),
    T.StructField("diagnosis_codes", T.StringType()),
    T.StructField("previous_admissions", T.IntegerType()),
    T.StructField("insurance_type", T.StringType()),
    T.StructField("readmission_30_day", T.IntegerType()),
])

# Columns the interactive tool insists on before it accepts a file.
REQUIRED_COLUMNS = ["patient_id", "age", "gender", "length_of_stay", "emergency_admission",
                    "diagnosis_codes", "previous_admissions", "readmission_30_day"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet); projections and filters push into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def detect_encoding(spark: SparkSession, path: str) -> str:
    """'UTF-8' if every file under ``path`` is valid UTF-8, else 'ISO-8859-1'.

    Spark's CSV reader does not fail on bad bytes, so the utf-8 -> latin-1
    fallback is decided up front with one distributed, splittable pass: the
    text source keeps each line's raw bytes, ``is_valid_utf8`` checks them.
    """
    lines = spark.read.text(path)
    bad = lines.select(F.count_if(~F.is_valid_utf8(F.col("value"))).alias("bad")).first()
    return "UTF-8" if not bad or not bad["bad"] else "ISO-8859-1"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = RAW_ADMISSION_SCHEMA,
             encoding: str | None = None, infer: bool = False, allow_missing: bool = False) -> DataFrame:
    """CSV source with header; explicit schema by default, inference on request.

    Columns of the schema are found by their header names, whatever their
    order, and cast; a missing one raises ValueError, or is left out with
    ``allow_missing``. Other columns of the file follow as text.

    ``encoding=None`` runs :func:`detect_encoding` (the utf-8 then latin-1
    fallback); empty fields read as null, 'NaN' as a missing number.
    """
    enc = encoding or detect_encoding(spark, path)
    reader = (spark.read.option("header", True).option("encoding", enc)
              .option("nullValue", "").option("nanValue", "NaN").option("mode", "PERMISSIVE")
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if infer or schema is None:
        return reader.option("inferSchema", True).csv(path)
    text = reader.csv(path)
    missing = [f.name for f in schema if f.name not in text.columns]
    if missing and not allow_missing:
        raise ValueError(f"columns missing in {path}: {', '.join(missing)}")
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema if f.name not in missing]
    known = set(schema.fieldNames())
    return text.select(*typed, *[f"`{c}`" for c in text.columns if c not in known])


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = RAW_ADMISSION_SCHEMA,
              multi_line: bool = True) -> DataFrame:
    """JSON source: files holding an array of records (``multi_line``), or
    JSON lines (one record per line, splittable) with ``multi_line=False``.
    Files in sub-folders are read too, without columns for the folders."""
    reader = spark.read.option("multiLine", multi_line).option("recursiveFileLookup", True)
    return reader.schema(schema).json(path) if schema is not None else reader.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


_READERS = {"csv": read_csv, "json": read_json, "parquet": read_parquet}


def load_raw_data(spark: SparkSession, path: str, file_type: str = "csv", **options) -> DataFrame:
    """Dispatch on the file type name; an unknown type raises ``ValueError``."""
    kind = file_type.lower()
    if kind not in _READERS:
        raise ValueError(f"Unsupported file type: {file_type}")
    return _READERS[kind](spark, path, **options)


def check_required_columns(df: DataFrame, required: list[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Raise with the list of missing columns, else return ``df`` unchanged."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {', '.join(missing)}")
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN -> NULL on ingest: Spark orders NaN above every number."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
