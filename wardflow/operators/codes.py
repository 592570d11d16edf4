"""Medical-code translation: mixed ICD-9 / ICD-10 / local codes -> conditions.

Plan shape (no Python UDF, nothing collected):

1. tokenise each code string into an array (split on ``;`` ``,`` or a
   vertical bar, trim, upper-case, drop blanks) and explode it;
2. resolve the *distinct* tokens only: exact equi-join with the 96-row code
   dimension, then for the rest the loose two-way prefix rule as a
   prefix-index equi-join (prefixes of tokens and codes), keeping the first hit in
   dictionary order (``min_by(condition, ord)``);
3. join the token -> condition map back to the exploded tokens (AQE turns
   it into a broadcast when the measured map is small), pivot the seven
   fixed conditions per row key and left-join the flags to the rows.

Per-row flags default to the shuffle-free form (:func:`condition_flags`):
the dictionary has a fixed size, so each token is resolved in place by a
map probe, unmapped ones by probes of the same prefix index. The
relational form above serves the token-level reports and ``method="join"``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.text import col_

# Condition -> code system -> codes, plus a description. The
# order is part of the semantics: the first entry hit by the prefix rule wins.
CONDITION_MAPPINGS = {
    "diabetes": {
        "icd9": ["250.00", "250.01", "250.02", "250.03", "250.1", "250.2", "250.3"],
        "icd10": ["E11.9", "E11.0", "E11.1", "E10.9", "E11.65", "E11.8"],
        "local": ["DM2", "DM1", "DIABETES", "DIAB", "T2DM", "T1DM"],
        "description": "Diabetes Mellitus",
    },
    "hypertension": {
        "icd9": ["401.9", "401.0", "401.1", "402.90", "403.90"],
        "icd10": ["I10", "I11.9", "I12.9", "I13.10", "I15.9"],
        "local": ["HTN", "HYPERTENSION", "HIGH_BP", "HBP"],
        "description": "Hypertension",
    },
    "heart_disease": {
        "icd9": ["428.0", "414.01", "411.1", "410.9", "429.2"],
        "icd10": ["I50.9", "I25.10", "I21.9", "I25.9", "I42.9"],
        "local": ["HF", "CHF", "HEART_FAILURE", "CAD", "MI"],
        "description": "Heart Disease",
    },
    "kidney_disease": {
        "icd9": ["585.9", "585.3", "585.4", "585.5", "585.6"],
        "icd10": ["N18.9", "N18.3", "N18.4", "N18.5", "N18.6"],
        "local": ["KIDNEY", "CKD", "RENAL", "ESRD"],
        "description": "Chronic Kidney Disease",
    },
    "hyperlipidemia": {
        "icd9": ["272.4", "272.0", "272.1", "272.2"],
        "icd10": ["E78.5", "E78.0", "E78.1", "E78.2"],
        "local": ["CHOL", "LIPID", "CHOLESTEROL", "HYPERLIPID"],
        "description": "Hyperlipidemia",
    },
    "copd": {
        "icd9": ["496", "491.21", "492.8", "493.20"],
        "icd10": ["J44.1", "J44.0", "J43.9", "J45.9"],
        "local": ["COPD", "EMPHYSEMA", "BRONCHITIS"],
        "description": "Chronic Obstructive Pulmonary Disease",
    },
    "depression": {
        "icd9": ["296.2", "296.3", "311", "300.4"],
        "icd10": ["F32.9", "F33.9", "F32.0", "F33.0"],
        "local": ["DEPRESSION", "DEPRESSIVE", "MDD"],
        "description": "Depression",
    },
}
SYSTEMS = ["icd9", "icd10", "local"]
CONDITIONS = list(CONDITION_MAPPINGS)
FLAG_COLUMNS = [f"has_{c}" for c in CONDITIONS]
TOKEN_SPLIT = r"[;,|]"


def code_rows() -> list[tuple[int, str, str, str]]:
    """(ord, code, system, condition) in dictionary order."""
    rows, seen = [], {}
    for condition, systems in CONDITION_MAPPINGS.items():
        for system in SYSTEMS:
            for code in systems.get(system, []):
                key = code.upper()
                if key in seen:  # a repeated key keeps its first position
                    rows[seen[key]] = (rows[seen[key]][0], key, system, condition)
                    continue
                seen[key] = len(rows)
                rows.append((len(rows), key, system, condition))
    return rows


def code_dimension(spark: SparkSession) -> DataFrame:
    """K1: the 96-row code dimension (fixed size: safe to broadcast)."""
    return spark.createDataFrame(code_rows(), "ord int, code string, system string, condition string")


def condition_dimension(spark: SparkSession) -> DataFrame:
    rows = [(i, c, m["description"]) for i, (c, m) in enumerate(CONDITION_MAPPINGS.items())]
    return spark.createDataFrame(rows, "cond_ord int, condition string, description string")


def tokenize_codes(c: Column | str) -> Column:
    """K2: array of upper-cased, trimmed, non-blank tokens (null -> null)."""
    parts = F.transform(F.split(col_(c), TOKEN_SPLIT), lambda x: F.upper(F.trim(x)))
    return F.filter(parts, lambda x: x != "")


def prefix_index() -> tuple[dict[str, tuple[int, str]], dict[str, tuple[int, str]]]:
    """K4 as two lookups, text -> (ord, condition) of the first dictionary entry:
    ``stems`` (a token that begins with an entry's stem) and ``heads`` (every
    prefix of every code, the empty one too: a token whose stem begins a code)."""
    stems: dict[str, tuple[int, str]] = {}
    heads: dict[str, tuple[int, str]] = {}
    for n, code, _, condition in code_rows():
        stems.setdefault(code.split(".")[0], (n, condition))
        for i in range(len(code) + 1):
            heads.setdefault(code[:i], (n, condition))
    return stems, heads


def _stem(token: Column) -> Column:
    return F.split_part(token, F.lit("."), F.lit(1))


def resolve_tokens(tokens: DataFrame, token_col: str = "token") -> DataFrame:
    """K3 + K4 on a frame of tokens: distinct token -> condition (unmatched
    tokens are dropped). Tokens without an exact hit are looked up by their
    prefixes of the stems' lengths and by their own stem: equi-joins with the
    prefix index, whose size is fixed by the dictionary."""
    spark = tokens.sparkSession
    dim = F.broadcast(code_dimension(spark))
    distinct = tokens.select(F.col(token_col).alias("token")).distinct()
    exact = distinct.join(dim, distinct.token == dim.code, "inner").select("token", "condition")
    residual = distinct.join(dim.select(F.col("code").alias("token")), "token", "left_anti")
    stems, heads = prefix_index()
    index = spark.createDataFrame([(kind, text, *hit) for kind, table in (("stem", stems), ("head", heads)) for text, hit in table.items()],
                                  "kind string, text string, ord int, condition string")
    probes = [F.struct(F.lit("stem").alias("kind"), F.substring("token", 1, n).alias("text")) for n in sorted({len(x) for x in stems})]
    probes.append(F.struct(F.lit("head").alias("kind"), _stem(F.col("token")).alias("text")))
    loose = (residual.select("token", F.inline(F.array_distinct(F.array(*probes)))).join(F.broadcast(index), ["kind", "text"])
             .groupBy("token").agg(F.min_by("condition", "ord").alias("condition")))
    return exact.unionByName(loose)


def exploded_codes(df: DataFrame, key: str, column: str = "diagnosis_codes") -> DataFrame:
    return df.select(key, F.explode(tokenize_codes(column)).alias("token"))


def condition_pairs(df: DataFrame, key: str, column: str = "diagnosis_codes", distinct: bool = True) -> DataFrame:
    """(key, condition) pairs found in each row's code string (repeats
    removed unless ``distinct=False``)."""
    tokens = exploded_codes(df, key, column)
    mapping = resolve_tokens(tokens)
    pairs = tokens.join(mapping, "token").select(key, "condition")
    return pairs.distinct() if distinct else pairs


def _map(table: dict[str, Column]) -> Column:
    return F.create_map(*[x for k, v in table.items() for x in (F.lit(k), v)])


def token_condition(token: Column) -> Column:
    """Condition of one token without any join: exact hit in the 96-entry map
    literal, else (only then) the first entry among the hits of the prefix index
    (:func:`prefix_index`): one probe per stem length and one for the token's own
    stem, else null."""
    stems, heads = prefix_index()
    hit = lambda h: F.struct(F.lit(h[0]).alias("ord"), F.lit(h[1]).alias("condition"))
    probes = [F.try_element_at(_map({k: hit(h) for k, h in stems.items() if len(k) == n}), F.substring(token, 1, n)) for n in sorted({len(x) for x in stems})]
    probes.append(F.try_element_at(_map({k: hit(h) for k, h in heads.items()}), _stem(token)))
    exact = F.try_element_at(_map({c: F.lit(k) for _, c, _, k in code_rows()}), token)
    return F.coalesce(exact, F.array_min(F.array(*probes))["condition"])


def condition_flag(conditions: Column, condition: str) -> Column:
    """0/1: ``condition`` is among a row's resolved conditions (0 without codes)."""
    return F.coalesce(F.array_contains(conditions, F.lit(condition)), F.lit(False)).cast("int")


def condition_flags(codes: Column | str) -> dict[str, Column]:
    """Row-wise ``has_<condition>`` flags: tokens resolved in place against
    the fixed-size dictionary (no shuffle, no state; also used by streams)."""
    conds = F.transform(tokenize_codes(codes), token_condition)
    return {f"has_{c}": condition_flag(conds, c) for c in CONDITIONS}


def create_condition_features(df: DataFrame, key: str, column: str = "diagnosis_codes",
                              method: str = "rowwise") -> DataFrame:
    """K5: add the seven ``has_<condition>`` 0/1 columns (0 when no code).

    ``method="rowwise"`` (default) resolves each row's tokens in place: the
    dictionary has a fixed size, so the cost is a map probe per token (plus
    the prefix scan for unmapped tokens) and the table is never shuffled.
    ``method="join"`` is the relational form: explode, resolve the distinct
    tokens, pivot per row key and join back (two shuffles of the rows)."""
    if method == "rowwise":
        # The conditions are a column of their own, so the tokens are resolved once for all flags.
        resolved = df.withColumn("__conditions", F.transform(tokenize_codes(column), token_condition))
        return resolved.withColumns({f"has_{c}": condition_flag(F.col("__conditions"), c) for c in CONDITIONS}).drop("__conditions")
    pairs = condition_pairs(df, key, column, distinct=False)  # max() below absorbs repeats
    flags = pairs.groupBy(key).agg(*[
        F.max((F.col("condition") == c).cast("int")).alias(f"has_{c}") for c in CONDITIONS])
    out = df.join(flags, key, "left")
    return out.withColumns({f: F.coalesce(F.col(f), F.lit(0)) for f in FLAG_COLUMNS}).select(
        *df.columns, *FLAG_COLUMNS)


def conditions_per_string(df: DataFrame, column: str = "diagnosis_codes") -> DataFrame:
    """K7: every distinct code string with the sorted set of its conditions (empty
    for null and for strings without a condition). Strings are made distinct first,
    so the work behind it grows with them and not with the rows."""
    found = F.transform(tokenize_codes(column), token_condition)
    names = F.array_join(F.array_sort(F.array_distinct(F.array_compact(found))), ",")
    return df.select(column).distinct().select(column, F.coalesce(names, F.lit("")).alias("conditions"))


def condition_summary(flagged: DataFrame) -> DataFrame:
    """K6: prevalence (mean) and count (sum) per condition, with its description."""
    spark = flagged.sparkSession
    stats = flagged.agg(F.array(*[F.struct(F.lit(c).alias("condition"),
                                           F.avg(f"has_{c}").alias("prevalence"),
                                           F.sum(f"has_{c}").cast("long").alias("count"))
                                  for c in CONDITIONS]).alias("s")).select(F.inline("s"))
    return stats.join(F.broadcast(condition_dimension(spark)), "condition").select(
        "condition", "prevalence", "count", "description")


def code_frequency(df: DataFrame, column: str = "diagnosis_codes") -> DataFrame:
    """K8: frequency of stripped tokens when splitting on ';' only."""
    tok = F.explode(F.transform(F.split(F.col(column), ";"), lambda x: F.trim(x))).alias("code")
    return (df.where(F.col(column).isNotNull() & (F.col(column) != "")).select(tok)
            .where(F.col("code") != "").groupBy("code").agg(F.count(F.lit(1)).alias("n")))


ICD9_LIKE = r"\d{3}\.\d"
ICD10_LIKE = r"[A-Z]\d{2}\."


def code_system_breakdown(freq: DataFrame) -> DataFrame:
    """K9: number of distinct codes that look like ICD-9, ICD-10, or neither
    (patterns are *contains* tests; the first two may overlap)."""
    c = F.col("code")
    return freq.agg(F.count_if(c.rlike(ICD9_LIKE)).alias("icd9_like"),
                    F.count_if(c.rlike(ICD10_LIKE)).alias("icd10_like"),
                    F.count_if(~c.rlike(f"{ICD9_LIKE}|{ICD10_LIKE}")).alias("local_other"))
