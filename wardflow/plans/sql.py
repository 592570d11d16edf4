"""Reference SQL (DuckDB dialect) for the oracle check.

Each registered query has an SQL twin computed from the same driver tables.
Shared steps are named CTE fragments; :func:`with_ctes` emits the fragments a
query needs, dependencies first. The fragments restate, in plain SQL, the
same rules the Spark code applies, so the two engines can be compared.
"""

from __future__ import annotations

from wardflow.sources import binding as B
from wardflow.functions import text as TX
from wardflow.functions import dates as DT


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def sql_list(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


def with_ctes(select: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order) + "\n" + select


def title_sql(x: str) -> str:
    """Python ``str.title`` on a text expression."""
    return ("array_to_string(list_transform(generate_series(1, length({x})), lambda i: "
            "CASE WHEN i = 1 OR upper(substr({x}, i - 1, 1)) = lower(substr({x}, i - 1, 1)) "
            "THEN upper(substr({x}, i, 1)) ELSE lower(substr({x}, i, 1)) END), '')").format(x=x)


def gender_sql(x: str) -> str:
    whens = " ".join(f"WHEN {x} = {lit(k)} THEN {lit(v)}" for k, v in TX.GENDER_MAPPING.items())
    return f"(CASE {whens} ELSE 'Unknown' END)"


def insurance_sql(x: str) -> str:
    parts = [f"WHEN {x} IS NULL OR {x} = '' THEN 'Unknown'"]
    up = f"upper(trim({x}))"
    for label, words in TX.INSURANCE_KEYWORDS.items():
        keys = sorted({w.upper() for w in words})
        cond = " OR ".join(f"contains({up}, {lit(k)})" for k in keys)
        parts.append(f"WHEN {cond} THEN {lit(label)}")
    return "(CASE " + " ".join(parts) + " ELSE 'Other' END)"


def sentinel_sql(x: str) -> str:
    words = ", ".join(lit(w) for w in DT.DATE_SENTINELS)
    return f"({x} IS NULL OR {x} = '' OR upper({x}) IN ({words}))"


def parse_date_sql(x: str) -> str:
    tries = [f"try_strptime({x}, {lit(f)})" for f in DT.DATE_FORMATS]
    tries.append(f"try_cast(trim({x}) AS TIMESTAMP)")
    tries += [f"try_strptime(trim({x}), {lit(f)})" for f in ("%B %d, %Y", "%b %d, %Y", "%d %B %Y", "%d %b %Y")]
    return f"(CASE WHEN {sentinel_sql(x)} THEN NULL ELSE coalesce({', '.join(tries)}) END)"


def pick_sql(values, index: str) -> str:
    return f"({sql_list(values)})[({index}) + 1]"


# ---------------------------------------------------------------- binding
cte("per_order", (), f"""
  SELECT l_orderkey,
         avg(l_quantity) / 3.0 AS _los,
         list_sort(list(DISTINCT {pick_sql(B.CODE_TOKENS, f"(l_partkey + l_linenumber) % {len(B.CODE_TOKENS)}")})) AS _codes
  FROM lineitem GROUP BY l_orderkey""")

cte("raw_seq", ("per_order",), """
  SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS DATE) AS _d, o.o_orderpriority, p._los, p._codes,
         row_number() OVER w AS _rn, lead(CAST(o.o_orderdate AS DATE)) OVER w AS _next
  FROM orders o LEFT JOIN per_order p ON o.o_orderkey = p.l_orderkey
  WINDOW w AS (PARTITION BY o.o_custkey ORDER BY CAST(o.o_orderdate AS DATE), o.o_orderkey)""")

_DATE_TEXT = f"""CASE o_orderkey % 12
      WHEN 0 THEN strftime(_d, '%Y-%m-%d') WHEN 1 THEN strftime(_d, '%m/%d/%Y')
      WHEN 2 THEN strftime(_d, '%d-%m-%Y') WHEN 3 THEN strftime(_d, '%Y%m%d')
      WHEN 4 THEN strftime(_d, '%m-%d-%Y') WHEN 5 THEN strftime(_d, '%d/%m/%Y')
      WHEN 6 THEN strftime(_d, '%Y/%m/%d')
      WHEN 7 THEN strftime(_d, '%Y-%m-%d') || ' ' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00'
      WHEN 8 THEN {pick_sql(B.DATE_SENTINELS, f"(o_orderkey // 12) % {len(B.DATE_SENTINELS)}")}
      WHEN 9 THEN strftime(_d, '%B %-d, %Y') WHEN 10 THEN strftime(_d, '%-m/%-d/%Y')
      ELSE strftime(_d, '%Y-%m-%d') END"""

cte("raw", ("raw_seq",), f"""
  SELECT o_orderkey AS admission_key,
    'PID_' || repeat('0', greatest(0, 6 - length(CAST(o_custkey AS VARCHAR)))) || CAST(o_custkey AS VARCHAR) AS patient_id,
    CAST(CASE WHEN o_orderkey % 41 = 7 THEN NULL WHEN o_orderkey % 199 = 3 THEN 150.0
              WHEN o_orderkey % 211 = 5 THEN -2.0 ELSE 18 + (o_custkey * 37) % 83 END AS DOUBLE) AS age,
    {pick_sql(B.GENDER_VARIANTS, f"o_custkey % {len(B.GENDER_VARIANTS)}")} AS gender,
    {_DATE_TEXT} AS admission_date,
    _los AS length_of_stay,
    CAST(CASE WHEN o_orderkey % 31 = 4 THEN NULL WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS INTEGER) AS emergency_admission,
    CASE WHEN o_orderkey % 23 = 9 THEN '' WHEN o_orderkey % 23 = 10 THEN ' ; '
         WHEN o_orderkey % 3 = 0 THEN array_to_string(_codes, ';')
         WHEN o_orderkey % 3 = 1 THEN array_to_string(_codes, ',')
         ELSE array_to_string(_codes, '|') END AS diagnosis_codes,
    CAST(CASE WHEN o_orderkey % 17 = 6 THEN NULL ELSE _rn - 1 END AS INTEGER) AS previous_admissions,
    CASE WHEN o_orderkey % 13 = 2 THEN NULL ELSE {pick_sql(B.INSURANCE_VARIANTS, f"o_custkey % {len(B.INSURANCE_VARIANTS)}")} END AS insurance_type,
    CAST(coalesce(date_diff('day', _d, _next) <= 30, false) AS INTEGER) AS readmission_30_day
  FROM raw_seq""")


# ---------------------------------------------------------------- cleaning
def _clean_text_select(src: str, legacy: bool = False) -> str:
    def t(c: str) -> str:
        return f"trim(coalesce({c}, 'nan'))" if legacy else f"trim({c})"
    return f"""
  SELECT admission_key,
    regexp_replace({t('patient_id')}, '[^\\w\\s]', '', 'g') AS patient_id,
    age, {title_sql(t('gender'))} AS gender,
    {t('admission_date')} AS admission_date,
    length_of_stay, emergency_admission,
    {t('diagnosis_codes')} AS diagnosis_codes,
    previous_admissions,
    {title_sql(t('insurance_type'))} AS insurance_type,
    readmission_30_day
  FROM {src}"""


cte("texted", ("raw",), _clean_text_select("raw"))
cte("std", ("texted",), f"""
  SELECT admission_key, patient_id, age, {gender_sql('gender')} AS gender,
    {parse_date_sql('admission_date')} AS admission_date, length_of_stay, emergency_admission,
    diagnosis_codes, previous_admissions, {insurance_sql('insurance_type')} AS insurance_type,
    readmission_30_day
  FROM texted""")
cte("los_bounds", ("std",), """
  SELECT quantile_cont(length_of_stay, 0.01) AS lo, quantile_cont(length_of_stay, 0.99) AS hi FROM std""")
cte("clipped", ("std", "los_bounds"), """
  SELECT s.* REPLACE (CASE WHEN s.length_of_stay IS NULL THEN NULL
                           ELSE least(greatest(s.length_of_stay, b.lo), b.hi) END AS length_of_stay)
  FROM std s CROSS JOIN los_bounds b""")
cte("clean_stats", ("clipped",), """
  SELECT median(age) AS age_med, median(length_of_stay) AS los_med,
         median(CAST(emergency_admission AS DOUBLE)) AS em_med
  FROM clipped""")
cte("clean", ("clipped", "clean_stats"), """
  SELECT admission_key, patient_id, coalesce(age, age_med) AS age, gender, admission_date,
    coalesce(length_of_stay, los_med) AS length_of_stay,
    coalesce(CAST(emergency_admission AS DOUBLE), em_med) AS emergency_admission,
    diagnosis_codes,
    coalesce(previous_admissions, 0) AS previous_admissions,
    insurance_type, readmission_30_day
  FROM clipped CROSS JOIN clean_stats""")


# ------------------------------------------------------------------ codes
def dbl(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def _code_values() -> str:
    from wardflow.operators.codes import code_rows
    return ", ".join(f"({o}, {lit(c)}, {lit(s)}, {lit(k)})" for o, c, s, k in code_rows())


def _cond_values() -> str:
    from wardflow.operators.codes import CONDITION_MAPPINGS
    return ", ".join(f"({i}, {lit(c)}, {lit(m['description'])})" for i, (c, m) in enumerate(CONDITION_MAPPINGS.items()))


cte("code_dim", (), f"  SELECT * FROM (VALUES {_code_values()}) v(ord, code, system, condition)")
cte("cond_dim", (), f"  SELECT * FROM (VALUES {_cond_values()}) v(cond_ord, condition, description)")
cte("tokens", ("clean",), """
  SELECT admission_key, token FROM (
    SELECT admission_key, upper(trim(unnest(string_split_regex(diagnosis_codes, '[;,|]')))) AS token FROM clean
  ) WHERE token <> ''""")
cte("tok_exact", ("tokens", "code_dim"), """
  SELECT t.token, d.condition FROM (SELECT DISTINCT token FROM tokens) t JOIN code_dim d ON t.token = d.code""")
cte("tok_loose", ("tokens", "code_dim"), """
  SELECT t.token, arg_min(d.condition, d.ord) AS condition
  FROM (SELECT DISTINCT token FROM tokens WHERE token NOT IN (SELECT code FROM code_dim)) t
  JOIN code_dim d ON starts_with(t.token, split_part(d.code, '.', 1)) OR starts_with(d.code, split_part(t.token, '.', 1))
  GROUP BY t.token""")
cte("tok_map", ("tok_exact", "tok_loose"), "  SELECT * FROM tok_exact UNION ALL SELECT * FROM tok_loose")
cte("cond_pairs", ("tokens", "tok_map"), """
  SELECT DISTINCT k.admission_key, m.condition FROM tokens k JOIN tok_map m ON k.token = m.token""")


def _flag_cols() -> list[str]:
    from wardflow.operators.codes import CONDITIONS
    return CONDITIONS


cte("flags", ("cond_pairs",), "  SELECT admission_key, " + ", ".join(
    f"max(CASE WHEN condition = '{c}' THEN 1 ELSE 0 END) AS has_{c}" for c in _flag_cols())
    + " FROM cond_pairs GROUP BY admission_key")
cte("coded", ("clean", "flags"), "  SELECT c.*, " + ", ".join(
    f"coalesce(f.has_{c}, 0) AS has_{c}" for c in _flag_cols())
    + " FROM clean c LEFT JOIN flags f ON c.admission_key = f.admission_key")


# --------------------------------------------------------------- features
def bins_sql(x: str, edges, labels, left: bool = False) -> str:
    parts = []
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        lo_s = "'-inf'::DOUBLE" if lo == float("-inf") else dbl(float(lo))
        hi_s = "'inf'::DOUBLE" if hi == float("inf") else dbl(float(hi))
        cond = f"{x} >= {lo_s} AND {x} < {hi_s}" if left else f"{x} > {lo_s} AND {x} <= {hi_s}"
        parts.append(f"WHEN {cond} THEN {lit(lab)}")
    return "(CASE " + " ".join(parts) + " END)"


def flag_sql(pred: str) -> str:
    return f"CAST(coalesce({pred}, false) AS INTEGER)"


def _risk_score_sql() -> str:
    from wardflow.functions.clinical import RISK_WEIGHTS
    expr = dbl(0.0)
    for name, w in RISK_WEIGHTS:
        expr = f"({expr} + {name} * {dbl(w)})"
    return expr


cte("hist", ("coded",), """
  SELECT *, lag(admission_date) OVER (PARTITION BY patient_id ORDER BY admission_date ASC NULLS LAST, admission_key) AS _prev
  FROM coded""")


def _featured_pre() -> str:
    from wardflow.functions import clinical as CL
    days = ("CAST(CASE WHEN previous_admissions > 0 THEN coalesce(floor((epoch(admission_date) - epoch(_prev)) / 86400), 999) "
            "ELSE 999 END AS DOUBLE)")
    return f"""
  SELECT * EXCLUDE (_prev) FROM (
  SELECT *,
    {bins_sql('clinical_risk_score', CL.RISK_EDGES, CL.RISK_LABELS)} AS risk_category,
    CAST(coalesce(elderly = 1, false) OR coalesce(previous_admissions >= 3, false)
         OR coalesce(comorbidity_count >= 3, false) OR coalesce(frequent_readmitter = 1, false) AS INTEGER) AS high_risk_patient
  FROM (
  SELECT *, {_risk_score_sql()} AS clinical_risk_score FROM (
  SELECT *,
    {flag_sql('comorbidity_count >= 3')} AS multiple_comorbidities,
    {flag_sql('has_heart_disease + has_kidney_disease + has_diabetes >= 2')} AS high_risk_comorbidity,
    {flag_sql('has_hypertension + has_heart_disease + has_diabetes >= 2')} AS cardiovascular_risk
  FROM (
  SELECT *,
    {flag_sql('days_since_last_admission <= 30')} AS recent_admission,
    {flag_sql('previous_admissions >= 2 AND days_since_last_admission <= 90')} AS frequent_readmitter,
    CASE WHEN previous_admissions = 0 THEN 'First_Time' WHEN days_since_last_admission <= 30 THEN 'Recent_Return'
         WHEN days_since_last_admission <= 90 THEN 'Short_Interval' WHEN days_since_last_admission <= 365 THEN 'Medium_Interval'
         ELSE 'Long_Interval' END AS admission_pattern,
    CASE WHEN admission_month IN (12, 1, 2) THEN 'Winter' WHEN admission_month IN (3, 4, 5) THEN 'Spring'
         WHEN admission_month IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS admission_season,
    {flag_sql('admission_day_of_week >= 5')} AS weekend_admission,
    {bins_sql('age', CL.AGE_EDGES, CL.AGE_LABELS)} AS age_group,
    {flag_sql('age >= 75')} AS elderly,
    age * age AS age_squared,
    {flag_sql('emergency_admission = 1 AND age >= 65')} AS emergency_elderly,
    has_diabetes + has_hypertension + has_heart_disease + has_kidney_disease + has_hyperlipidemia + has_copd + has_depression AS comorbidity_count,
    {bins_sql('length_of_stay', CL.LOS_EDGES, CL.LOS_LABELS)} AS los_category,
    {flag_sql('length_of_stay > 10')} AS long_stay,
    {bins_sql('previous_admissions', CL.HISTORY_EDGES, CL.HISTORY_LABELS)} AS admission_history
  FROM (
  SELECT *, {days} AS days_since_last_admission,
    month(admission_date) AS admission_month, isodow(admission_date) - 1 AS admission_day_of_week
  FROM hist)))))"""


cte("featured_pre", ("hist",), _featured_pre())


def dummy_columns() -> list[tuple[str, str, str]]:
    """(source column, value, dummy column) in emission order."""
    from wardflow.operators.features import CATEGORICAL_COLUMNS, VOCABULARY
    return [(c, v, f"{c}_std_{v}") for c in CATEGORICAL_COLUMNS for v in VOCABULARY[c]]


cte("featured", ("featured_pre",), "  SELECT * EXCLUDE (" + ", ".join(
    sorted({c for c, _, _ in dummy_columns()})) + "), " + ", ".join(
    f"{flag_sql(f'{c} = {lit(v)}')} AS \"{d}\"" for c, v, d in dummy_columns()) + " FROM featured_pre")


# ---------------------------------------------------------------- scoring
def demo_score_expr() -> str:
    from wardflow.functions import clinical as CL
    n = " + ".join(flag_sql(p) for p in ["age > 75", "has_diabetes = 1", "has_hypertension = 1",
                                          "has_heart_disease = 1", "length_of_stay > 7",
                                          "previous_admissions >= 3", "emergency_admission = 1"])
    return f"least({dbl(CL.DEMO_CAP)}, {dbl(CL.DEMO_BASE)} + ({n}) * {dbl(CL.DEMO_STEP)})"


INDEX_SCORE_SQL = ("greatest(CAST(0.0 AS DOUBLE), least(CAST(1.0 AS DOUBLE), (age + CAST(3.0 AS DOUBLE) * length_of_stay "
                   "+ CAST(7.0 AS DOUBLE) * previous_admissions + CAST(11.0 AS DOUBLE) * has_heart_disease) / CAST(300.0 AS DOUBLE)))")

cte("scored", ("featured_pre",), f"""
  SELECT *, CAST(p >= 0.35 AS INTEGER) AS pred, CAST(p2 >= 0.5 AS INTEGER) AS pred2 FROM (
    SELECT *, readmission_30_day AS y, {demo_score_expr()} AS p, {INDEX_SCORE_SQL} AS p2 FROM featured_pre)""")


def auc_sql(src: str, score: str, by: str | None = None, label: str = "y") -> str:
    g = f"{by} AS grp, " if by else ""
    part = "PARTITION BY grp " if by else ""
    grp_sel = "grp, " if by else ""
    return f"""
SELECT {grp_sel}CASE WHEN max(P) > 0 AND max(N) > 0 THEN sum(pos * (neg_below + 0.5 * neg)) / (max(P) * max(N)) END AS roc_auc,
       CASE WHEN max(P) > 0 THEN sum(pos * (P - pos_below) / (P + N - pos_below - neg_below)) / max(P) END AS pr_auc
FROM (
  SELECT *, coalesce(sum(neg) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
            coalesce(sum(pos) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
            sum(pos) OVER ({part}) AS P, sum(neg) OVER ({part}) AS N
  FROM (SELECT {g}{score} AS s, CAST(sum({label}) AS DOUBLE) AS pos, CAST(count(*) - sum({label}) AS DOUBLE) AS neg
        FROM {src} GROUP BY ALL) d
  WINDOW w AS ({part}ORDER BY s)
) c {"GROUP BY grp" if by else ""}"""
