"""Derived feature columns as a dependency graph.

Every derived column names the columns it is computed from, so a request for a
few of them plans only these: :func:`needed` gives the input columns that a
source has to deliver, :func:`derive` adds the columns level by level, each
level one projection. Columns that look at other rows (days since the last
admission) are frame functions, planned only when a request reaches them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions import clinical as CL
from wardflow.operators import codes as K


@dataclass(frozen=True)
class Derived:
    """``needs``: the columns it is computed from; ``expr`` gives its Column, or
    ``frame`` a function that adds it to a frame."""
    needs: tuple[str, ...]
    expr: Callable[[], Column] | None = None
    frame: Callable[[DataFrame], DataFrame] | None = None


def _history(df: DataFrame) -> DataFrame:
    from wardflow.operators.features import add_history
    return add_history(df)


# The conditions of a row's codes, resolved once for all flags.
_CONDITIONS = "__conditions"
_CLUSTERED = {"high_risk_comorbidity": ("has_heart_disease", "has_kidney_disease", "has_diabetes"),
              "cardiovascular_risk": ("has_hypertension", "has_heart_disease", "has_diabetes")}
_RISK_INPUTS = tuple(name for name, _ in CL.RISK_WEIGHTS)
_HIGH_RISK_INPUTS = ("elderly", "previous_admissions", "comorbidity_count", "frequent_readmitter")

GRAPH: dict[str, Derived] = {
    "days_since_last_admission": Derived(("admission_key", "patient_id", "admission_date", "previous_admissions"), frame=_history),
    "recent_admission": Derived(("days_since_last_admission",), lambda: CL.recent_admission("days_since_last_admission")),
    "frequent_readmitter": Derived(("previous_admissions", "days_since_last_admission"),
                                   lambda: CL.frequent_readmitter("previous_admissions", "days_since_last_admission")),
    "admission_pattern": Derived(("previous_admissions", "days_since_last_admission"),
                                 lambda: CL.admission_pattern("previous_admissions", "days_since_last_admission")),
    "admission_month": Derived(("admission_date",), lambda: F.month("admission_date")),
    "admission_season": Derived(("admission_month",), lambda: CL.season("admission_month")),
    "admission_day_of_week": Derived(("admission_date",), lambda: CL.day_of_week("admission_date")),
    "weekend_admission": Derived(("admission_day_of_week",), lambda: CL.flag(F.col("admission_day_of_week") >= 5)),
    "age_group": Derived(("age",), lambda: CL.age_group("age")),
    "elderly": Derived(("age",), lambda: CL.elderly("age")),
    "age_squared": Derived(("age",), lambda: F.col("age") * F.col("age")),
    "emergency_elderly": Derived(("emergency_admission", "age"), lambda: CL.emergency_elderly("emergency_admission", "age")),
    _CONDITIONS: Derived(("diagnosis_codes",), lambda: F.transform(K.tokenize_codes("diagnosis_codes"), K.token_condition)),
    **{f"has_{c}": Derived((_CONDITIONS,), lambda c=c: K.condition_flag(F.col(_CONDITIONS), c)) for c in K.CONDITIONS},
    "comorbidity_count": Derived(tuple(K.FLAG_COLUMNS), lambda: CL.row_sum(K.FLAG_COLUMNS)),
    "multiple_comorbidities": Derived(("comorbidity_count",), lambda: CL.flag(F.col("comorbidity_count") >= 3)),
    **{name: Derived(flags, lambda flags=flags: CL.at_least(list(flags), 2)) for name, flags in _CLUSTERED.items()},
    "clinical_risk_score": Derived(_RISK_INPUTS, lambda: CL.clinical_risk_score(set(_RISK_INPUTS))),
    "risk_category": Derived(("clinical_risk_score",), lambda: CL.risk_category("clinical_risk_score")),
    "high_risk_patient": Derived(_HIGH_RISK_INPUTS, lambda: CL.high_risk_patient(set(_HIGH_RISK_INPUTS))),
    "los_category": Derived(("length_of_stay",), lambda: CL.los_category("length_of_stay")),
    "long_stay": Derived(("length_of_stay",), lambda: CL.long_stay("length_of_stay")),
    "admission_history": Derived(("previous_admissions",), lambda: CL.admission_history("previous_admissions")),
}


def _depths(wanted: Iterable[str]) -> dict[str, int]:
    """Depth of every column reached from ``wanted``: 0 for inputs, else one more
    than its deepest need."""
    depth: dict[str, int] = {}

    def visit(name: str) -> int:
        if name not in depth:
            depth[name] = 1 + max(map(visit, GRAPH[name].needs)) if name in GRAPH else 0
        return depth[name]

    for name in wanted:
        visit(name)
    return depth


def needed(wanted: Iterable[str]) -> list[str]:
    """Input columns (those that are not derived) that ``wanted`` is computed from, sorted."""
    return sorted(name for name, d in _depths(wanted).items() if d == 0)


def derive(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Add the derived columns ``wanted`` to ``df`` (which holds their inputs).

    A column of ``df`` that has the name of a derived one is computed anew;
    columns computed on the way are dropped again. An unknown name that ``df``
    does not hold raises ``ValueError``."""
    wanted = list(wanted)
    missing = [c for c in needed(wanted) if c not in df.columns]
    if missing:
        raise ValueError(f"Missing input columns: {', '.join(missing)}")
    depth = _depths(wanted)
    out = df
    for level in range(1, max(depth.values(), default=0) + 1):
        names = [n for n in GRAPH if depth.get(n) == level]
        for n in names:
            if GRAPH[n].frame is not None:
                out = GRAPH[n].frame(out)
        exprs = {n: GRAPH[n].expr() for n in names if GRAPH[n].expr is not None}
        out = out.withColumns(exprs) if exprs else out
    keep = list(dict.fromkeys([*df.columns, *wanted]))
    return out.select(*keep)
