"""The verdict on a rule, for one rule in Python and for many as a column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Severities whose breach is a warning (fixed values).
SOFT = ("WARN", "WARNING", "INFO", "NOTICE")
DEFAULT_SEVERITY = "Data Validation Error"


@dataclass(frozen=True)
class Verdict:
    status: str
    #: Whether the result row must be written, and the thresholds it was judged by.
    write_result: bool
    pct_used: float | None = None
    count_used: int | None = None
    operator_used: str | None = None


def evaluate(total: int, failed: int, pct: float | None = None, count: int | None = None, operator: str | None = "OR", severity: str | None = DEFAULT_SEVERITY) -> Verdict:
    """PASS, or FAIL or WARN by severity if a threshold is exceeded.

    AND holds only if both thresholds are given.  Without thresholds any failed
    row is a breach.  An empty table passes.
    """
    bad = "WARN" if (severity or "").upper() in SOFT else "FAIL"
    if not total:
        return Verdict("PASS", False)
    operator = (operator or "OR").upper()
    if pct is None and count is None:
        return Verdict(bad, True, None, 0, operator) if failed > 0 else Verdict("PASS", False)
    breaches = [failed / total * 100 > pct] if pct is not None else []
    breaches += [failed > count] if count is not None else []
    breached = all(breaches) if operator == "AND" else any(breaches)
    return Verdict(bad if breached else "PASS", True, pct, count, operator)


def failure_pct(total: int, failed: int) -> float:
    """Failed rows in a hundred, to six digits; 0 of an empty table."""
    return round(failed / total * 100, 6) if total else 0.0


def pct_column(total: Column, failed: Column) -> Column:
    """``failure_pct`` for columns.  bround takes the digits of the double's text, so the only ties are those that decimal text shows; both go to the even digit."""
    return F.when(total > 0, F.bround(failed / total * 100, 6)).otherwise(F.lit(0.0))


def status_column(total: Column, failed: Column, pct: Column, count: Column, operator: Column, severity: Column) -> Column:
    """The status of ``evaluate`` for columns; null thresholds are none."""
    bad = F.when(F.upper(severity).isin(*SOFT), "WARN").otherwise("FAIL")
    by_pct, by_count = failed / total * 100 > pct, failed > count
    both = (F.upper(operator) == "AND") & pct.isNotNull() & count.isNotNull()
    breached = F.when(pct.isNull() & count.isNull(), failed > 0).when(both, by_pct & by_count)
    breached = breached.otherwise(F.coalesce(by_pct, F.lit(False)) | F.coalesce(by_count, F.lit(False)))
    return F.when(F.coalesce(total, F.lit(0)) == 0, "PASS").when(breached, bad).otherwise("PASS")
