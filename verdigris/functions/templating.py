"""SQL text with parameters: {name} and $name tokens, filters, and the check that it only reads."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import SparkSession

NAME = r"[a-zA-Z_][a-zA-Z0-9_]*"
TOKEN = re.compile(rf"\{{({NAME})\}}|\$({NAME})\b")
FILTER_MARKERS = ("{extra_filters}", "$extra_filters")
#: Class names of parsed plans that do something other than read.
_WRITES = re.compile(r"Insert|Create|Drop|Alter|Truncate|Delete|Update|Merge|Replace|Set|Reset|Command|Add|Cache|Uncache|Refresh|Repair|Analyze|Load|Call|Rename|Use|Declare|Compound")


def escape(value: object) -> str:
    """value as it stands within a quoted literal of Spark SQL, which reads backslashes; None is empty."""
    return ("" if value is None else str(value)).replace("\\", "\\\\").replace("'", "''")


def unresolved(sql: str) -> list[str]:
    return [a or b for a, b in TOKEN.findall(sql)]


def substitute(sql: str | None, params: Mapping[str, object] | None) -> str | None:
    """sql with each token that names a parameter replaced by its escaped value, in one pass.

    Whoever writes the SQL sets the quotes.  A token that is left, also one that
    a value brought in, raises ValueError.
    """
    if not sql:
        return sql
    params = params or {}

    def value(m: re.Match) -> str:
        name = m[1] or m[2]
        return escape(params[name]) if name in params else m[0]

    out = TOKEN.sub(value, sql)
    if left := unresolved(out):
        raise ValueError(f"no parameter for token(s) {sorted(set(left))}; given: {sorted(params)}")
    return out


def equalities(values: Mapping[str, object], alias: str = "") -> list[str]:
    """column = 'value' for each value, sorted by column."""
    return [f"{alias}{k} = '{escape(v)}'" for k, v in sorted(values.items())]


def filters_clause(filters: Mapping[str, object] | None) -> str:
    """AND column = 'value' ... for filters; empty without any.  Names must be identifiers."""
    if not filters:
        return ""
    if bad := sorted(k for k in filters if not re.fullmatch(NAME, str(k))):
        raise ValueError(f"filter name(s) {bad} are no identifiers")
    return "AND " + " AND ".join(equalities(filters))


def with_filters(sql: str, clause: str) -> str:
    """sql with a filters clause: at its marker if it has one, else around the whole query."""
    if any(m in sql for m in FILTER_MARKERS):
        for m in FILTER_MARKERS:
            sql = sql.replace(m, clause)
        return sql
    if not clause:
        return sql
    return f"SELECT * FROM (\n{sql.strip().rstrip(';')}\n) AS filtered_rule WHERE {clause.removeprefix('AND ')}"


def require_query(spark: SparkSession, sql: str) -> None:
    """Raises ValueError unless sql parses to a query; spark.sql would run a command at once."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    kind = plan.getClass().getSimpleName()
    if _WRITES.match(kind) or kind.endswith("Command"):
        raise ValueError(f"a rule must be a query, not {kind}")
