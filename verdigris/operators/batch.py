"""Verdicts of many rules as one DataFrame: one plan, one result row a rule, nothing on the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, templating, verdict
from . import violations


def filled(rule: Mapping, params: Mapping | None = None, filters: Mapping | None = None, text_params: Mapping | None = None) -> str:
    """The rule's SQL with filters and parameters."""
    sql = templating.with_filters(rule["rule_syntax"], templating.filters_clause(filters))
    return templating.substitute(sql, {**(params or {}), **(text_params or {})})


def violating_keys(spark: SparkSession, rule: Mapping, params: Mapping | None = None, filters: Mapping | None = None) -> DataFrame:
    """src_key_value and n of the rows that violate a rule."""
    return violations.keyed(violations.rule_rows(spark, filled(rule, params, filters)), keys.split_columns(rule["src_key_cols"]))


def judged(spark: SparkSession, rules: Sequence[Mapping], params: Mapping | None = None, filters: Mapping | None = None) -> DataFrame:
    """rule_id, rule_nm, failed_records, total_records, failure_pct, status, in one plan for all rules.

    Each table's denominators come from one scan of it, whatever the scopes.
    """
    scope = violations.scope_condition({**(params or {}), **(filters or {})})
    failed = [violations.rule_rows(spark, filled(r, params, filters)).agg(F.count("*").alias("failed_records")).select(F.lit(r["rule_id"]).alias("rule_id"), "failed_records") for r in rules]
    totals = [spark.table(t).filter(F.expr(scope)).agg(F.count("*").alias("total_records")).select(F.lit(t).alias("src_tbl_nm"), "total_records") for t in sorted({r["src_tbl_nm"] for r in rules})]
    known = [(r["rule_id"], r.get("rule_nm"), r["src_tbl_nm"], r.get("threshold_pct"), r.get("threshold_count"), r.get("threshold_operator") or "OR", r.get("severity") or verdict.DEFAULT_SEVERITY) for r in rules]
    catalogue = spark.createDataFrame(known, "rule_id int, rule_nm string, src_tbl_nm string, threshold_pct double, threshold_count int, threshold_operator string, severity string")
    out = catalogue.join(reduce(DataFrame.unionByName, failed), "rule_id").join(reduce(DataFrame.unionByName, totals), "src_tbl_nm")
    total, n = F.col("total_records"), F.col("failed_records")
    status = verdict.status_column(total, n, F.col("threshold_pct"), F.col("threshold_count"), F.col("threshold_operator"), F.col("severity"))
    pct = verdict.pct_column(total, n)
    return out.select("rule_id", "rule_nm", "failed_records", "total_records", pct.alias("failure_pct"), status.alias("status"))
