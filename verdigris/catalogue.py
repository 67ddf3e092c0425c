"""Every operator of the engine as a query on the supplied tables, with SQL that says the same.

Queries that need a metadata store run the engine on one in the shared folder.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import ids, keys, quota
from .functions import settings as settings_
from .functions.settings import Settings
from .operators import batch, ordering, sampling, violations
from .plans import metastore as ms
from .plans import mirror, reporting
from .plans.rules import RuleRunner, discover_groups, load_rules
from .plans.sampling import SamplingRunner
from .plans.scratch import shared_folder
from .sources import files
from .sources.resolver import SourceResolver
from .streaming.mirror import follow

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
RUN_KEY = "RUN_1"

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str | Callable[[], str]] = {}


_schemas: dict[str, object] = {}


def views(spark: SparkSession, sf_dir: str) -> None:
    """The tables as views.  A path's schema is read from its files once in a process."""
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if path not in _schemas:
            _schemas[path] = spark.read.parquet(path).schema
        spark.read.schema(_schemas[path]).parquet(path).createOrReplaceTempView(t)


def query(name: str, sql: str | Callable[[], str] | None = None):
    """Registers a query; the tables are views while it is made."""

    def register(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            views(spark, sf_dir)
            return f(spark, sf_dir)

        _queries[name] = run
        if sql:
            _sql[name] = sql
        return f

    return register


def rule(rule_id: int, table: str, sql: str, key: str, **more: object) -> dict:
    return {"rule_id": rule_id, "rule_nm": f"rule_{rule_id}", "act_ind": 1, "rule_group": "G", "project_name": "P", "process_name": "PR", "seq_no": rule_id, "sql_dialect": "spark", "src_tbl_nm": table, "rule_syntax": sql, "src_key_cols": key, **more}


NEGATIVE = rule(1, "customer", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0", "c_custkey", threshold_pct=5.0)


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return {name: sql if isinstance(sql, str) else sql() for name, sql in _sql.items()}


# Violations and keys


def _keys_of(name: str, sql: str, key: str, oracle_keys: str, table: str = "", params: dict | None = None, filters: dict | None = None, oracle: str | None = None) -> None:
    """A rule as a query: its violating keys and how many rows have each."""
    r = rule(1, table, sql, key)
    literal = oracle or sql
    query(name, f"SELECT {oracle_keys} AS src_key_value, count(*) AS n FROM ({literal}) v GROUP BY 1")(lambda spark, _: batch.violating_keys(spark, r, params, filters))


_keys_of("rule_violation_scan", NEGATIVE["rule_syntax"], "c_custkey", "'c_custkey=' || c_custkey")
_keys_of("rule_key_composite_dedupe", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > 0.05", "l_orderkey,l_linenumber", "'l_orderkey=' || l_orderkey || '|l_linenumber=' || l_linenumber")
_keys_of("rule_key_null_encoding", "SELECT c_custkey, NULLIF(c_mktsegment, 'BUILDING') AS seg FROM customer", "c_custkey,seg", "'c_custkey=' || c_custkey || '|seg=' || coalesce(seg, 'NULL')")
_keys_of("rule_key_casing", "SELECT C_CUSTKEY FROM customer WHERE c_acctbal > 9000", "C_CustKey", "'C_CustKey=' || c_custkey")
_keys_of("rule_params_scoped", "SELECT o_orderkey FROM orders WHERE o_orderstatus = '{status}' AND o_orderpriority LIKE '$prio%'", "o_orderkey", "'o_orderkey=' || o_orderkey", params={"status": "F", "prio": "1"}, oracle="SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '1%'")
_keys_of("rule_params_quoted", "SELECT c_custkey FROM customer WHERE c_name <> '{name}' AND c_acctbal < 100", "c_custkey", "'c_custkey=' || c_custkey", params={"name": "O'Brien \\ Co"}, oracle="SELECT c_custkey FROM customer WHERE c_name <> 'O''Brien \\ Co' AND c_acctbal < 100")
_keys_of("rule_extra_filters_marker", "SELECT c_custkey FROM customer WHERE c_acctbal < 0 {extra_filters}", "c_custkey", "'c_custkey=' || c_custkey", filters={"c_mktsegment": "BUILDING"}, oracle="SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_mktsegment = 'BUILDING'")
_keys_of("rule_extra_filters_wrap", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal < 0;", "c_custkey", "'c_custkey=' || c_custkey", filters={"c_mktsegment": "BUILDING"}, oracle="SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_mktsegment = 'BUILDING'")
_keys_of("rule_extra_filters_or_precedence", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000", "c_custkey", "'c_custkey=' || c_custkey", filters={"c_mktsegment": "BUILDING"}, oracle="SELECT c_custkey FROM customer WHERE (c_acctbal < 0 OR c_acctbal > 9000) AND c_mktsegment = 'BUILDING'")
_keys_of("rule_join_violation", "SELECT l.l_orderkey, l.l_linenumber FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_shipdate < o.o_orderdate", "l_orderkey,l_linenumber", "'l_orderkey=' || l_orderkey || '|l_linenumber=' || l_linenumber")
_keys_of("rule_left_anti", "SELECT d.doc_id FROM documents d LEFT ANTI JOIN labels l ON d.doc_id = l.doc_id", "doc_id", "'doc_id=' || doc_id", oracle="SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
_keys_of("rule_semi", "SELECT c_custkey FROM customer LEFT SEMI JOIN orders ON c_custkey = o_custkey", "c_custkey", "'c_custkey=' || c_custkey", oracle="SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
_keys_of("rule_left_join_null", "SELECT n.n_name, s.s_suppkey FROM nation n LEFT JOIN supplier s ON n.n_nationkey = s.s_nationkey AND s.s_acctbal > 5000", "n_name,s_suppkey", "'n_name=' || n_name || '|s_suppkey=' || coalesce(s_suppkey::VARCHAR, 'NULL')")
_keys_of("rule_full_outer", "SELECT d.doc_id AS a, p.page_id AS b FROM documents d FULL JOIN pages p ON d.doc_id = p.page_id + 900", "a,b", "'a=' || coalesce(a::VARCHAR, 'NULL') || '|b=' || coalesce(b::VARCHAR, 'NULL')")
_keys_of("rule_correlated_subquery", "SELECT o_orderkey FROM orders o WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.5 FROM orders i WHERE i.o_custkey = o.o_custkey)", "o_orderkey", "'o_orderkey=' || o_orderkey")
_keys_of("rule_cte", "WITH big AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) SELECT o_custkey FROM big WHERE n > 15", "o_custkey", "'o_custkey=' || o_custkey")
_keys_of("rule_groupby_having", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 6", "l_orderkey", "'l_orderkey=' || l_orderkey")
_keys_of("rule_window_violation", "SELECT o_orderkey FROM (SELECT o_orderkey, o_totalprice, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders) w WHERE o_totalprice > 10 * before", "o_orderkey", "'o_orderkey=' || o_orderkey")
_keys_of("rule_window_row_number", "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth FROM orders) w WHERE nth > 10", "o_orderkey", "'o_orderkey=' || o_orderkey")
_keys_of("rule_setop_except", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders", "c_custkey", "'c_custkey=' || c_custkey")
_keys_of("rule_setop_intersect", "SELECT c_custkey FROM customer WHERE c_acctbal < 0 INTERSECT SELECT o_custkey FROM orders", "c_custkey", "'c_custkey=' || c_custkey")
_keys_of("rule_union_all", "SELECT c_custkey FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey FROM customer WHERE c_acctbal < -500", "c_custkey", "'c_custkey=' || c_custkey")
_keys_of("rule_rollup", "SELECT l_returnflag, l_linestatus, count(*) AS c FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)", "l_returnflag,l_linestatus,c", "'l_returnflag=' || coalesce(l_returnflag, 'NULL') || '|l_linestatus=' || coalesce(l_linestatus, 'NULL') || '|c=' || c")
_keys_of("rule_cube", "SELECT o_orderstatus, o_orderpriority, count(*) AS c FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)", "o_orderstatus,o_orderpriority,c", "'o_orderstatus=' || coalesce(o_orderstatus, 'NULL') || '|o_orderpriority=' || coalesce(o_orderpriority, 'NULL') || '|c=' || c")
_keys_of("rule_grouping_sets", "SELECT o_orderstatus, o_orderpriority, count(*) AS c FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())", "o_orderstatus,o_orderpriority,c", "'o_orderstatus=' || coalesce(o_orderstatus, 'NULL') || '|o_orderpriority=' || coalesce(o_orderpriority, 'NULL') || '|c=' || c")
# Ranges of width 5 meet values by the two steps of 5 that they touch, an equality that hashes, instead of part x supplier comparisons.
_RANGE = "SELECT p.p_partkey, s.s_suppkey FROM part p JOIN supplier s ON s.s_acctbal BETWEEN p.p_retailprice AND p.p_retailprice + 5"
_STEPS = "SELECT p.p_partkey, s.s_suppkey FROM (SELECT *, explode(sequence(floor(p_retailprice / 5), floor((p_retailprice + 5) / 5))) AS step FROM part) p JOIN supplier s ON floor(s.s_acctbal / 5) = p.step AND s.s_acctbal BETWEEN p.p_retailprice AND p.p_retailprice + 5"
_keys_of("rule_range_join", _STEPS, "p_partkey,s_suppkey", "'p_partkey=' || p_partkey || '|s_suppkey=' || s_suppkey", oracle=_RANGE)
_keys_of("rule_asof", "SELECT event_id, prior FROM (SELECT event_id, event_type, last_value(CASE WHEN event_type = 'purchase' THEN event_id END, true) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM events) w WHERE event_type = 'error'", "event_id,prior", "'event_id=' || event_id || '|prior=' || coalesce(prior::VARCHAR, 'NULL')", oracle="SELECT event_id, prior FROM (SELECT event_id, event_type, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM events) w WHERE event_type = 'error'")
_keys_of("rule_string_pattern", "SELECT p_partkey FROM part WHERE p_name LIKE '%a%' AND upper(p_brand) LIKE 'BRAND#1%' AND p_type NOT LIKE '%STEEL'", "p_partkey", "'p_partkey=' || p_partkey")
_keys_of("rule_case_in_between", "SELECT o_orderkey FROM orders WHERE CASE WHEN o_orderstatus IN ('F', 'O') THEN o_totalprice ELSE 0 END BETWEEN 1000 AND 5000", "o_orderkey", "'o_orderkey=' || o_orderkey")
_keys_of("rule_date_window", "SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1996-01-01' + INTERVAL 3 MONTH AND year(o_orderdate) = 1996", "o_orderkey", "'o_orderkey=' || o_orderkey")
_keys_of("rule_json_props", "SELECT event_id, get_json_object(props, '$.k') AS k FROM events WHERE event_type = 'error'", "event_id,k", "'event_id=' || event_id || '|k=' || coalesce(k, 'NULL')", oracle="SELECT event_id, json_extract_string(props, '$.k') AS k FROM events WHERE event_type = 'error'")
_keys_of("rule_nested_columns", "SELECT vec_id FROM embeddings WHERE size(embedding) <> 0 AND embedding[0] > 0", "vec_id", "'vec_id=' || vec_id", oracle="SELECT vec_id FROM embeddings WHERE len(embedding) <> 0 AND embedding[1] > 0")
_keys_of("rule_duplicate_columns", "SELECT c_custkey AS k, c_nationkey AS k FROM customer WHERE c_acctbal < 0", "k", "'k=' || k", oracle="SELECT c_nationkey AS k FROM customer WHERE c_acctbal < 0")


@query("rule_key_text_forms", "SELECT 't=' || CASE WHEN c_acctbal > 0 THEN 'True' ELSE 'False' END || '|d=' || (c_custkey * 1000000.5)::DOUBLE AS src_key_value FROM customer")
def _text_forms(spark, _):
    rows = violations.rule_rows(spark, "SELECT c_acctbal > 0 AS t, CAST(c_custkey * 1000000.5 AS DOUBLE) AS d FROM customer")
    return rows.select(keys.key_column(rows, ["t", "d"]).alias("src_key_value"))


@query("rule_key_decode", "SELECT src_key_value, nullif(split_part(split_part(src_key_value, '|', 1), '=', 2), 'NULL') AS custkey, nullif(split_part(split_part(src_key_value, '|', 2), '=', 2), 'NULL') AS seg FROM (SELECT 'c_custkey=' || c_custkey || '|seg=' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'NULL') AS src_key_value FROM customer)")
def _decode(spark, _):
    rows = violations.rule_rows(spark, "SELECT c_custkey, NULLIF(c_mktsegment, 'BUILDING') AS seg FROM customer")
    m = keys.decoded(F.col("src_key_value"))
    return rows.select(keys.key_column(rows, ["c_custkey", "seg"]).alias("src_key_value")).select("src_key_value", m["c_custkey"].alias("custkey"), m["seg"].alias("seg"))


@query("rule_key_diagnostics", "SELECT count(*) AS failed, count(DISTINCT l_orderkey || '|' || l_linenumber) AS distinct_keys, count(*) - count(DISTINCT l_orderkey || '|' || l_linenumber) AS collapsed FROM lineitem")
def _diagnostics(spark, _):
    found = batch.violating_keys(spark, rule(1, "lineitem", "SELECT * FROM lineitem", "l_orderkey, l_linenumber"))
    return found.agg(F.sum("n").alias("failed"), F.count("*").alias("distinct_keys"), (F.sum("n") - F.count("*")).alias("collapsed"))


# Verdicts


def _verdict_sql(rules: list[dict], literal: dict[int, str] | None = None, scope: str = "") -> str:
    parts = []
    for r in rules:
        pct, cnt, op = r.get("threshold_pct"), r.get("threshold_count"), (r.get("threshold_operator") or "OR").upper()
        bad = "WARN" if (r.get("severity") or "").upper() in ("WARN", "WARNING", "INFO", "NOTICE") else "FAIL"
        breach = [f"f::DOUBLE / t * 100 > {pct}"] * (pct is not None) + [f"f > {cnt}"] * (cnt is not None)
        breach = f" {'AND' if op == 'AND' else 'OR'} ".join(breach) or "f > 0"
        sql = (literal or {}).get(r["rule_id"], r["rule_syntax"])
        parts.append(f"SELECT {r['rule_id']} AS rule_id, '{r['rule_nm']}' AS rule_nm, f AS failed_records, t AS total_records, CASE WHEN t > 0 THEN round(f::DOUBLE / t * 100, 6) ELSE 0.0::DOUBLE END AS failure_pct, CASE WHEN t = 0 THEN 'PASS' WHEN {breach} THEN '{bad}' ELSE 'PASS' END AS status FROM (SELECT (SELECT count(*) FROM ({sql}) v) AS f, (SELECT count(*) FROM {r['src_tbl_nm']}{scope}) AS t)")
    return "\nUNION ALL\n".join(parts)


def _verdicts(name: str, rules: list[dict], **options) -> None:
    query(name, _verdict_sql(rules, **options.pop("sql", {})))(lambda spark, _: batch.judged(spark, rules, **options))


def _neg(rule_id: int, **more: object) -> dict:
    return rule(rule_id, "customer", NEGATIVE["rule_syntax"], "c_custkey", **more)


CLEAN = rule(9, "orders", "SELECT o_orderkey FROM orders WHERE o_totalprice < 0", "o_orderkey")
_verdicts("rule_verdict_single", [NEGATIVE])
_verdicts("rule_group_verdicts", [_neg(1), _neg(2, threshold_pct=5.0), _neg(3, threshold_pct=50.0), _neg(4, threshold_count=10), _neg(5, threshold_count=10**6), _neg(6, threshold_pct=50.0, threshold_count=10), _neg(7, threshold_pct=50.0, threshold_count=10, threshold_operator="AND"), _neg(8, threshold_pct=5.0, threshold_count=10, threshold_operator="and"), CLEAN])
_verdicts("rule_verdict_soft_severity", [_neg(i, severity=s) for i, s in enumerate(("WARN", "warning", "Info", "NOTICE", "ERROR", "Data Validation Error"), 1)])
_verdicts("rule_verdict_and_operator", [_neg(1, threshold_pct=5.0, threshold_operator="AND"), _neg(2, threshold_count=10**6, threshold_operator="AND"), _neg(3, threshold_pct=5.0, threshold_count=10**6, threshold_operator="AND")])
_verdicts("rule_zero_total", [rule(1, "customer", "SELECT c_custkey FROM customer WHERE c_acctbal < 0", "c_custkey")], params={"c_mktsegment": "NONE"}, sql={"scope": " WHERE c_mktsegment = 'NONE'"})
_verdicts("rule_total_scoped", [rule(1, "customer", "SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_mktsegment = '{c_mktsegment}'", "c_custkey", threshold_pct=5.0)], params={"c_mktsegment": "BUILDING"}, sql={"scope": " WHERE c_mktsegment = 'BUILDING'", "literal": {1: "SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_mktsegment = 'BUILDING'"}})


# The engine on a store


def engine(spark: SparkSession, rules: list[dict], config: Settings | None = None) -> RuleRunner:
    """A runner on a new store that holds the rules."""
    store = ms.MetaStore(spark, f"{shared_folder(spark)}/meta-{uuid.uuid4().hex}")
    store.append(ms.RULES, rules)
    return RuleRunner(store, SourceResolver(spark, config), config)


def _exceptions(runner: RuleRunner) -> DataFrame:
    return runner.store.current(ms.EXCEPTIONS).select("rule_id", "run_key", "src_key_value", "etl_is_curr_ind")


def _results(runner: RuleRunner) -> DataFrame:
    return runner.store.current(ms.RESULTS).select("rule_id", "total_records", "failed_records", "failure_pct", "status", "active_ind")


BELOW = "SELECT c_custkey FROM customer WHERE c_acctbal < {limit}"
_REC = "SELECT 1 AS rule_id, 'RUN_1' AS run_key, 'c_custkey=' || c_custkey AS src_key_value, "


def _limits(spark: SparkSession, *limits: int) -> RuleRunner:
    """The same run again with other limits: rows get right or wrong between the attempts."""
    runner = engine(spark, [rule(1, "customer", BELOW, "c_custkey")])
    for n in limits:
        runner.run_group("G", RUN_KEY, text_params={"limit": n})
    return runner


query("reconcile_first_run", _REC + "'Y' AS etl_is_curr_ind FROM customer WHERE c_acctbal < 0")(lambda spark, _: _exceptions(_limits(spark, 0)))
query("reconcile_rerun", _REC + "'Y' AS etl_is_curr_ind FROM customer WHERE c_acctbal < 0")(lambda spark, _: _exceptions(_limits(spark, 0, 0)))
query("reconcile_fixed", _REC + "CASE WHEN c_acctbal < -500 THEN 'Y' ELSE 'N' END AS etl_is_curr_ind FROM customer WHERE c_acctbal < 0")(lambda spark, _: _exceptions(_limits(spark, 0, -500)))
query("reconcile_regressed", _REC + "'Y' AS etl_is_curr_ind FROM customer WHERE c_acctbal < 0")(lambda spark, _: _exceptions(_limits(spark, 0, -500, 0)))


@query("reconcile_actions", "SELECT 'c_custkey=' || c_custkey AS src_key_value, CASE WHEN c_acctbal >= 500 AND c_acctbal < 1000 THEN 'INSERT' WHEN c_acctbal < 0 AND c_custkey % 2 = 0 THEN 'DEACTIVATE' WHEN c_acctbal >= 0 AND c_custkey % 2 = 1 THEN 'REACTIVATE' ELSE 'KEEP' END AS action FROM customer WHERE c_acctbal < 1000")
def _actions(spark, _):
    old = spark.sql("SELECT 'c_custkey=' || c_custkey AS src_key_value, CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END AS etl_is_curr_ind FROM customer WHERE c_acctbal < 500")
    new = spark.sql("SELECT 'c_custkey=' || c_custkey AS src_key_value FROM customer WHERE c_acctbal >= 0 AND c_acctbal < 1000")
    return violations.actions(old, new).select("src_key_value", "action")


@query("blanket_deactivate", "SELECT 1 AS rule_id, n AS total_records, f AS failed_records, round(f::DOUBLE / n * 100, 6) AS failure_pct, 'FAIL' AS status, a AS active_ind FROM (SELECT count(*) AS n, count(*) FILTER (c_acctbal < 0) AS f FROM customer), (VALUES ('Y'), ('N')) v(a)")
def _blanket(spark, _):
    return _results(_limits(spark, 0, 0))


@query("rule_total_fallback", "SELECT 1 AS rule_id, n AS total_records, f AS failed_records, round(f::DOUBLE / n * 100, 6) AS failure_pct, 'FAIL' AS status, 'Y' AS active_ind FROM (SELECT count(*) AS n, count(*) FILTER (c_acctbal < 0) AS f FROM customer)")
def _fallback(spark, _):
    runner = engine(spark, [rule(1, "customer", BELOW, "c_custkey")])
    runner.run_group("G", RUN_KEY, params={"limit": 0})  # limit is no column
    return _results(runner)


GROUP = [NEGATIVE, _neg(2, threshold_count=10**6), rule(3, "nowhere", "SELECT x FROM nowhere", "x"), rule(4, "customer", "SELECT c_custkey FROM customer WHERE c_name = '{missing}'", "c_custkey"), CLEAN]
_GROUP_SQL = "SELECT * FROM (SELECT rule_id, total_records, failed_records, failure_pct, status, 'Y' AS active_ind FROM (" + _verdict_sql([NEGATIVE, _neg(2, threshold_count=10**6), CLEAN]) + ") UNION ALL SELECT rule_id, NULL, 0, NULL, 'ERROR', 'Y' FROM (VALUES (3), (4)) v(rule_id))"


def _group_results(spark: SparkSession, batch_: bool = False, config: Settings | None = None) -> DataFrame:
    runner = engine(spark, GROUP, config)
    runner.run_group("G", RUN_KEY, batch=batch_)
    return _results(runner)


query("rule_group_run", _GROUP_SQL)(lambda spark, _: _group_results(spark))
query("rule_group_run_batched", _GROUP_SQL)(lambda spark, _: _group_results(spark, True))
query("rule_group_run_parallel", _GROUP_SQL)(lambda spark, _: _group_results(spark, False, Settings(max_parallel_rules=4)))


@query("rule_group_errors", "SELECT * FROM (VALUES (3, 'SQL_RUNTIME', 'Y'), (4, 'PARAM_SUBSTITUTION_ERROR', 'Y')) v(rule_id, error_type, active_ind)")
def _errors(spark, _):
    runner = engine(spark, GROUP)
    runner.run_group("G", RUN_KEY)
    return runner.store.current(ms.RULE_ERRORS).select("rule_id", "error_type", "active_ind")


@query("rule_group_audit", "SELECT 'HALTED' AS status, 3 AS total_rules, 1 AS rules_succeeded, 1 AS rules_errored, 'RUN_1' AS run_key")
def _audit(spark, _):
    seq = {"sequencing_mode": "sequential", "on_failure": "halt_group"}
    runner = engine(spark, [_neg(1, **seq), rule(2, "nowhere", "SELECT x FROM nowhere", "x", **seq), _neg(3, **seq)])
    runner.run_group("G", RUN_KEY)
    return runner.store.current(ms.RULE_AUDIT).select("status", "total_rules", "rules_succeeded", "rules_errored", "run_key")


@query("rule_key_not_distinct", "SELECT 'KEY_NOT_DISTINCT' AS error_type, count(*) - count(DISTINCT l_orderkey) || ' rows share a key with another: ' || count(DISTINCT l_orderkey) || ' keys of ' || count(*) || ' rows' AS error_message FROM lineitem WHERE l_tax > 0.07")
def _not_distinct(spark, _):
    runner = engine(spark, [rule(1, "lineitem", "SELECT l_orderkey FROM lineitem WHERE l_tax > 0.07", "l_orderkey")])
    runner.run_group("G", RUN_KEY)
    return runner.store.current(ms.RULE_ERRORS).select("error_type", "error_message")


VARIANTS = [_neg(1, seq_no=2), _neg(2, seq_no=1, rule_variant="A"), _neg(3, seq_no=None, rule_variant="B"), _neg(4, act_ind=0), _neg(5, rule_group="H", project_name="Q")]


@query("load_rules_variant", "SELECT * FROM (VALUES ('', 1, 2), ('', 2, 1), ('', 3, 3), ('A', 1, 2), ('A', 2, 1)) v(variant, rule_id, place)")
def _variants(spark, _):
    store = engine(spark, VARIANTS).store
    return spark.createDataFrame([(v, r["rule_id"], i) for v in ("", "A") for i, r in enumerate(load_rules(store, "G", v), 1)], "variant string, rule_id int, place int")


@query("discover_groups", "SELECT * FROM (VALUES ('', 'G'), ('', 'H'), ('Q', 'H')) v(project, rule_group)")
def _discover(spark, _):
    store = engine(spark, VARIANTS).store
    return spark.createDataFrame([(p, g) for p in ("", "Q") for g in discover_groups(store, p or None)], "project string, rule_group string")


@query("rule_run_scope", "SELECT * FROM (VALUES ('G', 'COMPLETED', 3), ('H', 'COMPLETED', 1)) v(rule_group, status, total_rules)")
def _scope(spark, _):
    out = engine(spark, VARIANTS).run_scope(RUN_KEY, process="PR")
    return spark.createDataFrame([(g, s["status"], s["total_rules"]) for g, s in out.items()], "rule_group string, status string, total_rules int")


# Reports


@query("report_breaches", "SELECT rule_id, status, failed_records FROM (" + _verdict_sql([NEGATIVE, _neg(2, severity="INFO")]) + ")")
def _breaches(spark, _):
    runner = engine(spark, [NEGATIVE, _neg(2, severity="INFO"), CLEAN])
    run_id = runner.run_group("G", RUN_KEY)["run_id"]
    return reporting.breaches(runner.store, run_id).select("rule_id", "status", "failed_records")


@query("report_records", "SELECT 1 AS rule_id, 'c_custkey=' || c_custkey AS src_key_value FROM customer WHERE c_acctbal < 0")
def _records(spark, _):
    return reporting.records(_limits(spark, 0).store, 1, RUN_KEY).select("rule_id", "src_key_value")


@query("tieback_source_single", "SELECT 1 AS _rule_id, 'c_custkey=' || c_custkey AS _src_key_value, c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 0")
def _tieback(spark, _):
    runner = _limits(spark, 0)
    return reporting.source_records(runner.store, runner.sources, 1, RUN_KEY).select("_rule_id", "_src_key_value", "c_custkey", "c_name", "c_acctbal")


@query("tieback_source_composite", "SELECT 'l_orderkey=' || l_orderkey || '|l_linenumber=' || l_linenumber AS _src_key_value, l_partkey, l_suppkey FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_quantity >= 49)")
def _tieback_composite(spark, _):
    runner = engine(spark, [rule(1, "lineitem", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity >= 49", "l_orderkey,l_linenumber")])
    runner.run_group("G", RUN_KEY)
    return reporting.source_records(runner.store, runner.sources, 1, RUN_KEY).select("_src_key_value", "l_partkey", "l_suppkey")


@query("tieback_process", "SELECT 1 AS _rule_id, c_custkey, NULL::BIGINT AS s_suppkey FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 2, NULL, s_suppkey FROM supplier WHERE s_acctbal < 5000")
def _tieback_process(spark, _):
    runner = engine(spark, [NEGATIVE, rule(2, "supplier", "SELECT s_suppkey FROM supplier WHERE s_acctbal < 5000", "s_suppkey")])
    runner.run_group("G", RUN_KEY)
    return reporting.source_records_for_process(runner.store, runner.sources, "PR", RUN_KEY).select("_rule_id", "c_custkey", "s_suppkey")


@query("tieback_generated_sql", "SELECT c_custkey, c_name, 1 AS _rule_id FROM customer WHERE c_acctbal < 0")
def _tieback_sql(spark, _):
    runner = _limits(spark, 0)
    sql = runner.store.current(ms.RESULTS).first()["source_tieback_sql"]
    runner.store.current(ms.EXCEPTIONS).createOrReplaceTempView("exceptions")
    return spark.sql(sql).select("c_custkey", "c_name", "_rule_id")


@query("tieback_missing_keys", "SELECT 'c_custkey=' || c_custkey AS src_key_value FROM customer WHERE c_acctbal < 0 AND c_custkey % 3 = 0")
def _missing(spark, _):
    runner = _limits(spark, 0)
    rows = reporting.tie_back(spark.table("customer").filter("c_custkey % 3 <> 0"), ["c_custkey"], reporting.records(runner.store, 1, RUN_KEY))
    return reporting.missing_keys(reporting.records(runner.store, 1, RUN_KEY), rows).select("src_key_value")


# Sampling

PRIORITY = "o_totalprice DESC NULLS LAST"
STATUS = {"F": 0.5, "O": 0.3}
LEVELS = [sampling.Level(1, 1, "o_orderstatus", "status", STATUS), sampling.Level(2, 2, "o_orderpriority", "priority", {"1-URGENT": 0.4, "2-HIGH": 0.2})]


def _pool(spark: SparkSession, levels: list, method: str = "RANKED", scope: str | None = None, exclusion: str | None = None, priority: str | None = PRIORITY, **more: object) -> DataFrame:
    return sampling.candidates(spark.table("orders"), ["o_orderkey"], levels, scope, exclusion, priority, method, **more)


def _chosen(spark: SparkSession, levels: list, target: int, method: str = "RANKED", rounding: str = "FLOOR", mode: str = "seeded", **more: object) -> DataFrame:
    import random

    pool = _pool(spark, levels, method, seed=7, random_mode=mode, **more)
    return sampling.select(pool, levels, target, method, rounding, random.Random(7), mode).rows.select("case_key")


_ORDERED = "row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey)"
_IN_LEAF = "row_number() OVER (PARTITION BY {by} ORDER BY o_totalprice DESC NULLS LAST, o_orderkey)"


@query("sample_pull_ranked", f"SELECT 'o_orderkey=' || o_orderkey AS case_key, {_ORDERED} AS priority_rank FROM orders WHERE o_orderstatus = 'F'")
def _pull(spark, _):
    return _pool(spark, [], scope="o_orderstatus = '{status}'", params={"status": "F"}).select("case_key", F.col("_rank").alias("priority_rank"))


@query("sample_exclusion_3vl", "SELECT 'o_orderkey=' || o_orderkey AS case_key FROM orders WHERE NOT (nullif(o_orderstatus, 'P') = 'F' OR o_totalprice < 1000)")
def _exclusion(spark, _):
    return _pool(spark, [], exclusion="nullif(o_orderstatus, 'P') = 'F' OR o_totalprice < 1000").select("case_key")


@query("sample_null_bucket", "SELECT 'o_orderkey=' || o_orderkey AS case_key, coalesce(nullif(o_orderstatus, 'P'), 'None') AS bucket FROM orders")
def _null_bucket(spark, _):
    return _pool(spark, [sampling.Level(1, 1, "nullif(o_orderstatus, 'P')")]).select("case_key", F.col("_strata_1").alias("bucket"))


_ONE = f"SELECT o_orderkey, o_orderstatus, {_IN_LEAF.format(by='o_orderstatus')} AS nth FROM orders"
_TARGETS = "CASE o_orderstatus WHEN 'F' THEN 50 WHEN 'O' THEN 30 ELSE 19 END"  # 100 * (1 - (0.5 + 0.3)) is below 20
query("sample_quota_one_level", f"WITH c AS ({_ONE}), q AS (SELECT * FROM c WHERE nth <= {_TARGETS}), rest AS (SELECT o_orderkey FROM orders ANTI JOIN q USING (o_orderkey) ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 1) SELECT 'o_orderkey=' || o_orderkey AS case_key FROM (SELECT o_orderkey FROM q UNION ALL SELECT o_orderkey FROM rest)")(lambda spark, _: _chosen(spark, LEVELS[:1], 100))
query("sample_topup", "SELECT 'o_orderkey=' || o_orderkey AS case_key FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS nth, o_orderstatus AS s FROM orders) WHERE s = 'F' AND nth <= 10 UNION ALL SELECT 'o_orderkey=' || o_orderkey FROM (SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS nth FROM orders WHERE o_orderstatus = 'F') WHERE nth <= 10) ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 90)")(lambda spark, _: _chosen(spark, [sampling.Level(1, 1, "o_orderstatus", "s", {"F": 0.1, "O": 0.0, "P": 0.0})], 100))
query("sample_no_mix_truncate", f"SELECT 'o_orderkey=' || o_orderkey AS case_key FROM ({_ONE}) WHERE o_orderstatus = 'F' AND nth <= 60")(lambda spark, _: _chosen(spark, [sampling.Level(1, 1, "o_orderstatus")], 60))


_TWO = "SELECT o_orderkey, o_orderstatus || '/' || o_orderpriority AS leaf, " + _IN_LEAF.format(by="o_orderstatus, o_orderpriority") + f" AS nth, {_ORDERED} AS place FROM orders"


@query("sample_quota_two_level", lambda: f"WITH t AS ({_quota_sql({'FLOOR': 'floor({})'}, 200)}), c AS ({_TWO}), q AS (SELECT c.* FROM c JOIN t USING (leaf) WHERE nth <= target), rest AS (SELECT * FROM c ANTI JOIN q USING (o_orderkey)) SELECT 'o_orderkey=' || o_orderkey AS case_key FROM q UNION ALL SELECT 'o_orderkey=' || o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY place) AS k FROM rest) WHERE k <= 200 - (SELECT count(*) FROM q)")
def _two_level(spark, _):
    return _chosen(spark, LEVELS, 200)


def _quota_rows(spark: SparkSession, mode: str, target: int) -> DataFrame:
    """The targets of all leaves of two levels, from the pool's own counts."""
    cols = [lv.column for lv in LEVELS]
    counts = {tuple(r[c] for c in cols): r["n"] for r in _pool(spark, LEVELS).groupBy(*cols).agg(F.count("*").alias("n")).collect()}
    plan = quota.leaves(counts, [lv.mix for lv in LEVELS], target, mode)
    return spark.createDataFrame([(mode, leaf.name, leaf.size, leaf.target) for leaf in plan], "mode string, leaf string, candidates long, target long")


def _quota_sql(modes: dict[str, str], target: int) -> str:
    parts = []
    for mode, f in modes.items():
        parts.append(f"""SELECT '{mode}' AS mode, s || '/' || p AS leaf, n AS candidates, greatest(0, {f.format('t * coalesce(pf, greatest(0.0::DOUBLE, 1.0::DOUBLE - 0.6000000000000001::DOUBLE) / pu)')})::BIGINT AS target FROM (
  SELECT s, p, n, pf, pu, greatest(0, {f.format(f"{target}::DOUBLE * coalesce(sf, greatest(0.0::DOUBLE, 1.0::DOUBLE - (0.5::DOUBLE + 0.3::DOUBLE)) / su)")}) AS t FROM (
    SELECT o_orderstatus AS s, o_orderpriority AS p, count(*) AS n,
      CASE o_orderstatus WHEN 'F' THEN 0.5::DOUBLE WHEN 'O' THEN 0.3::DOUBLE END AS sf,
      CASE o_orderpriority WHEN '1-URGENT' THEN 0.4::DOUBLE WHEN '2-HIGH' THEN 0.2::DOUBLE END AS pf,
      1 AS su, (SELECT count(DISTINCT o_orderpriority) - 2 FROM orders i WHERE i.o_orderstatus = o.o_orderstatus) AS pu
    FROM orders o GROUP BY ALL))""")
    return "\nUNION ALL\n".join(parts)


_MODES = {"FLOOR": "floor({})", "CEIL": "ceil({})", "ROUND": "round_even({}, 0)"}


@query("sample_rounding_modes", _quota_sql(_MODES, 333))
def _rounding(spark, _):
    return _quota_rows(spark, "FLOOR", 333).union(_quota_rows(spark, "CEIL", 333)).union(_quota_rows(spark, "ROUND", 333))


@query("sample_unmixed_split", _quota_sql({"FLOOR": "floor({})"}, 1000))
def _unmixed(spark, _):
    return _quota_rows(spark, "FLOOR", 1000)


@query("sample_systematic")
def _systematic(spark, _):
    return _chosen(spark, LEVELS[:1], 90, "SYSTEMATIC")


@query("sample_systematic_fixed", "SELECT 'o_orderkey=' || o_orderkey AS case_key FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) - 1 AS pos FROM orders) WHERE pos >= 2 AND (pos - 2) % 5 = 0 AND (pos - 2) // 5 < 40")
def _systematic_fixed(spark, _):
    pos = F.col("_pos")
    return _pool(spark, [], "SYSTEMATIC").filter((pos >= 2) & ((pos - 2) % 5 == 0) & ((pos - 2) / 5 < 40)).select("case_key")


@query("sample_random_seeded")
def _random(spark, _):
    return _chosen(spark, LEVELS, 120, "RANDOM")


class _Given:
    """In place of random numbers: an offset, and a shuffle that turns the order round."""

    def __init__(self, offset: int):
        self.offset = offset

    def randint(self, low: int, high: int) -> int:
        return min(max(low, self.offset), high)

    def shuffle(self, places) -> None:
        places.reverse()


def _given_sql(taken: str) -> str:
    return f"WITH c AS (SELECT o_orderkey, {_IN_LEAF.format(by='o_orderstatus')} - 1 AS pos, count(*) OVER (PARTITION BY o_orderstatus) AS n, {_TARGETS.replace('50', '40').replace('30', '24').replace('19', '16')} AS t FROM orders) SELECT 'o_orderkey=' || o_orderkey AS case_key FROM c WHERE {taken}"


#: Whole targets without a rest: 0.5, 0.3 and 0.2 of 80.
_FIFTHS = [sampling.Level(1, 1, "o_orderstatus", "status", {"F": 0.5, "O": 0.3, "P": 0.2})]


@query("sample_systematic_given", _given_sql("CASE WHEN t >= n THEN true ELSE pos >= least(2, n // t) - 1 AND (pos - (least(2, n // t) - 1)) % (n // t) = 0 AND (pos - (least(2, n // t) - 1)) // (n // t) < t END"))
def _systematic_given(spark, _):
    return sampling.select(_pool(spark, _FIFTHS, "SYSTEMATIC"), _FIFTHS, 80, "SYSTEMATIC", "FLOOR", _Given(2)).rows.select("case_key")


@query("sample_random_given", _given_sql("pos >= n - t"))
def _random_given(spark, _):
    return sampling.select(_pool(spark, _FIFTHS, "RANDOM", seed=1), _FIFTHS, 80, "RANDOM", "FLOOR", _Given(1)).rows.select("case_key")


query("sample_random_hash", "WITH c AS (SELECT 'o_orderkey=' || o_orderkey AS case_key, o_orderstatus, md5('7|o_orderkey=' || o_orderkey) AS h FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY h, case_key) AS nth FROM c), q AS (SELECT case_key FROM r WHERE nth <= " + _TARGETS + ") SELECT case_key FROM q UNION ALL SELECT case_key FROM (SELECT case_key FROM c ANTI JOIN q USING (case_key) ORDER BY h, case_key LIMIT 1)")(lambda spark, _: _chosen(spark, LEVELS[:1], 100, "RANDOM", mode="hash"))


@query("sample_selection_attrs", "SELECT 'o_orderkey=' || o_orderkey AS case_key, 1 AS strata_id, 1 AS level_order, o_orderstatus AS bucket_value FROM orders UNION ALL SELECT 'o_orderkey=' || o_orderkey, 2, 2, o_orderpriority FROM orders")
def _attrs(spark, _):
    return sampling.attributes(_pool(spark, LEVELS), LEVELS)


def sampler(spark: SparkSession, **config: object) -> SamplingRunner:
    store = ms.MetaStore(spark, f"{shared_folder(spark)}/meta-{uuid.uuid4().hex}")
    store.append(ms.SAMPLING_CONFIG, [{"config_id": 1, "act_ind": 1, "project_name": "P", "process_name": "PR", "sample_name": "S", "source_type": "spark", "universe_table": "orders", "key_columns": "o_orderkey", "target_volume": 100, "sampling_method": "RANKED", "priority_rank_sql": PRIORITY, "rounding_mode": "FLOOR", **config}])
    store.append(ms.SAMPLING_STRATA, [{"strata_id": 1, "config_id": 1, "level_order": 1, "level_name": "status", "stratify_expr": "o_orderstatus"}])
    store.append(ms.SAMPLING_MIX, [{"mix_id": i, "strata_id": 1, "bucket_value": b, "target_fraction": f} for i, (b, f) in enumerate(STATUS.items())])
    return SamplingRunner(store, SourceResolver(spark))


@query("sample_run_persisted", f"WITH c AS ({_ONE}), q AS (SELECT * FROM c WHERE nth <= {_TARGETS}), rest AS (SELECT o_orderkey FROM orders ANTI JOIN q USING (o_orderkey) ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 1), s AS (SELECT o_orderkey FROM q UNION ALL SELECT o_orderkey FROM rest) SELECT 'o_orderkey=' || o_orderkey AS case_key, priority_rank, (o_orderkey IN (SELECT o_orderkey FROM s))::INTEGER AS selected_flag, 0 AS excluded_flag, a AS etl_is_curr_ind FROM (SELECT o_orderkey, {_ORDERED} AS priority_rank FROM orders), (VALUES ('Y'), ('N')) v(a)")
def _persisted(spark, _):
    runner = sampler(spark)
    runner.run(1, RUN_KEY)
    runner.run(1, RUN_KEY)  # the first run's rows are no longer current
    return runner.store.current(ms.SAMPLE_SELECTIONS).select("case_key", "priority_rank", "selected_flag", "excluded_flag", "etl_is_curr_ind")


@query("sample_audit", "SELECT 'COMPLETED' AS status, 100 AS target_volume, count(*) AS total_candidates, 100::BIGINT AS total_selected FROM orders UNION ALL SELECT 'ERROR', 100, 0, 0")
def _sample_audit(spark, _):
    runner = sampler(spark)
    runner.run(1, RUN_KEY)
    bad = sampler(spark, scope_sql="x = '{missing}'")
    bad.run(1, RUN_KEY)
    return runner.store.current(ms.SAMPLING_AUDIT).union(bad.store.current(ms.SAMPLING_AUDIT)).select("status", "target_volume", "total_candidates", "total_selected")


# Mirror


@query("mirror_incremental_upsert", "SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer")
def _upsert(spark, _):
    old = spark.table("customer").select("c_custkey", "c_name", "c_acctbal").filter("c_custkey % 5 <> 0 OR c_custkey % 3 = 0")
    new = spark.table("customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("c_acctbal")).filter("c_custkey % 3 = 0 OR c_custkey % 5 = 0")
    return mirror.upserted(old, new, ("c_custkey",))


@query("mirror_reopen", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' - INTERVAL 60 MINUTE OR o_orderstatus = 'P'")
def _reopen(spark, _):
    import datetime as dt

    table = ms.Table("orders", ("o_orderkey",), "o_orderkey long", (), True, "o_orderdate", "o_orderstatus = 'P'")
    return mirror.changed(spark.table("orders"), table, dt.datetime(2000, 1, 1), 60).select("o_orderkey")


@query("mirror_full_refresh", "SELECT * FROM (VALUES (1, 'rule_1'), (2, 'rule_2'), (3, 'rule_3'), (4, 'rule_4'), (5, 'rule_5')) v(rule_id, rule_nm)")
def _refresh(spark, _):
    source = engine(spark, VARIANTS).store
    target = ms.MetaStore(spark, f"{shared_folder(spark)}/mirror-{uuid.uuid4().hex}")
    m = mirror.Mirror(source, target)
    m.sync(["rules"])
    m.sync(["rules"])
    return target.current(ms.RULES).select("rule_id", "rule_nm")


@query("mirror_stream", _REC + "CASE WHEN c_acctbal < -500 THEN 'Y' ELSE 'N' END AS etl_is_curr_ind FROM customer WHERE c_acctbal < 0")
def _mirror_stream(spark, _):
    runner = engine(spark, [rule(1, "customer", BELOW, "c_custkey")])
    target = ms.MetaStore(spark, f"{shared_folder(spark)}/mirror-{uuid.uuid4().hex}")
    for limit in (0, -500):
        runner.run_group("G", RUN_KEY, text_params={"limit": limit})
        follow(runner.store, target, ms.EXCEPTIONS, f"{target.path}-progress", once=True).awaitTermination()
    return target.current(ms.EXCEPTIONS).select("rule_id", "run_key", "src_key_value", "etl_is_curr_ind")


@query("mirror_exceptions", _REC + "CASE WHEN c_acctbal < -500 THEN 'Y' ELSE 'N' END AS etl_is_curr_ind FROM customer WHERE c_acctbal < 0")
def _mirror_exceptions(spark, _):
    runner = engine(spark, [rule(1, "customer", BELOW, "c_custkey")])
    target = ms.MetaStore(spark, f"{shared_folder(spark)}/mirror-{uuid.uuid4().hex}")
    m = mirror.Mirror(runner.store, target)
    for limit in (0, -500):
        runner.run_group("G", RUN_KEY, text_params={"limit": limit})
        m.sync(["exceptions"])
    return target.current(ms.EXCEPTIONS).select("rule_id", "run_key", "src_key_value", "etl_is_curr_ind")


@query("order_global_rank", "SELECT l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey) AS rank FROM lineitem")
def _global_rank(spark, _):
    rows = spark.table("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey")
    by = ordering.order_columns("l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey")
    return ordering.placed(rows, by).select("l_orderkey", "l_linenumber", "l_extendedprice", F.col("_rank").alias("rank"))


# Sources


def _placed(spark: SparkSession, name: str, kind: str, rows: DataFrame, **options: object) -> str:
    """A folder of files in the shared folder."""
    folder = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    rows.write.options(**options).format(kind).save(f"{folder}/{name}")
    return folder


#: Text that a reader of lines would cut: quotes, separators and line breaks within values.
_TEXT = "concat(c_name, '\\n\"', c_mktsegment, '\",\\t; ', c_custkey) AS note"
_TEXT_SQL = "c_name || chr(10) || '\"' || c_mktsegment || '\",' || chr(9) || '; ' || c_custkey AS note"


def _separated(spark: SparkSession, suffix: str, sep: str) -> DataFrame:
    rows = spark.sql(f"SELECT c_custkey AS C_CUSTKEY, c_acctbal, {_TEXT} FROM customer")
    folder = _placed(spark, f"customer{suffix}", "csv", rows, header=True, sep=sep, quote='"', escape='"')
    source = SourceResolver(spark, Settings(file_base_path=folder)).get("file")
    return source.load(None, f"customer{suffix}").select(F.col("c_custkey").cast("long"), "c_acctbal", "note")


query("source_csv", f"SELECT c_custkey, c_acctbal, {_TEXT_SQL} FROM customer")(lambda spark, _: _separated(spark, ".csv", ","))
query("source_tsv", f"SELECT c_custkey, c_acctbal, {_TEXT_SQL} FROM customer")(lambda spark, _: _separated(spark, ".tsv", "\t"))


@query("source_csv_glob", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS c_mktsegment FROM customer")
def _csv_glob(spark, _):
    """Files of two headers, united by name."""
    folder = _placed(spark, "even", "csv", spark.sql("SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0"), header=True)
    spark.sql("SELECT c_mktsegment, c_custkey FROM customer WHERE c_custkey % 2 = 1").write.option("header", True).csv(f"{folder}/odd")
    rows = SourceResolver(spark).get("s3").load(folder, "*/*.csv")
    return rows.select(F.col("c_custkey").cast("long"), "c_acctbal", "c_mktsegment")


@query("source_parquet_glob", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def _parquet_glob(spark, _):
    """An object store's prefix, with a column in the path."""
    rows = spark.sql("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
    folder = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    rows.write.partitionBy("o_orderstatus").parquet(f"{folder}/orders")
    return SourceResolver(spark).get("s3").load(folder, "orders/*/*.parquet").select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("source_file_rule", "SELECT 'c_custkey=' || c_custkey AS src_key_value FROM customer WHERE c_acctbal < 0")
def _file_rule(spark, _):
    """A rule over a Parquet file, which SQL knows by its view name."""
    folder = _placed(spark, "2026 customers.v2.parquet", "parquet", spark.table("customer"))
    runner = engine(spark, [rule(1, "2026 customers.v2.parquet", "SELECT c_custkey FROM t_2026_customers_v2 WHERE c_acctbal < 0", "c_custkey", sql_dialect="file", database_name=folder)])
    runner.run_group("G", RUN_KEY)
    return runner.store.current(ms.EXCEPTIONS).select("src_key_value")


DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def _database(spark: SparkSession, table: str, rows: DataFrame) -> str:
    """The URL of a database with rows as its only table, which driver and executors can open at once.

    The database that comes with Spark lets one process write to it, but any number read it from a jar.  So the
    driver fills one of its own by the database's import of files, closes it, and puts it as a jar, not compressed
    so that its pages are found without reading those before, into the shared folder, which must be a mounted one.
    """
    folder = f"{shared_folder(spark)}/database-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getScheme() != "file":
        raise RuntimeError(f"a database cannot be opened within {folder}: spark.checkpoint.dir must be a mounted folder")
    fs.deleteOnExit(place)
    shared = place.toUri().getPath()
    # Every value in quotes, which keep spaces at its ends; without them it is null.
    quoted = [F.coalesce(F.concat(F.lit('"'), F.replace(F.col(f"`{c}`").cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")) for c in rows.columns]
    rows.select(F.concat_ws(",", *quoted)).write.text(f"{folder}/rows")
    with tempfile.TemporaryDirectory(prefix="verdigris-") as own:
        own = Path(own).resolve()
        url, driver, none = f"jdbc:derby:{own}/db", spark._jvm.org.apache.derby.iapi.jdbc.AutoloadedDriver(), spark._jvm.java.util.Properties()
        # Without rows this only makes the table, and no executor connects.
        spark.createDataFrame([], rows.schema).limit(0).write.jdbc(f"{url};create=true", table, properties={"driver": DERBY})
        connection = driver.connect(url, none)
        load = connection.prepareCall("CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(NULL, ?, ?, ',', '\"', 'UTF-8', 0)")
        for part in sorted(Path(f"{shared}/rows").glob("part-*")):
            load.setString(1, table.upper())
            load.setString(2, str(part))
            load.execute()
        connection.close()
        try:
            driver.connect(f"{url};shutdown=true", none)
        except Py4JJavaError as e:
            if e.java_exception.getSQLState() != "08006":  # how it says that it has closed
                raise
        with zipfile.ZipFile(f"{shared}/db.jar", "w", zipfile.ZIP_STORED) as jar:
            for f in sorted(own.rglob("*")):
                jar.write(f, f.relative_to(own))
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/rows"), True)
    return f"jdbc:derby:jar:({shared}/db.jar)db"


@query("source_jdbc_split", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _jdbc(spark, _):
    """A database table, read in ranges of its key; the one that comes with Spark stands for others."""
    url = _database(spark, "customers", spark.table("customer").select("c_custkey", "c_name", "c_acctbal"))
    env = {"DQ_POSTGRES_URL": url, "DQ_POSTGRES_DRIVER": DERBY, "DQ_POSTGRES_SPLIT_COLUMN": "C_CUSTKEY", "DQ_POSTGRES_SPLITS": "4"}
    return SourceResolver(spark, env=env).get("postgres").load(None, "customers").toDF("c_custkey", "c_name", "c_acctbal")


@query("source_names", "SELECT * FROM (VALUES ('claims.csv', 'claims', '/base/claims.csv', true), ('2026 a-b.v2.tsv', 't_2026_a_b_v2', '/base/2026 a-b.v2.tsv', true), ('/abs/x.parquet', '_abs_x', '/abs/x.parquet', true), ('s3a://b/k.xlsx', 's3a___b_k', 's3a://b/k.xlsx', true), ('x.json', 'x', '/base/x.json', false)) v(given, view_name, path, supported)")
def _names(spark, _):
    source = SourceResolver(spark, Settings(file_base_path="/base/")).get("file")
    rows = [(g, files.view_name(g), source.path(None, g), g.endswith(files.SUFFIXES)) for g in ("claims.csv", "2026 a-b.v2.tsv", "/abs/x.parquet", "s3a://b/k.xlsx", "x.json")]
    return spark.createDataFrame(rows, "given string, view_name string, path string, supported boolean")


@query("source_registry", "SELECT * FROM (VALUES ('file', true, NULL), ('postgres', false, 'driver=org.none.Driver,sslmode=prefer,user=u'), ('s3', true, NULL), ('spark', true, NULL), ('teradata', false, 'driver=org.none.Driver,logmech=LDAP')) v(name, live, options)")
def _registry(spark, _):
    resolver = SourceResolver(spark, env={"DQ_POSTGRES_URL": "jdbc:none:p", "DQ_POSTGRES_USER": "u", "DQ_POSTGRES_DRIVER": "org.none.Driver", "DQ_TERADATA_URL": "jdbc:none:t", "DQ_TERADATA_DRIVER": "org.none.Driver"})
    shown = lambda s: ",".join(f"{k}={v}" for k, v in sorted(s.options.items())) if hasattr(s, "options") else None
    return spark.createDataFrame([(n, resolver.live(n) is not None, shown(resolver.get(n))) for n in resolver.names()], "name string, live boolean, options string")


# Names and settings


@query("run_names", "SELECT 'a_1_x' AS run_key, current_date::VARCHAR AS default_run_key, true AS run_id_fits, true AS group_id_fits, true AS differ")
def _run_names(spark, _):
    import re

    one, two = ids.run_id("S", "", None, "K", "attempt-1"), ids.group_run_id("P", "G", "K", 2, "SYSTEM")
    stamp = r"\d{8}T\d{6}\.\d{6}::[0-9a-f]{6}"
    rows = [(ids.build_run_key("a", 1, "x"), ids.default_run_key(), bool(re.fullmatch(f"S::K::attempt-1::{stamp}", one)), bool(re.fullmatch(rf"P\.G::K::attempt-2::SYSTEM::{stamp}", two)), ids.run_id("S") != ids.run_id("S"))]
    return spark.createDataFrame(rows, "run_key string, default_run_key string, run_id_fits boolean, group_id_fits boolean, differ boolean")


@query("env_names", "SELECT * FROM (VALUES ('DEV', 'CLAIMS_DEV_T', 'claims_dev', 'Dev_x', 'mapped_dev'), ('QA', 'CLAIMS_QA_T', 'claims_qa', 'Qa_x', 'RAW'), ('PROD', 'CLAIMS_T', 'claims_', '_x', 'raw_prod'), ('SIT', 'CLAIMS_SIT_T', 'claims_sit', 'Sit_x', 'RAW')) v(environment, upper, lower, title, mapped)")
def _env_names(spark, _):
    rows = []
    for e in ("DEV", "QA", "PROD", "SIT"):
        c = Settings.from_env({"DQ_ENVIRONMENT": e, "DQ_DB_MAP_RAW": "DEV=mapped_dev, PROD=raw_prod"})
        rows.append((e, c.env_tokens("CLAIMS_$ENV_T"), c.env_tokens("claims_$env"), c.env_tokens("$Env_x"), c.database_name("RAW")))
    return spark.createDataFrame(rows, "environment string, upper string, lower string, title string, mapped string")


@query("settings_read", "SELECT 4 AS rules, 3 AS teradata, 1 AS other, 15 AS lookback, 5 AS attempts, false AS multiline, 'meta' AS meta_path")
def _settings(spark, _):
    c = Settings.from_env({"DQ_MAX_PARALLEL_RULES": "4", "DQ_TERADATA_MAX_PARALLEL": "3", "DQ_LOOKBACK_MINUTES": "15", "DQ_QUERY_MAX_RETRIES": "5", "DQ_FILE_MULTILINE": "no", "DQ_META_PATH": "meta"})
    return spark.createDataFrame([(c.max_parallel_rules, c.parallel_for("Teradata"), c.parallel_for("spark"), c.lookback_minutes, c.max_attempts, c.file_multiline, c.meta_path)], "rules int, teradata int, other int, lookback int, attempts int, multiline boolean, meta_path string")


@query("readiness_gate", "SELECT * FROM (VALUES ('NOT_READY', 0), ('COMPLETED', 1), ('NO_RULES', 0), ('INVALID_EXTRA_FILTERS', 1)) v(status, total_rules)")
def _ready(spark, _):
    runner = engine(spark, [_neg(1)])
    settings_.register_readiness("G", lambda run_key, _: run_key != "EARLY")
    try:
        out = [runner.run_group("G", "EARLY"), runner.run_group("G", RUN_KEY), runner.run_group("NONE", RUN_KEY), runner.run_group("G", RUN_KEY, filters={"1 = 1; --": "x"})]
    finally:
        settings_.register_readiness("G", None)
    return spark.createDataFrame([(o["status"], o["total_rules"]) for o in out], "status string, total_rules int")


# The store


@query("store_insert_or_skip", "SELECT c_custkey AS rule_id, CASE WHEN c_custkey % 3 = 0 THEN 'first' ELSE 'second' END AS rule_nm, (SELECT count(*) FROM customer WHERE c_custkey % 3 <> 0) AS inserted FROM customer")
def _insert_or_skip(spark, _):
    """Rows whose key is there are skipped, not replaced; of equal keys in one insert one is taken."""
    store = ms.MetaStore(spark, f"{shared_folder(spark)}/meta-{uuid.uuid4().hex}")
    named = lambda name: spark.table("customer").select(F.col("c_custkey").cast("int").alias("rule_id"), F.lit(name).alias("rule_nm"))
    padded = lambda df: df.select("*", *[F.lit(None).alias(c) for c in ms.RULES.columns if c not in df.columns])
    store.insert_or_skip(ms.RULES, padded(named("first").filter("rule_id % 3 = 0")))
    n = store.insert_or_skip(ms.RULES, padded(named("second").union(named("second"))))
    again = store.insert_or_skip(ms.RULES, padded(named("third")))
    return store.current(ms.RULES).select(F.col("rule_id").cast("long"), "rule_nm", F.lit(n + again).cast("long").alias("inserted"))


@query("store_snapshots", "SELECT i AS rule_id, 'v' || (35 + i) AS rule_nm, 42::BIGINT AS versions FROM range(1, 8) t(i)")
def _snapshots(spark, _):
    """Forty-two appends to seven rows: readers see the last version of each, from a snapshot and the appends after it."""
    store = ms.MetaStore(spark, f"{shared_folder(spark)}/meta-{uuid.uuid4().hex}")
    for i in range(42):
        store.append(ms.RULES, [{"rule_id": i % 7 + 1, "rule_nm": f"v{i + 1}"}], "U")
    return store.current(ms.RULES).select(F.col("rule_id").cast("long"), "rule_nm", F.lit(store.history(ms.RULES).count()).alias("versions"))


@query("exception_columns", "SELECT 'c_custkey=' || c_custkey AS src_key_value, 'rule_1' AS rule_nm, 'G' AS rule_group, 'customer' AS src_tbl_nm, 'P' AS project_name, 'PR' AS process_name, 'spark' AS source_name, 'monthly' AS run_type, true AS dated, NULL::VARCHAR AS last_updated_by FROM customer WHERE c_acctbal < 0")
def _exception_columns(spark, _):
    runner = engine(spark, [_neg(1)])
    runner.run_group("G", RUN_KEY, params={"run_type": "monthly"})
    dated = F.col("record_id").isNotNull() & F.col("load_datetime").isNotNull() & (F.col("etl_load_dt") == F.to_date("load_datetime"))
    return runner.store.current(ms.EXCEPTIONS).select("src_key_value", "rule_nm", "rule_group", "src_tbl_nm", "project_name", "process_name", "source_name", "run_type", dated.alias("dated"), "last_updated_by")


@query("key_build_failure", "SELECT 'KEY_BUILD_FAILURE' AS error_type, 'FAIL' AS status, count(*) AS failed_records FROM customer WHERE c_acctbal < 0")
def _no_key(spark, _):
    """Without key columns no row has a key; the verdict stands."""
    runner = engine(spark, [rule(1, "customer", NEGATIVE["rule_syntax"], "")])
    runner.run_group("G", RUN_KEY)
    return runner.store.current(ms.RULE_ERRORS).join(runner.store.current(ms.RESULTS), "rule_id").select("error_type", "status", "failed_records")


@query("tieback_after_rule_changed", "SELECT 'c_custkey=' || c_custkey AS _src_key_value, c_custkey, c_name FROM customer WHERE c_acctbal < 0")
def _tieback_changed(spark, _):
    """Exceptions tie back by the table and key names they were found with, whatever the rule says now."""
    runner = _limits(spark, 0)
    runner.store.append(ms.RULES, [rule(1, "supplier", "SELECT s_suppkey FROM supplier", "s_suppkey")], "U")
    return reporting.source_records(runner.store, runner.sources, 1, RUN_KEY).select("_src_key_value", "c_custkey", "c_name")


@query("tieback_null_keys", "SELECT 'c_mktsegment=' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'NULL') || '|d=' || (c_custkey / 4.0)::DOUBLE AS _src_key_value, c_custkey FROM customer WHERE c_acctbal < 0")
def _tieback_nulls(spark, _):
    """Null parts and fractional numbers in keys, of a view."""
    spark.sql("SELECT c_custkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, CAST(c_custkey / 4.0 AS DOUBLE) AS d FROM customer").createOrReplaceTempView("keyed_customer")
    runner = engine(spark, [rule(1, "keyed_customer", "SELECT * FROM keyed_customer WHERE c_acctbal < 0", "c_mktsegment,d")])
    runner.run_group("G", RUN_KEY)
    return reporting.source_records(runner.store, runner.sources, 1, RUN_KEY).select("_src_key_value", "c_custkey")


@query("report_csv_file", "SELECT 'c_custkey=' || c_custkey AS _src_key_value, c_custkey, c_name FROM customer WHERE c_acctbal < 0")
def _report_csv(spark, _):
    runner = _limits(spark, 0)
    path = f"{shared_folder(spark)}/report-{uuid.uuid4().hex}.csv"
    reporting.to_csv(reporting.source_records(runner.store, runner.sources, 1, RUN_KEY), path)
    return files.read(spark, path).select("_src_key_value", F.col("c_custkey").cast("long"), "c_name")


@query("sampling_errors", "SELECT * FROM (VALUES ('PULL_FAILURE', 'N'), ('PULL_FAILURE', 'Y')) v(error_type, active_ind)")
def _sampling_errors(spark, _):
    """The errors of an earlier attempt are no longer active."""
    bad = sampler(spark, scope_sql="x = '{missing}'")
    bad.run(1, RUN_KEY)
    bad.run(1, RUN_KEY)
    return bad.store.current(ms.SAMPLING_ERRORS).select("error_type", "active_ind")


@query("sample_fan_out", "SELECT * FROM (VALUES (1, 'COMPLETED', 100), (2, 'COMPLETED', 60)) v(config_id, status, selected)")
def _fan_out(spark, _):
    runner = sampler(spark)
    config = runner.store.current(ms.SAMPLING_CONFIG).first().asDict()
    runner.store.append(ms.SAMPLING_CONFIG, [{**config, "config_id": 2, "target_volume": 60}, {**config, "config_id": 3, "act_ind": 0}])
    out = runner.run_process("PR", RUN_KEY)
    return spark.createDataFrame([(c, o["status"], o["selected"]) for c, o in out.items()], "config_id int, status string, selected int")


@query("mirror_driver", "SELECT * FROM (VALUES ('results', '1', '1'), ('rule_audit', '1', '1'), ('rules', '1', '1')) v(table_name, first_time, second_time)")
def _mirror_driver(spark, _):
    """Whole copies of the small tables, changes within the lookback of the others."""
    runner = engine(spark, [_neg(1)])
    runner.run_group("G", RUN_KEY)
    m = mirror.Mirror(runner.store, ms.MetaStore(spark, f"{shared_folder(spark)}/mirror-{uuid.uuid4().hex}"))
    runs = [m.sync(["results", "rule_audit", "rules"]) for _ in range(2)]
    return spark.createDataFrame([(t, str(runs[0][t]), str(runs[1][t])) for t in runs[0]], "table_name string, first_time string, second_time string")


@query("command_line", "SELECT * FROM (VALUES ('rules', 0), ('nothing given', 1), ('report', 0), ('mirror of no table', 1), ('deploy', 0)) v(command, code)")
def _command_line(spark, _):
    import contextlib
    import io
    import logging

    from . import cli

    store = engine(spark, [_neg(1)]).store
    asked = {"rules": ["rules", "--group", "G", "--run-key", RUN_KEY], "nothing given": ["rules", "--run-key", RUN_KEY], "report": ["report", "--rule-id", "1", "--run-key", RUN_KEY], "mirror of no table": ["mirror", "--target", f"{store.path}-copy", "--tables", "none"], "deploy": ["deploy", "--dry-run"]}
    before, level = logging.getLogger().handlers[:], logging.getLogger().level
    with contextlib.redirect_stdout(io.StringIO()), contextlib.redirect_stderr(io.StringIO()):
        rows = [(name, cli.main(["--meta", store.path, *args], spark=spark)) for name, args in asked.items()]
    logging.getLogger().handlers[:] = before
    logging.getLogger().setLevel(level)
    return spark.createDataFrame(rows, "command string, code int")
