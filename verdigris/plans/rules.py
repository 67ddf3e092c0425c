"""Rules: which ones, running one, running groups of them."""

from __future__ import annotations

import datetime as dt
import json
import logging
import threading
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, keys, settings, templating, verdict
from ..operators import violations
from ..sources.resolver import SourceResolver
from . import metastore as ms
from .scratch import scratch

log = logging.getLogger(__name__)
#: Status and error names in results, audits and errors are fixed values, which reports and dashboards read.
#: What analysts can run later against a durable source, by dialect: the n-th part of a key, and the value of a part.
TIEBACK = {
    "teradata": ("STRTOK({0}, '|', {1})", "STRTOK({0}, '=', 2)"),
    "postgres": ("split_part({0}, '|', {1})", "split_part({0}, '=', 2)"),
}


# Catalogue


def load_rules(store: ms.MetaStore, group: str, variant: str | None = None, config: settings.Settings | None = None) -> list[dict]:
    """Active rules of a group by seq_no, nulls last, then rule_id; with a variant, those without one or of it."""
    df = store.current(ms.RULES).filter((F.col("rule_group") == group) & (F.col("act_ind") == 1))
    if variant:
        df = df.filter(F.col("rule_variant").isNull() | (F.col("rule_variant") == variant))
    config = config or settings.Settings()
    rules = [r.asDict() for r in df.orderBy(F.asc_nulls_last("seq_no"), "rule_id").collect()]
    for r in rules:
        r["database_name"] = config.database_name(r["database_name"])
        r["rule_syntax"] = config.env_tokens(r["rule_syntax"])
    return rules


def discover_groups(store: ms.MetaStore, project: str | None = None, process: str | None = None) -> list[str]:
    df = store.current(ms.RULES).filter("act_ind = 1")
    for column, value in (("project_name", project), ("process_name", process)):
        if value:
            df = df.filter(F.col(column) == value)
    return [r[0] for r in df.select("rule_group").distinct().orderBy("rule_group").collect()]


# One rule


@dataclass
class RunContext:
    store: ms.MetaStore
    sources: SourceResolver
    run_id: str
    run_key: str
    params: dict = field(default_factory=dict)
    filters: dict = field(default_factory=dict)
    text_params: dict = field(default_factory=dict)
    totals: violations.Totals = field(default_factory=violations.Totals)


def tieback_sql(rule: Mapping, run_key: str, exceptions: str, scope: Mapping[str, object] | None = None) -> str | None:
    """SQL text that joins the rule's live source rows with its current exceptions.

    None for dialects without a durable source, and without key columns.
    """
    dialect = (rule.get("sql_dialect") or "").lower()
    columns = keys.split_columns(rule.get("src_key_cols"))
    if dialect not in (*TIEBACK, "spark") or not columns:
        return None
    if dialect == "spark":
        # One equality: with a choice of two in the join, Spark compares every row with every exception.
        parts = [f"'{'|' * (i > 0)}{templating.escape(c)}=', COALESCE(CAST(s.{c} AS STRING), '{keys.NULL_KEY}')" for i, c in enumerate(columns)]
        on = [f"e.src_key_value = CONCAT({', '.join(parts)})", *(f"(s.{c} IS NULL OR CAST(s.{c} AS STRING) <> '{keys.NULL_KEY}')" for c in columns)]
    else:
        part, value = TIEBACK[dialect]
        on = []
        for i, c in enumerate(columns, 1):
            v = value.format(part.format("e.src_key_value", i) if len(columns) > 1 else "e.src_key_value")
            on.append(f"(({v} = '{keys.NULL_KEY}' AND s.{c} IS NULL) OR ({v} <> '{keys.NULL_KEY}' AND s.{c} = {v}))")
    source = ".".join(x for x in (rule.get("database_name"), rule.get("src_tbl_nm")) if x)
    where = [f"e.rule_id = {rule['rule_id']}", f"e.run_key = '{templating.escape(run_key)}'", "e.etl_is_curr_ind = 'Y'", *templating.equalities(scope or {}, "s.")]
    about = ("record_id", "rule_id", "rule_nm", "process_name", "project_name", "src_key_value", "exception_flag")
    return f"SELECT s.*, {', '.join(f'e.{c} AS _{c}' for c in about)}\nFROM {source} s\nJOIN {exceptions} e\n  ON {' AND '.join(on)}\nWHERE {' AND '.join(where)}"


class RuleExecutor:
    """Runs rules: scan, denominator, reconciliation, verdict.

    The source is scanned once for a rule: its keys and their numbers of rows
    are written down, and everything after reads those.
    """

    def __init__(self, ctx: RunContext):
        self.ctx, self.store, self.spark = ctx, ctx.store, ctx.store.spark

    def error(self, rule: Mapping, kind: str, message: object, detail: str | None = None) -> None:
        """An error row; never raises."""
        try:
            self.store.append(ms.RULE_ERRORS, [{
                "error_id": self.store.next_seq(), "run_id": self.ctx.run_id, "rule_id": rule.get("rule_id"), "rule_group": rule.get("rule_group"), "rule_variant": rule.get("rule_variant"),
                "run_key": self.ctx.run_key, "error_type": kind, "error_message": ms.short(message), "error_detail": detail, "active_ind": "Y", "occurred_at": ms.now(),
            }])
        except Exception:
            log.exception("rule %s: the error could not be recorded", rule.get("rule_id"))

    def result_row(self, rule: Mapping, start: dt.datetime, status: str, **values: object) -> dict:
        named = ("rule_id", "rule_group", "rule_variant", "project_name", "process_name", "seq_no", "severity")
        return {
            "result_id": self.store.next_seq(), "run_id": self.ctx.run_id, "run_key": self.ctx.run_key, **{c: rule.get(c) for c in named}, "start_time": start, "end_time": ms.now(),
            "status": status, "failed_records": 0, "active_ind": "Y", "load_datetime": ms.now(), **values,
        }

    def result(self, rule: Mapping, start: dt.datetime, status: str, **values: object) -> None:
        self.store.append(ms.RESULTS, [self.result_row(rule, start, status, **values)])

    def result_if_possible(self, rule: Mapping, start: dt.datetime, status: str, **values: object) -> None:
        try:
            self.result(rule, start, status, **values)
        except Exception:
            log.exception("rule %s: the result could not be written", rule.get("rule_id"))

    def query(self, rule: Mapping) -> str:
        """The rule's SQL with filters and parameters; ValueError if they do not fit."""
        return self._filled(self._filtered(rule))

    def _filtered(self, rule: Mapping) -> str:
        return templating.with_filters(rule["rule_syntax"], templating.filters_clause(self.ctx.filters))

    def _filled(self, sql: str) -> str:
        return templating.substitute(sql, {**self.ctx.params, **self.ctx.text_params})

    def scan(self, rule: Mapping, query: str) -> tuple[int, DataFrame | None, Exception | None]:
        """How many rows fail, their keys (src_key_value, n), and why there are no keys if there are none."""
        rows = violations.rule_rows(self.spark, query)
        try:
            plan = violations.keyed(rows, keys.split_columns(rule.get("src_key_cols")))
        except (KeyError, ValueError) as e:
            return rows.count(), None, e
        found = scratch(plan, "violations")
        return int(found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]), found, None

    def total(self, rule: Mapping) -> tuple[int, dict]:
        """The denominator and the scope it holds for; without the run's parameters if they are no columns."""
        source, ctx = self.ctx.sources.get(rule.get("sql_dialect")), self.ctx
        asked = (source, (rule.get("sql_dialect") or "spark").lower(), rule.get("database_name"), rule["src_tbl_nm"])
        scope = {**ctx.params, **ctx.filters}
        try:
            return ctx.totals.count(*asked, scope), scope
        except Exception as e:
            total = ctx.totals.count(*asked, dict(ctx.filters))
            log.warning("rule %s: parameters %s do not scope its table (%s); counted by filters only", rule.get("rule_id"), sorted(ctx.params), type(e).__name__)
            return total, dict(ctx.filters)

    def run(self, rule: Mapping) -> str:
        """SUCCESS, whatever the verdict, or ERROR.  One result row is written in any case."""
        start, ctx = ms.now(), self.ctx

        def fail(kind: str, e: Exception, sql: str | None, **values: object) -> str:
            log.error("rule %s: %s: %s", rule.get("rule_id"), kind, type(e).__name__)
            self.error(rule, kind, e)
            self.result_if_possible(rule, start, "ERROR", error_message=ms.short(e), executed_sql=sql, **values)
            return "ERROR"

        source = ctx.sources.get(rule.get("sql_dialect"))
        try:
            source.prepare(rule.get("database_name"), rule["src_tbl_nm"])
        except Exception as e:
            return fail("SOURCE_PREPARE_ERROR", e, rule["rule_syntax"])
        try:
            templated = self._filtered(rule)
        except ValueError as e:
            return fail("PARAM_SUBSTITUTION_ERROR", e, rule["rule_syntax"])
        try:
            query = self._filled(templated)
        except ValueError as e:
            return fail("PARAM_SUBSTITUTION_ERROR", e, templated)
        try:
            failed, found, no_keys = self.scan(rule, query)
        except Exception as e:
            return fail("SQL_RUNTIME", e, query)
        try:
            total, scope = self.total(rule)
        except Exception as e:
            return fail("SCOPE_QUERY_FAILURE", e, query)
        try:
            self.reconcile(rule, failed, found, no_keys)
        except Exception as e:  # the verdict stands
            log.warning("rule %s: exceptions were not reconciled: %s", rule.get("rule_id"), type(e).__name__)
            self.error(rule, "WRITE_FAILURE", e)
        values = self.judged(rule, query, failed, total, scope)
        if not values.pop("write_result"):
            self.result_if_possible(rule, start, **values)
            return "SUCCESS"
        try:
            self.result(rule, start, **values)
        except Exception as e:
            return fail("RESULTS_WRITE_FAILURE", e, query, failed_records=failed)
        log.info("rule %s: %d of %d failed, %s", rule.get("rule_id"), failed, total, values["status"])
        return "SUCCESS"

    def judged(self, rule: Mapping, query: str, failed: int, total: int, scope: Mapping) -> dict:
        """What the result row says, and whether it must be written."""
        v = verdict.evaluate(total, failed, rule.get("threshold_pct"), rule.get("threshold_count"), rule.get("threshold_operator"), rule.get("severity"))
        return {
            "write_result": v.write_result, "status": v.status, "total_records": total, "failed_records": failed, "failure_pct": verdict.failure_pct(total, failed), "executed_sql": query,
            "source_tieback_sql": tieback_sql(rule, self.ctx.run_key, "exceptions", scope) if failed else None,
            "threshold_pct_used": v.pct_used, "threshold_count_used": v.count_used, "threshold_operator_used": v.operator_used,
        }

    def reconcile(self, rule: Mapping, failed: int, found: DataFrame | None, no_keys: Exception | None = None) -> dict[str, int]:
        """Exceptions on record brought in line with the keys found; how many were inserted, reactivated, deactivated.

        A missing key column raises if there are rows; without any key columns
        no row has a key.  Neither these errors nor duplicate keys change the
        verdict.
        """
        if isinstance(no_keys, KeyError):
            if failed:
                raise no_keys
        elif no_keys is not None and failed:
            self.error(rule, "KEY_BUILD_FAILURE", f"{failed}/{failed} violating rows have no key: {no_keys}")
        if found is None:
            found = self.spark.createDataFrame([], "src_key_value string, n long")
        elif (distinct := found.count()) < failed:
            self.error(rule, "KEY_NOT_DISTINCT", f"{failed - distinct} rows share a key with another: {distinct} keys of {failed} rows")
        return self.reconcile_all([rule], found.withColumn("rule_id", F.lit(rule["rule_id"]))).get(rule["rule_id"], {"inserted": 0, "reactivated": 0, "deactivated": 0})

    def reconcile_all(self, rules: list[Mapping], found: DataFrame) -> dict[int, dict[str, int]]:
        """The same for the keys (rule_id, src_key_value) of several rules, in one join and one append."""
        ctx, when = self.ctx, ms.now()
        here = (F.col("run_key") == ctx.run_key) & F.col("rule_id").isin([r["rule_id"] for r in rules])
        acted = violations.actions(self.store.current(ms.EXCEPTIONS, here), found, ("rule_id", "src_key_value")).filter("action != 'KEEP'")
        about = ("rule_nm", "rule_group", "rule_variant", "database_name", "src_tbl_nm", "project_name", "process_name", "element_name", "dgr_nbr", "universe_version")
        given = [(r["rule_id"], *(r.get(c) for c in about), r.get("sql_dialect"), ctx.params.get("run_type"), ctx.params.get("batch_schedule")) for r in rules]
        about = (*about, "source_name", "run_type", "batch_schedule")
        known = self.spark.createDataFrame([(g[0], *(None if v is None else str(v) for v in g[1:])) for g in given], ", ".join(["rule_id int", *(f"_{c} string" for c in about)]))
        acted = acted.join(F.broadcast(known), "rule_id")  # a row for each rule of the group
        new, gone = F.col("action") == "INSERT", F.col("action") == "DEACTIVATE"
        now_, today = F.lit(when).cast("timestamp_ntz"), F.lit(when.date())
        changed = acted.withColumns({
            "record_id": F.coalesce("record_id", F.xxhash64("rule_id", F.lit(ctx.run_key), "src_key_value").bitwiseAND(F.lit((1 << 63) - 1))), "run_key": F.lit(ctx.run_key),
            **{c: F.when(new, F.col(f"_{c}")).otherwise(F.col(c)) for c in about},
            "run_id": F.when(gone, F.col("run_id")).otherwise(ctx.run_id), "etl_is_curr_ind": F.when(gone, "N").otherwise("Y"),
            "etl_load_dt": F.when(new, today).otherwise(F.col("etl_load_dt")), "load_datetime": F.when(new, now_).otherwise(F.col("load_datetime")),
            "etl_last_updt_dt": F.when(~new, today), "last_updated_datetime": F.when(~new, now_), "last_updated_by": F.when(~new, ctx.run_id),
        })
        changed = scratch(changed.select("action", *ms.EXCEPTIONS.columns), "reconciled")
        counts: dict[int, dict[str, int]] = {}
        for r in changed.groupBy("rule_id", "action").count().collect():
            counts.setdefault(r["rule_id"], {"inserted": 0, "reactivated": 0, "deactivated": 0})[{"INSERT": "inserted", "REACTIVATE": "reactivated"}.get(r["action"], "deactivated")] = r["count"]
        if counts:
            self.store.append(ms.EXCEPTIONS, changed, "U")
        return counts


# Groups


class RuleRunner:
    """Runs groups of rules against one store and its sources."""

    def __init__(self, store: ms.MetaStore, sources: SourceResolver, config: settings.Settings | None = None):
        self.store, self.sources, self.config = store, sources, config or sources.settings
        self.spark: SparkSession = store.spark

    def attempts(self, run_key: str, group: str) -> int:
        return self.store.current(ms.RULE_AUDIT).filter((F.col("run_key") == run_key) & (F.col("rule_group") == group)).count()

    def _deactivate_earlier(self, group: str, run_key: str, run_id: str) -> None:
        """What earlier attempts at this run left active is no more; each table by itself, and never raising."""
        when = F.lit(ms.now()).cast("timestamp_ntz")
        for table, flag, by in ((ms.RESULTS, "active_ind", {}), (ms.RULE_ERRORS, "active_ind", {}), (ms.EXCEPTIONS, "etl_is_curr_ind", {"last_updated_by": run_id})):
            try:
                where = F.col("run_key") == run_key if table.partition else None
                old = self.store.current(table, where).filter((F.col("rule_group") == group) & (F.col("run_key") == run_key) & (F.col("run_id") != run_id) & (F.col(flag) == "Y"))
                if not old.isEmpty():
                    self.store.change(table, scratch(old, "earlier"), **{flag: "N", "last_updated_datetime": when}, **by)
            except Exception:
                log.exception("group %s: earlier rows of %s stay active", group, table.name)

    def run_group(self, group: str, run_key: str | None = None, triggered_by: str = "SYSTEM", params: Mapping | None = None, variant: str | None = None, filters: Mapping | None = None, text_params: Mapping | None = None, batch: bool = False) -> dict:
        """Runs a group's rules in order, or side by side if it allows that; returns a summary.

        batch: rules that analyse run together, a job for each step instead of
        for each rule; the others, and all if a joint step fails, one by one.
        """
        run_key = run_key or ids.default_run_key()
        none = {"run_id": None, "total_rules": 0, "succeeded": 0, "errored": 0, "results": {}}
        if not settings.is_ready(group, run_key, self.spark):
            return {**none, "status": "NOT_READY"}
        rules = load_rules(self.store, group, variant, self.config)
        if not rules:
            return {**none, "status": "NO_RULES"}
        try:
            templating.filters_clause(filters)
        except ValueError as e:
            return {**none, "status": "INVALID_EXTRA_FILTERS", "total_rules": len(rules), "error": str(e)}
        first = rules[0]
        if any((r["project_name"], r["process_name"]) != (first["project_name"], first["process_name"]) for r in rules):
            log.warning("group %s: rules of several projects or processes; audited as those of rule %s", group, first["rule_id"])
        modes = {(r["sequencing_mode"] or "independent").lower() for r in rules}
        if len(modes) > 1:
            log.warning("group %s: rules of several sequencing modes; that of rule %s holds", group, first["rule_id"])
        sequential = (first["sequencing_mode"] or "independent").lower() == "sequential"
        run_id = ids.group_run_id(first["project_name"], group, run_key, self.attempts(run_key, group) + 1, triggered_by)
        as_json = lambda d: json.dumps(d, default=str) if d else None
        audit = {
            "run_id": run_id, "rule_group": group, "rule_variant": variant, "project_name": first["project_name"], "process_name": first["process_name"], "run_key": run_key,
            "run_params": as_json({**(params or {}), **(text_params or {})}), "extra_filters": as_json(dict(filters or {})), "started_at": ms.now(), "status": "RUNNING",
            "total_rules": len(rules), "triggered_by": triggered_by, "load_datetime": ms.now(),
        }
        self.store.append(ms.RULE_AUDIT, [audit])
        self._deactivate_earlier(group, run_key, run_id)
        totals = violations.Totals(self.config.max_attempts, self.config.retry_wait)
        ctx = RunContext(self.store, self.sources, run_id, run_key, dict(params or {}), dict(filters or {}), dict(text_params or {}), totals)
        executor = RuleExecutor(ctx)
        results = self._run_together(executor, rules) if batch and not sequential else {}
        rest, halted = [r for r in rules if r["rule_id"] not in results], False
        workers = min(self.config.max_parallel_rules, len(rest))
        if sequential or workers < 2:
            for r in rest:
                results[r["rule_id"]] = self._run_one(executor, r)
                if sequential and results[r["rule_id"]] == "ERROR" and (r["on_failure"] or "").lower() == "halt_group":
                    halted = True
                    break
        else:
            results |= self._side_by_side(executor, rest, workers)
        good = sum(s == "SUCCESS" for s in results.values())
        status = "HALTED" if halted else "COMPLETED"
        done = {"status": status, "ended_at": ms.now(), "rules_succeeded": good, "rules_errored": len(results) - good}
        self.store.append(ms.RULE_AUDIT, [{**audit, **done}], "U")
        return {"run_id": run_id, "status": status, "total_rules": len(rules), "succeeded": good, "errored": len(results) - good, "results": results}

    def _run_one(self, executor: RuleExecutor, rule: dict) -> str:
        if self.sources.live(rule["sql_dialect"]) is None:
            message = f"no source {rule['sql_dialect']!r}"
            executor.error(rule, "CONNECTION_UNAVAILABLE", message)
            executor.result_if_possible(rule, ms.now(), "ERROR", error_message=message, executed_sql=rule["rule_syntax"])
            return "ERROR"
        return executor.run(rule)

    def _side_by_side(self, executor: RuleExecutor, rules: list[dict], workers: int) -> dict:
        """Jobs of several rules at once, each in a scheduler pool of its source, so many of one source as it allows."""
        gates = {}
        for r in rules:
            name = (r["sql_dialect"] or "spark").lower()
            gates.setdefault(name, threading.Semaphore(max(self.config.parallel_for(name), workers if name == "spark" else 1)))

        def run(rule: dict) -> tuple[int, str]:
            name = (rule["sql_dialect"] or "spark").lower()
            with gates[name]:
                self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
                return rule["rule_id"], self._run_one(executor, rule)

        with ThreadPoolExecutor(workers) as pool:
            return dict(pool.map(inheritable_thread_target(self.spark)(run), rules))

    def _run_together(self, executor: RuleExecutor, rules: list[dict]) -> dict[int, str]:
        """Rules whose SQL analyses, in one job for keys, one for each table's total, one for exceptions, one for results.

        What is left out here runs, and fails or not, on its own.
        """
        parts, asked, ctx, start = [], {}, executor.ctx, ms.now()
        scope = {**ctx.params, **ctx.filters}
        for r in rules:
            try:
                source = self.sources.get(r["sql_dialect"])
                source.prepare(r["database_name"], r["src_tbl_nm"])
                query = executor.query(r)
                rows = violations.rule_rows(self.spark, query)
                parts.append(violations.keyed(rows, keys.split_columns(r["src_key_cols"])).select(F.lit(r["rule_id"]).alias("rule_id"), "src_key_value", "n"))
                asked[r["rule_id"]] = r, query
            except Exception:
                log.info("rule %s is not part of the batch", r["rule_id"])
        try:
            if not parts:
                return {}
            found = scratch(reduce(DataFrame.unionByName, parts), "violations")
            sums = {x["rule_id"]: x for x in found.groupBy("rule_id").agg(F.sum("n").alias("failed"), F.count("*").alias("distinct")).collect()}
            for t in {((r["sql_dialect"] or "spark").lower(), r["database_name"], r["src_tbl_nm"]) for r, _ in asked.values()}:
                ctx.totals.count_together(self.sources.get(t[0]), *t, [scope])
            judged = {}
            for rule_id, (r, query) in asked.items():
                failed = sums[rule_id]["failed"] if rule_id in sums else 0
                judged[rule_id] = r, executor.judged(r, query, failed, *executor.total(r)), failed - (sums[rule_id]["distinct"] if rule_id in sums else 0)
            executor.reconcile_all([r for r, *_ in judged.values()], found)
        except Exception:
            log.warning("the rules of group %s run one by one", rules[0]["rule_group"])
            return {}
        for r, _, repeated in judged.values():
            if repeated:
                executor.error(r, "KEY_NOT_DISTINCT", f"{repeated} rows share a key with another: {sums[r['rule_id']]['distinct']} keys of {sums[r['rule_id']]['failed']} rows")
        self.store.append(ms.RESULTS, [executor.result_row(r, start, **{k: v for k, v in values.items() if k != "write_result"}) for r, values, _ in judged.values()])
        return dict.fromkeys(judged, "SUCCESS")

    def run_groups(self, groups: list[str], run_key: str | None = None, **options: object) -> dict[str, dict]:
        run_key = run_key or ids.default_run_key()  # one for all
        return {g: self.run_group(g, run_key, **options) for g in groups}

    def run_all(self, run_key: str | None = None, project: str | None = None, process: str | None = None, **options: object) -> dict[str, dict]:
        return self.run_groups(discover_groups(self.store, project, process), run_key, **options)

    def run_process(self, process: str, run_key: str | None = None, project: str | None = None, **options: object) -> dict[str, dict]:
        if not (groups := discover_groups(self.store, project, process)):
            raise ValueError(f"no active rules for process {process!r}")
        return self.run_groups(groups, run_key, **options)

    def run_scope(self, run_key: str | None = None, project: str | None = None, process: str | None = None, group: str | None = None, **options: object) -> dict[str, dict]:
        """A group, or all groups of a project and process; at least one of them must be given and match."""
        if not (project or process or group):
            raise ValueError("give a project, a process or a group")
        groups = [group] if group else discover_groups(self.store, project, process)
        if not groups:
            raise ValueError(f"no active rules for project {project!r}, process {process!r}")
        return self.run_groups(groups, run_key, **options)
