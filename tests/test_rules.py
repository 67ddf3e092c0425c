"""Rules end to end: one rule, groups, reruns, reports."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from verdigris.functions import settings
from verdigris.plans import metastore as ms
from verdigris.plans import reporting
from verdigris.plans.rules import RuleRunner, discover_groups, load_rules, tieback_sql
from verdigris.sources.resolver import SourceResolver

BASE = "SELECT claim_id, denial_reason FROM claims WHERE denial_reason IS NULL AND batch_id = '{batch_id}'"
CLAIMS = [("C1", None, "B1", "MNT"), ("C2", "Not medically necessary", "B1", "MNT"), ("C3", None, "B1", "MNT"), ("C4", "X", "B1", "MNT"), ("C5", None, "B2", "ADHOC")]


def rule(n=1, **more):
    return {"rule_id": n, "rule_nm": f"r{n}", "act_ind": 1, "rule_group": "g", "project_name": "P", "process_name": "PR", "seq_no": n, "sql_dialect": "spark", "src_tbl_nm": "claims", "rule_syntax": BASE, "src_key_cols": "claim_id", **more}


@pytest.fixture
def make(spark, tmp_path):
    def build(*rules, claims=CLAIMS, **config):
        claims_view(spark, claims)
        cfg = settings.Settings(**config)
        store = ms.MetaStore(spark, f"file://{tmp_path}/{uuid.uuid4().hex}")
        store.append(ms.RULES, list(rules))
        return RuleRunner(store, SourceResolver(spark, cfg), cfg)

    return build


def claims_view(spark, rows):
    spark.createDataFrame(rows, "claim_id string, denial_reason string, batch_id string, run_ty string").createOrReplaceTempView("claims")


def run(runner, batch_id="B1", **options):
    return runner.run_group("g", "K", params={"batch_id": batch_id}, **options)


def results(runner, active="Y"):
    return {r["rule_id"]: r for r in runner.store.current(ms.RESULTS).filter(F.col("active_ind") == active).collect()}


def exceptions(runner):
    return {r["src_key_value"]: r for r in runner.store.current(ms.EXCEPTIONS).collect()}


def errors(runner):
    return [(r["rule_id"], r["error_type"]) for r in runner.store.current(ms.RULE_ERRORS).filter("active_ind = 'Y'").orderBy("error_id").collect()]


def test_base(make):
    runner = make(rule())
    out = run(runner)
    assert (out["status"], out["succeeded"], out["errored"], out["results"]) == ("COMPLETED", 1, 0, {1: "SUCCESS"})
    assert out["run_id"].startswith("P.g::K::attempt-1::SYSTEM::")
    r = results(runner)[1]
    assert (r["total_records"], r["failed_records"], r["failure_pct"], r["status"]) == (4, 2, 50.0, "FAIL")
    assert "batch_id = 'B1'" in r["executed_sql"] and "batch_id = 'B1'" in r["source_tieback_sql"]
    assert set(exceptions(runner)) == {"claim_id=C1", "claim_id=C3"}
    audit = runner.store.current(ms.RULE_AUDIT).collect()
    assert len(audit) == 1 and audit[0]["status"] == "COMPLETED" and json.loads(audit[0]["run_params"]) == {"batch_id": "B1"}


def test_duplicates_count_as_failed_but_not_as_exceptions(make):
    runner = make(rule(rule_syntax=f"{BASE} UNION ALL {BASE}"))
    run(runner)
    assert results(runner)[1]["failed_records"] == 4 and len(exceptions(runner)) == 2
    assert errors(runner) == [(1, "KEY_NOT_DISTINCT")]


def test_fixed_and_broken_again(make, spark):
    runner = make(rule())
    run(runner)
    first = exceptions(runner)
    claims_view(spark, [("C1", "ok", "B1", "MNT"), *CLAIMS[1:]])
    second_run = run(runner)
    second = exceptions(runner)
    assert (second["claim_id=C1"]["etl_is_curr_ind"], second["claim_id=C3"]["etl_is_curr_ind"]) == ("N", "Y")
    assert second["claim_id=C3"]["run_id"] == second_run["run_id"] and "attempt-2" in second_run["run_id"]
    claims_view(spark, CLAIMS)
    run(runner)
    third = exceptions(runner)
    assert third["claim_id=C1"]["etl_is_curr_ind"] == "Y"
    assert {k: v["record_id"] for k, v in third.items()} == {k: v["record_id"] for k, v in first.items()}
    assert {k: v["load_datetime"] for k, v in third.items()} == {k: v["load_datetime"] for k, v in first.items()}
    assert len(runner.store.current(ms.RESULTS).filter("active_ind = 'N'").collect()) == 2


def test_clean_rerun_closes_exceptions(make, spark):
    runner = make(rule())
    run(runner)
    claims_view(spark, [(a, "ok", b, c) for a, _, b, c in CLAIMS])
    run(runner)
    assert {r["etl_is_curr_ind"] for r in exceptions(runner).values()} == {"N"}
    assert results(runner)[1]["status"] == "PASS"


def test_errors_by_kind(make):
    runner = make(
        rule(1, rule_syntax="SELECT * FROM no_such_table"), rule(2, rule_syntax="SELECT '{other}'"), rule(3, src_key_cols="nope"), rule(4, src_key_cols=""), rule(5, sql_dialect="oracle"), rule(6, src_tbl_nm="gone"),
        rule(7, rule_syntax="SELECT claim_id FROM claims WHERE CAST(claim_id AS INT) = 1"), rule(8, rule_syntax="DROP VIEW claims"),
    )
    out = run(runner)
    assert out["results"] == {1: "ERROR", 2: "ERROR", 3: "SUCCESS", 4: "SUCCESS", 5: "ERROR", 6: "ERROR", 7: "ERROR", 8: "ERROR"}
    assert errors(runner) == [(1, "SQL_RUNTIME"), (2, "PARAM_SUBSTITUTION_ERROR"), (3, "WRITE_FAILURE"), (4, "KEY_BUILD_FAILURE"), (5, "CONNECTION_UNAVAILABLE"), (6, "SCOPE_QUERY_FAILURE"), (7, "SQL_RUNTIME"), (8, "SQL_RUNTIME")]
    got = results(runner)
    assert got[3]["status"] == "FAIL" and got[3]["failed_records"] == 2 and not exceptions(runner)
    assert all(len(got[i]["error_message"]) <= 2000 and got[i]["status"] == "ERROR" for i in (1, 2, 5, 6, 7, 8))


def test_total_falls_back_to_filters(make):
    runner = make(rule())
    runner.run_group("g", "K", params={"batch_id": "B1", "not_a_column": 1})
    assert results(runner)[1]["total_records"] == 5
    runner.run_group("g", "K", params={"not_a_column": 1}, text_params={"batch_id": "B1"}, filters={"run_ty": "MNT"})
    assert errors(runner) == [(1, "SQL_RUNTIME")]  # the rule's columns lack the filter's


def test_filters_wrap_the_whole_rule(make):
    runner = make(rule(rule_syntax="SELECT claim_id, run_ty FROM claims WHERE denial_reason IS NULL OR batch_id = 'B2'"))
    runner.run_group("g", "K", filters={"run_ty": "ADHOC"})
    r = results(runner)[1]
    assert (r["failed_records"], r["total_records"]) == (1, 1)


def test_invalid_filters_stop_the_run(make):
    runner = make(rule())
    out = run(runner, filters={"a b": 1})
    assert out["status"] == "INVALID_EXTRA_FILTERS" and out["total_rules"] == 1 and not results(runner)


def test_not_ready_and_no_rules(make):
    runner = make(rule())
    settings.register_readiness("g", lambda *_: False)
    try:
        assert run(runner)["status"] == "NOT_READY"
    finally:
        settings.register_readiness("g", None)
    assert runner.run_group("other", "K")["status"] == "NO_RULES"
    assert runner.store.current(ms.RULE_AUDIT).count() == 0


def test_halt(make):
    seq = {"sequencing_mode": "sequential", "on_failure": "halt_group"}
    runner = make(rule(1, **seq), rule(2, rule_syntax="SELECT * FROM nowhere", **seq), rule(3, **seq))
    out = run(runner)
    assert out["status"] == "HALTED" and out["results"] == {1: "SUCCESS", 2: "ERROR"}


@pytest.mark.parametrize("options", [{"batch": True}, {"workers": 3}])
def test_ways_to_run_agree(make, options):
    rules = [rule(1), rule(2, rule_syntax="SELECT * FROM nowhere"), rule(3, src_key_cols="claim_id,batch_id"), rule(4, rule_syntax="SELECT claim_id FROM claims WHERE batch_id = '{batch_id}'", threshold_pct=100.0)]
    plain, other = make(*rules), make(*rules, max_parallel_rules=options.get("workers", 1))
    a, b = run(plain), run(other, batch=options.get("batch", False))
    assert a["results"] == b["results"]
    pick = lambda r: {k: (x["status"], x["failed_records"], x["total_records"]) for k, x in results(r).items()}
    assert pick(plain) == pick(other) and set(exceptions(plain)) == set(exceptions(other))


def test_the_total_is_counted_once(make):
    """Rules that share a table and scope share its count; each rule's keys are another read."""
    runner = make(rule(1), rule(2), rule(3))
    source, loads = runner.sources.get("spark"), []
    load = source.load
    source.load = lambda *a: (loads.append(a), load(*a))[1]
    run(runner)
    assert len(loads) == 1


def test_only_key_columns_are_read(make, spark, tmp_path):
    from verdigris.operators import batch

    spark.range(10).selectExpr("id AS a", "id AS b", "id AS c").write.parquet(f"{tmp_path}/wide")
    spark.read.parquet(f"{tmp_path}/wide").createOrReplaceTempView("wide")
    found = batch.violating_keys(spark, rule(rule_syntax="SELECT * FROM wide WHERE b > 3", src_tbl_nm="wide", src_key_cols="a"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:bigint,b:bigint>" in plan and "GreaterThan(b,3)" in plan


def test_variants_and_groups(make):
    runner = make(rule(1, seq_no=2), rule(2, seq_no=1, rule_variant="A"), rule(3, seq_no=None, rule_variant="B"), rule(4, act_ind=0), rule(5, rule_group="h", project_name="Q"))
    names = lambda v=None: [r["rule_id"] for r in load_rules(runner.store, "g", v)]
    assert names() == [2, 1, 3] and names("A") == [2, 1] and names("") == [2, 1, 3]
    assert discover_groups(runner.store) == ["g", "h"] and discover_groups(runner.store, project="Q") == ["h"]
    out = runner.run_all("K", params={"batch_id": "B1"})
    assert {g: s["total_rules"] for g, s in out.items()} == {"g": 3, "h": 1}
    with pytest.raises(ValueError, match="give"):
        runner.run_scope("K")
    with pytest.raises(ValueError, match="no active"):
        runner.run_scope("K", project="none")
    with pytest.raises(ValueError, match="no active"):
        runner.run_process("none")


def test_env_tokens_reach_rules(make):
    runner = make(rule(rule_syntax="SELECT 'a_$env_b' AS claim_id", database_name="db_$env"), environment="QA")
    loaded = load_rules(runner.store, "g", config=runner.config)[0]
    assert (loaded["rule_syntax"], loaded["database_name"]) == ("SELECT 'a_qa_b' AS claim_id", "db_qa")


def test_many_violations(make, spark):
    runner = make(rule(rule_syntax="SELECT claim_id FROM big_claims", src_tbl_nm="big_claims"))
    spark.range(12000).select(F.concat(F.lit("C"), "id").alias("claim_id")).createOrReplaceTempView("big_claims")
    runner.run_group("g", "K")
    assert runner.store.current(ms.EXCEPTIONS).count() == 12000


def test_tieback_sql_by_dialect():
    r = rule(sql_dialect="teradata", database_name="db", src_key_cols="a,b")
    sql = tieback_sql(r, "K'1", "meta.exceptions", {"batch_id": "B"})
    assert "STRTOK(STRTOK(e.src_key_value, '|', 2), '=', 2)" in sql and "FROM db.claims s" in sql and "e.run_key = 'K''1'" in sql and "s.batch_id = 'B'" in sql
    assert "split_part(e.src_key_value, '=', 2)" in tieback_sql(rule(sql_dialect="postgres"), "K", "e")
    assert tieback_sql(rule(sql_dialect="file"), "K", "e") is None and tieback_sql(rule(src_key_cols=""), "K", "e") is None


def test_tieback_sql_joins_by_equality(spark):
    source = [(1, "x"), (2, "a=b|c"), (3, None), (4, "NULL"), (None, "x"), (5, "a"), (7, ""), (6, "x")]
    spark.createDataFrame(source, "Id int, note string").createOrReplaceTempView("noted")
    wanted = ["Id=1|note=x", "Id=2|note=a=b|c", "Id=3|note=NULL", "Id=4|note=NULL", "Id=NULL|note=x", "Id=5|note=b", "Id=7|note="]
    rows = [(i, 1, "r", "p", "q", k, "Y", run, now) for i, k in enumerate([*wanted, "Id=6|note=x"]) for run, now in (("K", "Y" if k in wanted else "N"), ("other", "Y"))]
    spark.createDataFrame(rows, "record_id long, rule_id int, rule_nm string, process_name string, project_name string, src_key_value string, exception_flag string, run_key string, etl_is_curr_ind string").createOrReplaceTempView("kept")
    got = spark.sql(tieback_sql(rule(1, src_tbl_nm="noted", src_key_cols="Id, note", sql_dialect="spark"), "K", "kept"))
    assert sorted((r["_src_key_value"], r["Id"], r["note"]) for r in got.collect()) == sorted((wanted[i], *source[i]) for i in (0, 1, 2, 4, 6))
    for columns in ("note", "Id, note"):
        plan = spark.sql(tieback_sql(rule(1, src_tbl_nm="noted", src_key_cols=columns, sql_dialect="spark"), "K", "kept"))._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_reports(make, spark):
    runner = make(rule(1, severity="WARN"), rule(2, src_key_cols="claim_id, denial_reason"), rule(3, rule_syntax="SELECT claim_id FROM claims WHERE 1 = 0"))
    out = run(runner)
    assert [(r["rule_id"], r["status"]) for r in reporting.breaches(runner.store, out["run_id"]).collect()] == [(2, "FAIL"), (1, "WARN")]
    rows = reporting.source_records(runner.store, runner.sources, 2, "K").orderBy("claim_id").collect()
    assert [(r["claim_id"], r["_src_key_value"]) for r in rows] == [("C1", "claim_id=C1|denial_reason=NULL"), ("C3", "claim_id=C3|denial_reason=NULL")]
    every = reporting.source_records_for_process(runner.store, runner.sources, "PR", "K")
    assert every.count() == 4 and every.columns[: len(reporting.CONTEXT)] == list(reporting.CONTEXT)
    assert reporting.source_records_for_process(runner.store, runner.sources, "PR", "other").count() == 0
    claims_view(spark, CLAIMS[1:])
    live = reporting.source_records(runner.store, runner.sources, 1, "K")
    assert live.count() == 1
    assert [r["src_key_value"] for r in reporting.missing_keys(reporting.records(runner.store, 1, "K"), live).collect()] == ["claim_id=C1"]
    runner.sources._sources.pop("spark")
    with pytest.raises(RuntimeError, match="not available"):
        reporting.source_records(runner.store, runner.sources, 1, "K")
