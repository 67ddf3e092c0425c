"""The metadata store, its mirror, and the command line."""

import datetime as dt
import json
import logging

import pytest

from verdigris import cli
from verdigris.plans import metastore as ms
from verdigris.plans.mirror import EPOCH, Mirror
from verdigris.streaming.mirror import follow


@pytest.fixture
def store(spark, tmp_path):
    return ms.MetaStore(spark, f"file://{tmp_path}/meta")


@pytest.fixture
def target(spark, tmp_path):
    return ms.MetaStore(spark, f"file://{tmp_path}/copy")


def audit(run_id, status="COMPLETED", when=dt.datetime(2026, 8, 1)):
    return {"run_id": run_id, "rule_group": "g", "run_key": "K", "status": status, "load_datetime": when}


def test_versions(store):
    assert store.current(ms.RULES).count() == 0
    store.append(ms.RULES, [{"rule_id": 1, "rule_nm": "a"}, {"rule_id": 2, "rule_nm": "b"}])
    store.append(ms.RULES, [{"rule_id": 1, "rule_nm": "c"}], "U")
    assert {(r.rule_id, r.rule_nm) for r in store.current(ms.RULES).collect()} == {(1, "c"), (2, "b")}
    assert store.history(ms.RULES).count() == 3
    store.compact(ms.RULES)
    assert store.history(ms.RULES).count() == 2 and {r.rule_nm for r in store.current(ms.RULES).collect()} == {"b", "c"}


def test_insert_or_skip(store):
    rows = lambda *names: [{"rule_id": i, "rule_nm": n} for i, n in enumerate(names)]
    assert store.insert_or_skip(ms.RULES, rows("a", "b")) == 2
    assert store.insert_or_skip(ms.RULES, rows("x", "y", "c", "d")) == 2
    assert store.insert_or_skip(ms.RULES, rows("x", "y", "c", "d")) == 0
    assert sorted((r.rule_id, r.rule_nm) for r in store.current(ms.RULES).collect()) == [(0, "a"), (1, "b"), (2, "c"), (3, "d")]
    twice = [{"run_key": None, "rule_id": 1, "src_key_value": "k"}] * 2
    assert store.insert_or_skip(ms.EXCEPTIONS, twice) == 1 and store.insert_or_skip(ms.EXCEPTIONS, twice) == 0


def test_reading_does_not_grow_with_appends(store, spark, monkeypatch):
    monkeypatch.setattr(ms, "SNAPSHOT_EVERY", 8)
    for i in range(60):
        store.append(ms.RULES, [{"rule_id": i % 5, "rule_nm": str(i)}], "U")
        if i in (30, 59):
            assert len(store.current_versions(ms.RULES).inputFiles()) <= 12
    assert {(r.rule_id, r.rule_nm) for r in store.current(ms.RULES).collect()} == {(i % 5, str(i)) for i in range(55, 60)}
    assert store.history(ms.RULES).count() == 60
    # Another reader, who knows nothing yet, sees the same; so does one after compaction.
    other = ms.MetaStore(spark, store.path)
    assert other.current(ms.RULES).count() == 5
    store.compact(ms.RULES)
    store.append(ms.RULES, [{"rule_id": 0, "rule_nm": "last"}], "U")
    assert other.history(ms.RULES).count() == 6 and other.current(ms.RULES).filter("rule_nm = 'last'").count() == 1


def test_partitions_survive_snapshots(store, monkeypatch):
    monkeypatch.setattr(ms, "SNAPSHOT_EVERY", 2)
    for k in ("A", "B", "A"):
        store.append(ms.EXCEPTIONS, [{"rule_id": 1, "run_key": k, "src_key_value": "x", "etl_is_curr_ind": "Y"}], "U")
    found = store.current(ms.EXCEPTIONS, "run_key = 'A'")
    assert found.count() == 1 and store.current(ms.EXCEPTIONS).count() == 2


def test_lost_jobs_change_nothing(store, target, monkeypatch, tmp_path):
    """An append without its mark of success, and a whole copy that dies before its list is written, are not there."""
    m = Mirror(store, target)
    store.append(ms.RULES, [{"rule_id": 1}])
    m.sync(["rules"])
    store.append(ms.RULES, [{"rule_id": 2}])
    (tmp_path / "meta" / "rules" / "_seq=99").mkdir()
    assert store.current(ms.RULES).count() == 2
    make = ms.MetaStore._at

    def dies(self, path):
        if path.endswith("_manifest") and "copy" in path and ".snapshot-" in path and not dies.done:
            dies.done = True
            raise OSError("lost")
        return make(self, path)

    dies.done = False
    before = [r.rule_id for r in target.current(ms.RULES).collect()]
    monkeypatch.setattr(ms.MetaStore, "_at", dies)
    target._snapshots.clear()
    with pytest.raises(OSError, match="lost"):
        target._snapshot(ms.RULES, store.current_versions(ms.RULES), set(), True)
    assert dies.done
    assert [r.rule_id for r in target.current(ms.RULES).collect()] == before == [1]
    assert m.sync(["rules"]) == {"rules": 2} and target.current(ms.RULES).count() == 2


def test_a_batch_that_comes_again(store, target, tmp_path):
    store.append(ms.RULES, [{"rule_id": 1, "rule_nm": "a"}])
    for n in range(2):  # progress is lost, so the same append comes twice
        follow(store, target, ms.RULES, f"file://{tmp_path}/progress{n}", once=True).awaitTermination()
    assert target.history(ms.RULES).count() == 1


def test_create_all(store):
    assert len(store.create_all(dry_run=True)) == 12
    store.create_all()
    assert store.current(ms.EXCEPTIONS).count() == 0
    store.append(ms.RULES, [{"rule_id": 1}])
    store.create_all(drop_first=True)
    assert store.current(ms.RULES).count() == 0


def test_incremental_mirror(store, target):
    m = Mirror(store, target)
    store.append(ms.RULE_AUDIT, [audit("a"), audit("b", "RUNNING"), audit("n", when=None)])
    assert m.sync(["rule_audit"]) == {"rule_audit": 2}
    assert m.watermark(ms.RULE_AUDIT) == dt.datetime(2026, 8, 1)
    store.append(ms.RULE_AUDIT, [audit("b", "HALTED", dt.datetime(2026, 7, 1)), audit("c", when=dt.datetime(2026, 7, 31, 23, 30)), audit("old", when=dt.datetime(2026, 7, 30))])
    assert m.sync(["rule_audit"]) == {"rule_audit": 2}  # a again and c, within the hour of lookback; b has closed with an old mark
    assert {(r.run_id, r.status) for r in target.current(ms.RULE_AUDIT).collect()} == {("a", "COMPLETED"), ("b", "RUNNING"), ("c", "COMPLETED")}
    assert m.watermark(ms.RULE_AUDIT) == dt.datetime(2026, 8, 1)


def test_full_refresh_mirror(store, target):
    m = Mirror(store, target)
    store.append(ms.RULES, [{"rule_id": 1}, {"rule_id": 2}])
    assert m.sync(["rules"], dry_run=True) == {"rules": 2} and target.current(ms.RULES).count() == 0
    m.sync(["rules"])
    store.create_all(drop_first=True)
    store.append(ms.RULES, [{"rule_id": 3}])
    assert m.sync(["rules"]) == {"rules": 1}
    assert [r.rule_id for r in target.current(ms.RULES).collect()] == [3]
    assert m.watermark(ms.EXCEPTIONS) == EPOCH
    with pytest.raises(ValueError, match="no table"):
        m.sync(["nope"])


def test_stream(store, target, tmp_path):
    for n in (1, 2):
        store.append(ms.RULES, [{"rule_id": 1, "rule_nm": f"v{n}"}])
        follow(store, target, ms.RULES, f"file://{tmp_path}/progress", once=True).awaitTermination()
    assert target.history(ms.RULES).count() == 2 and target.current(ms.RULES).first()["rule_nm"] == "v2"


def test_pairs():
    assert cli.pairs(["a=1", "b=x=y", "c="]) == {"a": "1", "b": "x=y", "c": ""}
    assert cli.pairs(None) == {}
    with pytest.raises(ValueError, match="KEY=VALUE"):
        cli.pairs(["a"])


@pytest.fixture
def command(spark, store, capsys, monkeypatch, tmp_path):
    monkeypatch.chdir(tmp_path)

    def run(*args):
        code = cli.main(["--meta", store.path, *args], spark=spark)
        logging.getLogger().handlers.clear()
        return code, capsys.readouterr()

    return run


def test_commands(command, store, spark, tmp_path):
    spark.createDataFrame([("O1", 1, -5), ("O1", 2, 10), ("O2", 1, -1)], "order_id string, line_no int, qty int").createOrReplaceTempView("order_lines")
    code, out = command("deploy", "--dry-run")
    assert code == 0 and "exceptions:" in out.out
    store.append(ms.RULES, [{"rule_id": 1, "act_ind": 1, "rule_group": "g", "process_name": "PR", "sql_dialect": "spark", "src_tbl_nm": "order_lines", "rule_syntax": "SELECT order_id, line_no FROM order_lines WHERE qty < {least}", "src_key_cols": "order_id,line_no"}, {"rule_id": 2, "act_ind": 1, "rule_group": "g", "process_name": "PR", "sql_dialect": "spark", "src_tbl_nm": "order_lines", "rule_syntax": "SELECT * FROM nowhere", "src_key_cols": "x"}])
    code, out = command("rules", "--process", "PR", "--run-key", "K", "--text-param", "least=0")
    assert code == 0 and json.loads(out.out)["g"]["results"] == {"1": "SUCCESS", "2": "ERROR"}
    assert command("rules", "--group", "g", "--run-key", "K", "--text-param", "least=0", "--strict", "--batch")[0] == 1
    assert command("rules", "--run-key", "K")[0] == 1
    assert command("rules", "--group", "g", "--param", "broken")[0] == 1
    code, out = command("report", "--rule-id", "1", "--run-key", "K")
    lines = out.out.strip().splitlines()
    assert code == 0 and len(lines) == 3 and lines[0].startswith("_record_id,_rule_id")
    assert command("report", "--process", "PR", "--run-key", "K", "--output", f"{tmp_path}/rows.csv")[0] == 0
    assert len((tmp_path / "rows.csv").read_text().splitlines()) == 3
    code, out = command("report", "--rule-id", "1", "--run-key", "NONE", "--output", f"{tmp_path}/none.csv")
    assert code == 0 and "nothing to write" in out.err and not (tmp_path / "none.csv").exists()
    code, out = command("mirror", "--target", f"file://{tmp_path}/copy", "--tables", "rules", "results")
    assert code == 0 and json.loads(out.out) == {"rules": 2, "results": 4}
    assert command("mirror", "--target", f"file://{tmp_path}/copy", "--tables", "none")[0] == 1


def test_sampling_command(command, store, spark):
    spark.range(50).createOrReplaceTempView("few")
    store.append(ms.SAMPLING_CONFIG, [{"config_id": 4, "act_ind": 1, "process_name": "S", "source_type": "spark", "universe_table": "few", "key_columns": "id", "target_volume": 5, "sampling_method": "SYSTEMATIC", "priority_rank_sql": "id"}])
    code, out = command("sampling", "--process", "S", "--run-key", "K", "--seed", "3")
    assert code == 0 and json.loads(out.out)["4"]["selected"] == 5
    assert command("sampling", "--run-key", "K")[0] == 1
