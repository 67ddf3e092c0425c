"""The pure functions: templating, keys, verdicts, quotas, names, settings."""

import datetime as dt
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from verdigris.functions import ids, keys, quota, settings, templating, verdict


class TestTemplating:
    def test_both_spellings(self):
        assert templating.substitute("a = '{x}' AND b = '$y' AND c = {x}$y", {"x": 1, "y": "b"}) == "a = '1' AND b = 'b' AND c = 1b"

    def test_word_boundary(self):
        with pytest.raises(ValueError, match="batch_id2"):
            templating.substitute("$batch_id2", {"batch_id": 1})

    @pytest.mark.parametrize(("value", "text"), [(None, ""), ("O'Brien", "O''Brien"), ("a\\t", "a\\\\t"), (3, "3")])
    def test_values(self, value, text):
        assert templating.substitute("{v}", {"v": value}) == text

    def test_a_value_may_not_bring_tokens(self):
        with pytest.raises(ValueError, match="other"):
            templating.substitute("{v}", {"v": "{other}"})

    def test_nothing_to_fill(self):
        assert templating.substitute(None, {}) is None
        assert templating.substitute("", {"x": 1}) == ""
        assert templating.substitute("SELECT 1", None) == "SELECT 1"

    def test_filters_are_sorted_and_checked(self):
        assert templating.filters_clause({"b": 1, "a": "x'y"}) == "AND a = 'x''y' AND b = '1'"
        assert templating.filters_clause({}) == ""
        with pytest.raises(ValueError, match="1=1"):
            templating.filters_clause({"1=1 OR x": "y"})

    def test_marker_or_wrap(self):
        assert templating.with_filters("WHERE a {extra_filters}", "AND b = '1'") == "WHERE a AND b = '1'"
        assert templating.with_filters("WHERE a $extra_filters", "") == "WHERE a "
        wrapped = templating.with_filters("SELECT x FROM t WHERE a OR b;", "AND x = '1'")
        assert wrapped.startswith("SELECT * FROM (") and wrapped.endswith("WHERE x = '1'") and ";" not in wrapped

    @pytest.mark.parametrize("sql", ["DROP TABLE x", "INSERT INTO x VALUES (1)", "SET a = 1", "CREATE TABLE y AS SELECT 1", "TRUNCATE TABLE t"])
    def test_only_queries(self, spark, sql):
        with pytest.raises(ValueError, match="query"):
            templating.require_query(spark, sql)

    @pytest.mark.parametrize("sql", ["SELECT 1", "WITH a AS (SELECT 1) SELECT * FROM a", "SELECT 1 UNION ALL SELECT 2", "SELECT a, count(*) FROM t GROUP BY a HAVING count(*) > 1", "VALUES (1)"])
    def test_queries(self, spark, sql):
        templating.require_query(spark, sql)


class TestKeys:
    def test_round_trip(self):
        key = keys.encode(["Claim_ID", "line"], {"claim_id": "C=1", "line": None})
        assert key == "Claim_ID=C=1|line=NULL"
        assert keys.decode(key) == {"Claim_ID": "C=1", "line": None}
        assert keys.decode("") == {} and keys.decode("a=1||b=2") == {"a": "1", "b": "2"}

    def test_missing(self):
        with pytest.raises(KeyError):
            keys.encode(["x"], {})
        with pytest.raises(ValueError, match="column"):
            keys.encode([], {"x": 1})
        assert keys.split_columns(" a, ,b ,") == ["a", "b"]
        assert keys.split_columns(None) == []

    def test_columns_say_what_python_says(self, spark):
        values = [0.0, -1.5, 1e7, 12345678.25, 1e15, 1e16, 1.5e-5, 0.0001, 123456789012345.0, 2.5e300, 1e-7]
        rows = [(v, v > 0, dt.date(2026, 8, 1), i) for i, v in enumerate(values)] + [(None, None, None, None)]
        df = spark.createDataFrame(rows, "d double, b boolean, t date, i int")
        got = {r[0] for r in df.select(keys.key_column(df, ["D", "b", "t", "i"])).collect()}
        assert got == {keys.encode(["D", "b", "t", "i"], dict(zip("dbti", r, strict=True))) for r in rows}

    def test_decoded_column(self, spark):
        df = spark.createDataFrame([("a=1|b=x=y|c=NULL",)], "k string").select(keys.decoded(keys.F.col("k")).alias("m"))
        assert df.first()["m"] == {"a": "1", "b": "x=y", "c": None}


class TestVerdict:
    @pytest.mark.parametrize(
        ("args", "status"),
        [((1000, 750, 75.0), "PASS"), ((1000, 751, 75.0), "FAIL"), ((1000, 750, 75.0, 50, "OR"), "FAIL"), ((1000, 751, 75.0, 800, "AND"), "PASS"), ((1000, 801, 75.0, 800, "and"), "FAIL"), ((1000, 751, 75.0, None, "AND"), "FAIL"), ((10, 1), "FAIL"), ((10, 0), "PASS"), ((0, 5, 1.0), "PASS"), ((10, 5, None, 4, "odd"), "FAIL")],
    )
    def test_table(self, args, status):
        assert verdict.evaluate(*args).status == status

    def test_what_is_recorded(self):
        assert verdict.evaluate(0, 5, 1.0) == verdict.Verdict("PASS", False)
        assert verdict.evaluate(10, 0) == verdict.Verdict("PASS", False)
        assert verdict.evaluate(10, 1) == verdict.Verdict("FAIL", True, None, 0, "OR")
        assert verdict.evaluate(10, 1, 50.0, 3, "AND") == verdict.Verdict("PASS", True, 50.0, 3, "AND")

    @pytest.mark.parametrize("severity", ["warn", "WARNING", "Info", "notice"])
    def test_soft(self, severity):
        assert verdict.evaluate(10, 5, severity=severity).status == "WARN"

    def test_pct(self):
        assert verdict.failure_pct(3, 1) == 33.333333
        assert verdict.failure_pct(0, 1) == 0.0
        assert verdict.failure_pct(1_600_000, 5) == 0.000313

    def test_column_agrees(self, spark):
        rng = random.Random(3)
        pick = lambda *x: rng.choice(x)
        cases = [(pick(0, 10, 1000), pick(0, 5, 10, 751), pick(None, 5.0, 75.0), pick(None, 5, 800), pick("OR", "AND", "x"), pick("WARN", "Error")) for _ in range(300)]
        df = spark.createDataFrame(cases, "t long, f long, p double, c int, o string, s string")
        cols = [keys.F.col(c) for c in "tfpcos"]
        for r in df.select("*", verdict.status_column(*cols).alias("status")).collect():
            assert r["status"] == verdict.evaluate(r.t, r.f, r.p, r.c, r.o, r.s).status


class TestQuota:
    def test_rounding(self):
        assert quota.round_target(100 * 0.333, "FLOOR") == 33
        assert quota.round_target(100 * 0.335, "ROUND") == 34
        assert quota.round_target(100 * 0.331, "CEIL") == 34
        assert quota.round_target(2.5, "ROUND") == 2
        assert quota.round_target(-3, None) == 0

    def test_shares(self):
        assert quota.bucket_target("x", {}, 100, "FLOOR") == 100
        assert quota.bucket_target("x", {"a": 0.8, "b": 0.1}, 100, "FLOOR") == 9  # 1 - (0.8 + 0.1) is below 0.1
        assert quota.bucket_target("x", {"a": 0.4}, 100, "FLOOR", 3) == 20
        assert quota.bucket_target("x", {"a": 1.2}, 100, "FLOOR") == 0

    def test_leaves_in_order(self):
        got = quota.leaves({("b", "x"): 5, ("a", "y"): 3, ("a", "x"): 1}, [{"a": 0.5}, {}], 10, "FLOOR")
        assert [(x.name, x.size, x.target, x.chosen) for x in got] == [("a/x", 1, 5, 1), ("a/y", 3, 5, 3), ("b/x", 5, 5, 5)]
        assert quota.leaves({(): 7}, [], 3, None) == [quota.Leaf((), 7, 3)]

    @given(st.integers(0, 60), st.integers(-2, 70), st.integers())
    def test_draws_are_those_of_rows(self, size, n, seed):
        rows = [f"r{i}" for i in range(size)]
        mine = [rows[i] for i in quota.shuffled(size, n, random.Random(seed))]
        theirs = list(rows)
        if n > 0 and rows:
            random.Random(seed).shuffle(theirs)
        assert mine == theirs[: max(n, 0)]
        found = quota.systematic(size, n, random.Random(seed))
        if found:
            step, offset = found
            assert len(rows[offset - 1 :: step][:n]) == n
        else:
            assert n <= 0 or n >= size


class TestNames:
    def test_run_keys(self):
        assert ids.build_run_key("A", 2026, delimiter="-") == "A-2026"
        with pytest.raises(ValueError, match="part"):
            ids.build_run_key()
        assert ids.default_run_key() == dt.date.today().isoformat()

    def test_run_ids(self):
        when = dt.datetime(2026, 8, 19, 15, 15, 0, 500000)
        labels, stamp, tail = ids.run_id("a", None, "", "b", timestamp=when).rsplit("::", 2)
        assert (labels, stamp, len(tail)) == ("a::b", "20260819T151500.500000", 6)
        assert ids.group_run_id("P", "g", "K", 2, "me").startswith("P.g::K::attempt-2::me::")
        assert ids.group_run_id(None, "g", "K", 1, "me").startswith("g::K::attempt-1::me::")


class TestSettings:
    @pytest.mark.parametrize(("env", "name"), [("DEV", "core_dev_T"), ("QA", "core_qa_T"), ("INT", "core_int_T"), ("UAT", "core_T"), ("PROD", "core_T"), ("LAB", "core_lab_T")])
    def test_env_token(self, env, name):
        assert settings.Settings(environment=env).database_name("core_$env_T") == name

    def test_case_follows_the_token(self):
        s = settings.Settings(environment="QA")
        assert s.env_tokens("a_$ENV_b $env $Env") == "a_QA_b qa Qa"
        assert s.env_tokens("no__token") == "no__token"
        assert s.env_tokens("x__y_$env") == "x_y_qa"
        assert s.env_tokens(None) is None

    def test_overrides(self):
        s = settings.Settings.from_env({"DQ_ENVIRONMENT": "uat", "DQ_ENV_VALUE_UAT": "u", "DQ_DB_MAP_OLD_DB": "UAT=NEW_DB, QA=Q", "DQ_MAX_PARALLEL_RULES": "0", "DQ_POSTGRES_MAX_PARALLEL": "3"})
        assert s.database_name("d_$env") == "d_u"
        assert s.database_name("old_db") == "NEW_DB"
        assert (s.max_parallel_rules, s.parallel_for("postgres"), s.parallel_for("x")) == (1, 3, 1)
        assert settings.Settings(environment="DEV", database_map=s.database_map).database_name("old_db") == "old_db"

    def test_readiness(self):
        settings.register_readiness("g", lambda key, _: key == "K")
        try:
            assert settings.is_ready("g", "K", None) and not settings.is_ready("g", "L", None) and settings.is_ready("h", "L", None)
        finally:
            settings.register_readiness("g", None)

    def test_env_file(self, tmp_path, monkeypatch):
        monkeypatch.setenv("DQ_A", "set")
        monkeypatch.delenv("DQ_B", raising=False)
        (tmp_path / ".env").write_text("# note\nDQ_A=file\nDQ_B = 'b'\nbroken\n")
        assert settings.load_env_file(tmp_path / ".env") == {"DQ_A": "file", "DQ_B": "b"}
        import os

        assert (os.environ["DQ_A"], os.environ["DQ_B"]) == ("set", "b")
        monkeypatch.delenv("DQ_B")
        assert settings.load_env_file(tmp_path / "none") == {}

    def test_logs_are_pruned(self, tmp_path):
        import os

        old = tmp_path / "verdigris_old.log"
        old.write_text("x")
        os.utime(old, (0, 0))
        path = settings.configure_logging(tmp_path)
        assert path.exists() and not old.exists()


def test_key_text_is_that_of_python(spark):
    import struct

    rng = random.Random(3)
    numbers = [struct.unpack("d", rng.randbytes(8))[0] for _ in range(2000)] + [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-8, 20) for _ in range(2000)]
    numbers += [0.0, -0.0, 1e-4, 9.999e-5, 1.2345678901234567e-4, 1e16, 9999999999999998.0, 1e7, 2e-3, 5e-324, 1e23, float("inf"), -float("inf"), float("nan"), None]
    df = spark.createDataFrame([(x,) for x in numbers], "d double")
    got = [r[0] for r in df.select(keys.key_column(df, ["d"])).collect()]
    assert got == [f"d={'NULL' if x is None else x}" for x in numbers]
    times = [dt.datetime(2026, 8, 1, 1, 2, 3, us) for us in (0, 500_000, 1, 120)] + [None]
    df = spark.createDataFrame([(x, x) for x in times], "t timestamp, n timestamp_ntz")
    assert [tuple(r) for r in df.select(keys.key_column(df, ["t"]), keys.key_column(df, ["n"])).collect()] == [(f"t={x or 'NULL'}", f"n={x or 'NULL'}") for x in times]


def test_retried():
    from verdigris.functions.retry import retried

    waits, calls = [], []

    def flaky(fail_times, error=OSError):
        def call():
            calls.append(1)
            if len(calls) <= fail_times:
                raise error("in passing")
            return len(calls)

        calls.clear()
        waits.clear()
        return call

    assert retried(flaky(2), 3, (2, 15), waits.append) == 3 and waits == [2, 4]
    with pytest.raises(OSError, match="passing"):
        retried(flaky(9), 6, (2, 15), waits.append)
    assert waits == [2, 4, 8, 15, 15]
    with pytest.raises(ValueError, match="passing"):
        retried(flaky(1, ValueError), 3, (2, 15), waits.append)
    assert waits == [] and len(calls) == 1


def test_pct_column_is_the_function(spark):
    shares = [(f, t) for t in (0, 1, 3, 7, 128, 512, 1024, 4096, 100_000) for f in range(0, t + 1, max(1, t // 50))]
    df = spark.createDataFrame(shares, "f long, t long")
    got = df.select("f", "t", verdict.pct_column(F.col("t"), F.col("f")).alias("p")).collect()
    assert [(r.f, r.t) for r in got if r.p != verdict.failure_pct(r.t, r.f)] == []
