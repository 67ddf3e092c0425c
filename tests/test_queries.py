"""Every query against its SQL in DuckDB."""

import math
from pathlib import Path

import duckdb
import pytest

from verdigris import catalogue

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test data")


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in catalogue.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query(spark, oracle, name):
    df = catalogue.queries()[name](spark, str(SF))
    want = oracle.sql(catalogue.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    cols = sorted(df.columns)
    order = [want.columns.index(c) for c in cols]
    got = sorted(tuple(map(plain, r)) for r in df.select(*cols).collect())
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in want.fetchall())


@pytest.mark.parametrize(("name", "n"), [("sample_quota_two_level", 200), ("sample_systematic", 90), ("sample_random_seeded", 120)])
def test_drawn(spark, name, n):
    got = [r[0] for r in catalogue.queries()[name](spark, str(SF)).collect()]
    assert len(got) == n == len(set(got))


def test_text_forms_of_all_rows(spark, tmp_path):
    for t in catalogue.TABLES:
        if t != "customer":
            (tmp_path / f"{t}.parquet").symlink_to(SF / f"{t}.parquet")
    customer = spark.read.parquet(f"{SF}/customer.parquet").limit(1).drop("c_custkey")
    given = [14_999, 15_000, 150_001]
    spark.createDataFrame([(k,) for k in given], "c_custkey long").crossJoin(customer).write.parquet(f"{tmp_path}/customer.parquet")
    got = [r[0].split("|d=")[1] for r in catalogue.queries()["rule_key_text_forms"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(str(k * 1000000.5) for k in given)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 9
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_oracles_are_sql():
    import __spark_entry__ as entry

    assert [name for name, sql in entry.oracle_sql().items() if not isinstance(sql, str)] == []
