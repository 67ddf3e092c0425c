import datetime as dt
import os
import subprocess
import sys
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.parquet as pq
import pyspark
import pytest

from verdigris import catalogue
from verdigris.functions.settings import Settings
from verdigris.sources import files
from verdigris.sources.resolver import CatalogSource, SourceResolver


@pytest.mark.parametrize(("source", "name"), [("claims.csv", "claims"), ("2026 claims.v2.csv", "t_2026_claims_v2"), (".csv", "t"), ("", "t"), ("a/b*.parquet", "a_b_"), ("plain", "plain")])
def test_view_names(source, name):
    assert files.view_name(source) == name


def test_separated(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,Name\n1,x\n2,\"y,z\"\n")
    (tmp_path / "b.tsv").write_text("ID\tName\n1\tä\n")
    got = files.read(spark, f"{tmp_path}/a.csv")
    assert got.columns == ["id", "name"] and [tuple(r) for r in got.collect()] == [(1, "x"), (2, "y,z")]
    assert files.read(spark, f"{tmp_path}/b.tsv").first()["name"] == "ä"


def test_encoding(spark, tmp_path):
    (tmp_path / "l.csv").write_bytes("a\né\n".encode("latin-1"))
    assert files.read(spark, f"{tmp_path}/l.csv", "latin1").first()["a"] == "é"


def test_globs_unite_by_name(spark, tmp_path):
    (tmp_path / "p1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "p2.csv").write_text("b,c\n3,4\n")
    rows = {tuple(r[c] for c in "abc") for r in files.read(spark, f"{tmp_path}/p*.csv").collect()}
    assert rows == {(1, 2, None), (None, 3, 4)}


def test_parquet_with_folders(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "A int, day string").write.partitionBy("day").parquet(f"{tmp_path}/t")
    spark.createDataFrame([(2, 5, "y")], "A int, extra int, day string").write.mode("append").partitionBy("day").parquet(f"{tmp_path}/t")
    got = SourceResolver(spark).get("s3").load(f"file://{tmp_path}", "t/*/*.parquet")
    assert {(r.a, r.extra, r.day) for r in got.collect()} == {(1, None, "x"), (2, 5, "y")}


def test_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="supported"):
        files.read(spark, "x.json")
    sheet(tmp_path / "big.xlsx", [["a"], *([k * 12345.678] for k in range(120_000))])
    with pytest.raises(ValueError, match="more than 1"):
        files.read(spark, f"{tmp_path}/big.xlsx", max_mb=1)
    (tmp_path / "x.xlsx").write_bytes(b"none")
    with pytest.raises(ValueError, match="no Excel"):
        files.read(spark, f"{tmp_path}/x.xlsx")
    with pytest.raises(ValueError, match="xlsx"):
        files.read(spark, f"{tmp_path}/x.xls")


def sheet(path, rows):
    """A small workbook as spreadsheet programs write it: shared strings, numbers, a date style."""
    strings = sorted({c for r in rows for c in r if isinstance(c, str)})

    def cell(c, ref):
        if c is None:
            return ""
        if isinstance(c, str):
            return f'<c r="{ref}" t="s"><v>{strings.index(c)}</v></c>'
        if isinstance(c, bool):
            return f'<c r="{ref}" t="b"><v>{int(c)}</v></c>'
        if isinstance(c, dt.datetime):
            return f'<c r="{ref}" s="1"><v>{(c - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)}</v></c>'
        return f'<c r="{ref}"><v>{c!r}</v></c>'

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>" + "".join(f"<si><t>{escape(x)}</t></si>" for x in strings) + "</sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>" + "".join(f'<row r="{n}">' + "".join(cell(c, f"{chr(65 + k)}{n}") for k, c in enumerate(r)) + "</row>" for n, r in enumerate(rows, 1)) + "</sheetData></worksheet>")


def test_excel(spark, tmp_path):
    when = dt.datetime(2026, 8, 1)
    sheet(tmp_path / "claims.xlsx", [["ID", "Name", "Paid", "Day", "Open", "Mixed", "None"], [1, "a & b", 2.5, when, True, 1, None], [2, None, 3, None, False, "x", None], [3, "ä\n<c>", None, when, None, None, None]])
    got = SourceResolver(spark, Settings(file_base_path=str(tmp_path))).get("file").load(None, "claims.xlsx")
    assert got.dtypes == [("id", "bigint"), ("name", "string"), ("paid", "double"), ("day", "timestamp_ntz"), ("open", "boolean"), ("mixed", "string"), ("none", "string")]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, "a & b", 2.5, when, True, "1", None), (2, None, 3.0, None, False, "x", None), (3, "ä\n<c>", None, when, None, None, None)]


def test_line_breaks_in_values(spark, tmp_path):
    (tmp_path / "n.csv").write_text('a,b\n1,"x\ny ""z"""\n2,w\n')
    assert [tuple(r) for r in files.read(spark, f"{tmp_path}/n.csv").orderBy("a").collect()] == [(1, 'x\ny "z"'), (2, "w")]
    assert files.read(spark, f"{tmp_path}/n.csv", multiline=False).count() == 3


def test_one_type_over_files(spark, tmp_path):
    (tmp_path / "p1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "p2.csv").write_text("b,a,c\nx,2.5,3\n")
    got = files.read(spark, f"{tmp_path}/p*.csv")
    assert dict(got.dtypes) == {"a": "double", "b": "string", "c": "int"}
    assert {tuple(r[c] for c in "abc") for r in got.collect()} == {(1.0, "2", None), (2.5, "x", 3)}


def test_databases_are_split_and_built_anew(spark):
    url, driver = "jdbc:derby:memory:split;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    spark.range(1000).selectExpr("id AS K", "id * 2 AS V").coalesce(1).write.jdbc(url, "t", properties={"driver": driver})
    env = {"DQ_POSTGRES_URL": url, "DQ_POSTGRES_DRIVER": driver, "DQ_POSTGRES_SPLIT_COLUMN": "k", "DQ_POSTGRES_SPLITS": "4"}
    resolver = SourceResolver(spark, env=env)
    got = resolver.get("postgres").load(None, "t")
    assert got.rdd.getNumPartitions() == 4 and got.agg({"V": "sum"}).first()[0] == 999_000
    assert "PushedFilters: [*IsNotNull(K), *GreaterThan(K,990)]" in got.filter("K > 990")._jdf.queryExecution().toString()
    pings = iter([False, True])
    resolver.get("postgres").ping = lambda: next(pings)
    old = resolver.get("postgres")
    resolver._builders["postgres"] = lambda name, env: old
    assert resolver.live("postgres") is old and resolver.live("none") is None


def test_file_views(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "two").mkdir()
    for d in ("one", "two"):
        (tmp_path / d / "claims.csv").write_text("a\n1\n")
    source = SourceResolver(spark, Settings(file_base_path=f"{tmp_path}/one")).get("file")
    source.prepare(None, "claims.csv")
    source.prepare(None, "claims.csv")
    assert spark.sql("SELECT a FROM claims").count() == 1
    with pytest.raises(ValueError, match="already"):
        source.prepare(f"{tmp_path}/two", "claims.csv")
    with pytest.raises(ValueError, match="table name"):
        source.prepare(None, "")
    assert source.path(None, "/abs/x.csv") == "/abs/x.csv"


def test_registry(spark):
    r = SourceResolver(spark, env={"DQ_POSTGRES_URL": "jdbc:postgresql://h/db", "DQ_POSTGRES_USER": "u"})
    assert r.get("POSTGRES").options == {"sslmode": "prefer", "user": "u"} and r.get("teradata") is None
    assert isinstance(r.get(None), CatalogSource) and r.get("spark").ping()
    assert r.get("spark").identifier("db", "t") == "db.t"
    with pytest.raises(ValueError, match="prefix"):
        r.get("s3").load(None, "x.csv")


CLUSTER = """
import sys
from pyspark.sql import SparkSession
from verdigris import catalogue
from verdigris.sources.resolver import SourceResolver

spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.executor.memory", "512m").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", f"file://{sys.argv[1]}").getOrCreate()
rows = [(1, "a", 1.5), (2, 'a "b",', None), (3, " two\\r\\nlines ", 1 / 3), (4, None, -1e300), (5, "", 0.1), (6, "\\t", 2.0), (7, "NULL", 3.0), (8, "\u732b \\\\", 4.0), (None, "x", 5.0)]
given = spark.createDataFrame(rows, "k long, n string, v double").repartition(3)
for df, n in ((given, 9), (given.limit(0), 0)):
    env = {"DQ_POSTGRES_URL": catalogue._database(spark, "t", df), "DQ_POSTGRES_DRIVER": catalogue.DERBY, "DQ_POSTGRES_SPLIT_COLUMN": "K", "DQ_POSTGRES_SPLITS": "4"}
    got = SourceResolver(spark, env=env).get("postgres").load(None, "t")
    assert got.dtypes == df.dtypes and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, df.collect()), key=str) and got.count() == n
assert catalogue.queries()["source_jdbc_split"](spark, sys.argv[2]).count() == 150
print("same")
"""


def test_executors_open_the_database(tmp_path):
    """Executors are processes of their own: a database in the driver's memory is empty to them."""
    sf = tmp_path / "sf"
    sf.mkdir()
    rows = pa.table({"c_custkey": range(150), "c_name": ["n"] * 150, "c_acctbal": [0.5] * 150})
    for t in catalogue.TABLES:
        pq.write_table(rows, sf / f"{t}.parquet")
    (tmp_path / "home" / "work").mkdir(parents=True)
    for p in Path(pyspark.__file__).parent.iterdir():  # executors write into work in Spark's home
        if p.name != "work":
            (tmp_path / "home" / p.name).symlink_to(p)
    given = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_", "SPARK_", "_PYSPARK"))}
    env = given | {"SPARK_SCALA_VERSION": "2.13", "SPARK_HOME": f"{tmp_path}/home", "PYSPARK_PYTHON": sys.executable}
    run = subprocess.run([sys.executable, "-c", CLUSTER, str(tmp_path), str(sf)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert run.stdout.strip().endswith("same"), run.stderr[:5000]
