"""What rules found: breaches, the exceptions behind them, and the live source rows of those."""

from __future__ import annotations

import logging
import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import keys
from ..functions.retry import retried
from ..sources.resolver import SourceResolver
from . import metastore as ms
from .scratch import scratch

log = logging.getLogger(__name__)
#: What tells where an exception's row is, and by which columns.
ORIGIN = ("source_name", "database_name", "src_tbl_nm", "_columns")
#: So many keys at most are written into the filter of a scan.
FEW_KEYS = 1000
CONTEXT = ("_record_id", "_rule_id", "_rule_nm", "_process_name", "_project_name", "_src_key_value", "_exception_flag")


def breaches(store: ms.MetaStore, run_id: str) -> DataFrame:
    """FAIL and WARN results of an attempt, also of one that is no longer the current one."""
    return store.current(ms.RESULTS).filter((F.col("run_id") == run_id) & F.col("status").isin("FAIL", "WARN")).orderBy("status", "rule_id")


def records(store: ms.MetaStore, rule_id: int, run_key: str) -> DataFrame:
    """The current exceptions of a rule and run."""
    here = (F.col("run_key") == run_key) & (F.col("rule_id") == rule_id)
    return store.current(ms.EXCEPTIONS, here).filter("etl_is_curr_ind = 'Y'").orderBy("record_id")


def tie_back(source: DataFrame, key_columns: list[str], exceptions: DataFrame) -> DataFrame:
    """Source rows that have the key of an exception, with the exception's columns first."""
    return _matched(source, key_columns, exceptions).filter("_hit").drop("_hit")


def _matched(source: DataFrame, key_columns: list[str], exceptions: DataFrame) -> DataFrame:
    """Every exception with its source rows (_hit), or with none.

    Keys are decoded to values of the source's own types, so that the source is
    joined on its columns as they are; of few keys, the values themselves are a
    filter that reaches the scan.  Keys whose text can be taken apart in several
    ways, and columns without plain values, are compared as text.
    """
    about = exceptions.select(*[F.col(c.removeprefix("_")).alias(c) for c in CONTEXT])
    rows = source.toDF(*[c.lower() for c in source.columns])
    rows = rows.withColumn("_hit", F.lit(True))
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    names = [c.lower() for c in key_columns]
    if missing := [c for c in names if c not in kinds]:
        raise KeyError(missing[0])
    key = F.col("_src_key_value")
    shape = "^" + r"\|".join(f"{re.escape(c)}=(.*)" for c in key_columns) + "$"
    plain = key.rlike(f"(?s){shape}")
    for c in key_columns[1:]:
        plain = plain & (F.size(F.split(key, re.escape(f"|{c}="))) == 2)
    typed = all(isinstance(kinds[c], (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)) for c in names)
    parts = []
    if typed:
        wanted = about.filter(plain)
        for i, c in enumerate(names):
            told = F.regexp_extract(key, f"(?s){shape}", i + 1)
            wanted = wanted.withColumn(f"_v{i}", told if isinstance(kinds[c], T.StringType) else F.nullif(told, F.lit(keys.NULL_KEY)).try_cast(kinds[c]))
        mine = lambda c: F.coalesce(c, F.lit(keys.NULL_KEY))
        same = F.lit(True)
        for i, c in enumerate(names):
            same = same & (mine(F.col(c)) == F.col(f"_v{i}") if isinstance(kinds[c], T.StringType) else F.col(c).eqNullSafe(F.col(f"_v{i}")))
        parts.append(wanted.join(_pruned(rows, names, kinds, wanted), same, "left").select(*CONTEXT, *rows.columns))
    if not typed or not (odd := about.filter(~F.coalesce(plain, F.lit(False)))).isEmpty():
        encoded = rows.withColumn("_key", keys.key_column(rows, key_columns))
        parts.append((odd if typed else about).join(encoded, key == F.col("_key"), "left").select(*CONTEXT, *rows.columns))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("_hit", F.coalesce("_hit", F.lit(False))).select(*CONTEXT, *[c for c in rows.columns if c != "_hit"], "_hit")


def _pruned(rows: DataFrame, names: list[str], kinds: dict, wanted: DataFrame) -> DataFrame:
    """rows whose key columns have a value of the keys, if the keys are FEW_KEYS at most; else all."""
    values = wanted.select(*[f"_v{i}" for i in range(len(names))]).distinct().limit(FEW_KEYS + 1).collect()
    if len(values) > FEW_KEYS:
        return rows
    for i, c in enumerate(names):
        some = {v[i] for v in values}
        null = None in some or isinstance(kinds[c], T.StringType) and keys.NULL_KEY in some
        fits = F.col(c).isin([F.lit(v).cast(kinds[c]) for v in some if v is not None])
        rows = rows.filter(fits | F.col(c).isNull() if null else fits)
    return rows


def _origins(store: ms.MetaStore, exceptions: DataFrame) -> tuple[DataFrame, list]:
    """exceptions with the key columns that their keys tell (_columns), and the distinct sources, tables and key columns.

    A key is read by its rule's present columns if it has them, else by the names
    in it, so a rule that was changed since still ties back.
    """
    some = [r[0] for r in exceptions.select("rule_id").distinct().collect()]  # rules
    rules = store.current(ms.RULES).filter(F.col("rule_id").isin(some)).select("rule_id", "src_key_cols").collect()
    shapes = [(r["rule_id"], ",".join(c), "(?s)^" + r"\|".join(f"{re.escape(x)}=.*" for x in c) + "$") for r in rules if (c := keys.split_columns(r["src_key_cols"]))]
    known = store.spark.createDataFrame(shapes, "rule_id int, _now string, _shape string")
    told = F.concat_ws(",", F.map_keys(keys.decoded(F.col("src_key_value"))))
    named = exceptions.join(F.broadcast(known), "rule_id", "left")  # a row a rule
    named = named.withColumn("_columns", F.when(F.expr("src_key_value rlike _shape"), F.col("_now")).otherwise(told)).drop("_now", "_shape")
    return named, named.select(*ORIGIN).distinct().collect()


def _tied(store: ms.MetaStore, sources: SourceResolver, exceptions: DataFrame) -> DataFrame | None:
    """Live source rows of exceptions, by the tables and keys that these name themselves: a scan a table and key.

    Keys that no source row has any more are counted and logged.  A source that
    is absent raises RuntimeError.
    """
    named, origins = _origins(store, exceptions)
    parts = []
    for o in origins:
        source = sources.get(o["source_name"])
        if source is None:
            raise RuntimeError(f"source {o['source_name']!r} is not available")
        here = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(o[c])) for c in ORIGIN])
        load = lambda: source.load(o["database_name"], o["src_tbl_nm"])  # noqa: B023, E731
        parts.append(_matched(retried(load, sources.settings.max_attempts, sources.settings.retry_wait), keys.split_columns(o["_columns"]), named.filter(here)))
    if not parts:
        return None
    rows = scratch(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), "tied")
    if gone := rows.filter("NOT _hit").select("_record_id").distinct().count():
        log.warning("%d exceptions have no source row any more", gone)
    return rows.filter("_hit").drop("_hit")


def source_records(store: ms.MetaStore, sources: SourceResolver, rule_id: int, run_key: str) -> DataFrame:
    """Live source rows of a rule's current exceptions.  A source that is absent raises RuntimeError."""
    found = store.current(ms.RULES).filter(F.col("rule_id") == rule_id).collect()
    if not found:
        raise ValueError(f"no rule {rule_id}")
    rows = _tied(store, sources, records(store, rule_id, run_key))
    if rows is not None:
        return rows
    # No exceptions: no rows, but the columns of the rule's table.
    rule = found[0]
    if (source := sources.get(rule["sql_dialect"])) is None:
        raise RuntimeError(f"source {rule['sql_dialect']!r} is not available")
    table = source.load(sources.settings.database_name(rule["database_name"]), rule["src_tbl_nm"])
    return tie_back(table.limit(0), keys.split_columns(rule["src_key_cols"]), records(store, rule_id, run_key))


def missing_keys(exceptions: DataFrame, rows: DataFrame) -> DataFrame:
    """Exceptions whose key no live source row has any more."""
    return exceptions.join(rows.select(F.col("_src_key_value").alias("src_key_value")), "src_key_value", "left_anti")


def source_records_for_process(store: ms.MetaStore, sources: SourceResolver, process: str, run_key: str, project: str | None = None, rule_nm: str | None = None) -> DataFrame:
    """Live source rows of all current exceptions of a process; a row that fails three rules comes three times."""
    df = store.current(ms.EXCEPTIONS, F.col("run_key") == run_key).filter((F.col("process_name") == process) & (F.col("etl_is_curr_ind") == "Y"))
    for column, value in (("project_name", project), ("rule_nm", rule_nm)):
        if value:
            df = df.filter(F.col(column) == value)
    rows = _tied(store, sources, df)
    return rows if rows is not None else store.spark.createDataFrame([], ", ".join(f"{c} string" for c in CONTEXT))


def to_csv(rows: DataFrame, path: str) -> bool:
    """rows as one CSV file, context columns first, nested columns as JSON; no file and False if there are none."""
    if rows.isEmpty():
        return False
    spark = rows.sparkSession
    flat = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "map", "struct") else F.col(f"`{f.name}`") for f in rows.schema.fields]
    beside = f"{path}.parts"
    # One file is one task's work; its rows are those of the exceptions.
    rows.select(*flat).coalesce(1).write.mode("overwrite").options(header=True, quote='"', escape='"').csv(beside)
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.listStatus(make(beside)) if s.getPath().getName().startswith("part-"))
    fs.delete(make(path), True)
    fs.rename(part, make(path))
    fs.delete(make(beside), True)
    return True
