"""Violations of a rule, its denominator, and their reconciliation with those on record."""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, templating
from ..functions.retry import retried


def rule_rows(spark: SparkSession, sql: str) -> DataFrame:
    """The rows of a rule's query, with names in lower case; of columns of one name the last is kept."""
    templating.require_query(spark, sql)
    df = spark.sql(sql)
    names = [c.lower() for c in df.columns]
    last = {c: i for i, c in enumerate(names)}
    df = df.toDF(*[f"c{i}" for i in range(len(names))])
    return df.select(*[F.col(f"c{i}").alias(c) for c, i in last.items()])


def keyed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """src_key_value and n, how many rows have it; one row each.

    Only key columns reach the scan, and rows of one key are summed before they
    are shuffled.
    """
    return rows.select(keys.key_column(rows, columns).alias("src_key_value")).groupBy("src_key_value").agg(F.count("*").alias("n"))


def scope_condition(params: Mapping[str, object]) -> str:
    return " AND ".join(templating.equalities(params)) or "1=1"


class Totals:
    """Denominators, each counted once for a table and scope; a failure is remembered too."""

    def __init__(self, attempts: int = 3, wait: tuple[float, float] = (2.0, 15.0)):
        self._attempts, self._wait = attempts, wait
        self._known: dict[tuple[str, str, str], int | Exception] = {}
        self._locks: dict[tuple[str, str, str], threading.Lock] = {}
        self._lock = threading.Lock()

    def count(self, source: object, dialect: str, database: str | None, table: str, params: Mapping[str, object]) -> int:
        key = dialect, source.identifier(database, table), scope_condition(params)
        with self._lock:
            mine = self._locks.setdefault(key, threading.Lock())
        with mine:
            if key not in self._known:
                try:
                    self._known[key] = retried(lambda: source.load(database, table).filter(key[2]).count(), self._attempts, self._wait)
                except Exception as e:
                    self._known[key] = e
        if isinstance(found := self._known[key], Exception):
            raise found
        return found

    def count_together(self, source: object, dialect: str, database: str | None, table: str, scopes: list[Mapping[str, object]]) -> None:
        """All scopes of a table in one scan.  If that fails, each is counted alone when it is asked for."""
        conditions = sorted({scope_condition(p) for p in scopes})
        try:
            df = source.load(database, table)
            row = df.agg(*[F.count_if(F.expr(c)).alias(f"n{i}") for i, c in enumerate(conditions)]).first()
        except Exception:
            return
        for i, c in enumerate(conditions):
            self._known.setdefault((dialect, source.identifier(database, table), c), row[f"n{i}"])


def actions(on_record: DataFrame, found: DataFrame, key: tuple[str, ...] = ("src_key_value",)) -> DataFrame:
    """action for each key on record (key, etl_is_curr_ind, ...) or found (key).

    INSERT new ones, REACTIVATE ones that had gone, DEACTIVATE ones that are
    gone now, KEEP the rest.
    """
    had, have = F.col("etl_is_curr_ind"), F.col("_found").isNotNull()
    joined = on_record.join(found.select(*key, F.lit(True).alias("_found")), list(key), "full_outer")
    action = F.when(had.isNull(), "INSERT").when(have & (had == "N"), "REACTIVATE").when(~have & (had == "Y"), "DEACTIVATE").otherwise("KEEP")
    return joined.withColumn("action", action).drop("_found")
