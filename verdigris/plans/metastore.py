"""The metadata store: append-only, versioned tables.

A logical table is a folder of Parquet folders with the extra columns _seq
(ascending, given by the driver) and _op.  A row is changed by appending a new
version; its current state is the version with the highest _seq of its primary
key.  So soft deletes keep their history.  Every append has a folder of its own,
named by its _seq, so writers never meet, and counts once it is committed: a
lost job leaves nothing that is read.

After SNAPSHOT_EVERY appends the current rows are written down as a snapshot.
Readers take the newest snapshot and the appends that are not in it, so reading
does not grow with the number of appends.  A snapshot counts from the moment its
list of appends is there, which is one file, made last; so compaction and whole
replacements are seen entirely or not at all, and a job that dies on the way
changes nothing.
"""

from __future__ import annotations

import datetime as dt
import logging
import threading
import time
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.retry import retried
from .scratch import scratch

log = logging.getLogger(__name__)
LONGEST_MESSAGE = 2000
#: Appends to a table after which its current rows are written down.
SNAPSHOT_EVERY = 32


@dataclass(frozen=True)
class Table:
    name: str
    key: tuple[str, ...]
    schema: str
    partition: tuple[str, ...] = ()
    #: How a mirror copies it: all of it, or what its watermark says has changed.
    incremental: bool = False
    watermark: str | None = None
    reopen: str | None = None

    @property
    def columns(self) -> list[str]:
        return [c.split()[0] for c in self.schema.split(", ")]


_CHANGED = "coalesce(last_updated_datetime, load_datetime)"
_ERROR_CHANGED = "coalesce(last_updated_datetime, occurred_at)"

RULES = Table(
    "rules", ("rule_id",), (
        "rule_id int, rule_nm string, act_ind int, rule_group string, rule_variant string, project_name string, process_name string, "
        "seq_no int, sequencing_mode string, on_failure string, database_name string, src_tbl_nm string, sql_dialect string, "
        "rule_syntax string, src_key_cols string, element_name string, threshold_pct double, threshold_count int, "
        "threshold_operator string, severity string, universe_version string, universe_year int, dgr_nbr string, "
        "issue_category_name string, business_rule string, rule_description string, created_by string, last_updated_by string, "
        "load_datetime timestamp_ntz, last_updated_datetime timestamp_ntz"
    ))
EXCEPTIONS = Table(
    "exceptions", ("rule_id", "run_key", "src_key_value"), (
        "record_id long, run_id string, run_key string, rule_id int, rule_nm string, rule_group string, rule_variant string, "
        "database_name string, src_tbl_nm string, project_name string, process_name string, element_name string, source_name string, "
        "src_key_value string, dgr_nbr string, universe_version string, run_type string, batch_schedule string, exception_flag string, "
        "exception_approver string, etl_is_curr_ind string, etl_load_dt date, etl_last_updt_dt date, load_datetime timestamp_ntz, "
        "last_updated_by string, last_updated_datetime timestamp_ntz"
    ), ("run_key",), True, _CHANGED)
RESULTS = Table(
    "results", ("result_id",), (
        "result_id long, run_id string, rule_id int, rule_group string, rule_variant string, project_name string, process_name string, "
        "run_key string, seq_no int, start_time timestamp_ntz, end_time timestamp_ntz, total_records long, failed_records long, "
        "failure_pct double, threshold_pct_used double, threshold_count_used int, threshold_operator_used string, severity string, "
        "status string, error_message string, executed_sql string, source_tieback_sql string, active_ind string, "
        "load_datetime timestamp_ntz, last_updated_datetime timestamp_ntz"
    ), (), True, _CHANGED)
RULE_AUDIT = Table(
    "rule_audit", ("run_id",), (
        "run_id string, rule_group string, rule_variant string, project_name string, process_name string, run_key string, "
        "run_params string, extra_filters string, started_at timestamp_ntz, ended_at timestamp_ntz, status string, total_rules int, "
        "rules_succeeded int, rules_errored int, triggered_by string, load_datetime timestamp_ntz"
    ), (), True, "load_datetime", "status = 'RUNNING'")
RULE_ERRORS = Table(
    "rule_errors", ("error_id",), (
        "error_id long, run_id string, rule_id int, rule_group string, rule_variant string, run_key string, error_type string, "
        "error_message string, error_detail string, active_ind string, occurred_at timestamp_ntz, last_updated_datetime timestamp_ntz"
    ), (), True, _ERROR_CHANGED)
SAMPLING_CONFIG = Table(
    "sampling_config", ("config_id",), (
        "config_id int, act_ind int, project_name string, process_name string, sample_name string, source_type string, "
        "universe_table string, key_columns string, scope_sql string, exclusion_sql string, target_volume int, sampling_method string, "
        "priority_rank_sql string, rounding_mode string, schedule_cron string, created_by string, last_updated_by string, "
        "load_datetime timestamp_ntz"
    ))
SAMPLING_STRATA = Table("sampling_strata", ("strata_id",), "strata_id int, config_id int, level_order int, level_name string, stratify_expr string")
SAMPLING_MIX = Table("sampling_mix", ("mix_id",), "mix_id int, strata_id int, bucket_value string, target_fraction double")
SAMPLE_SELECTIONS = Table(
    "sample_selections", ("sample_run_id", "case_key"), (
        "sample_run_id string, config_id int, project_name string, process_name string, sample_cycle date, case_key string, "
        "priority_rank long, selected_flag int, excluded_flag int, exclusion_reason string, etl_is_curr_ind string, "
        "load_datetime timestamp_ntz, last_updated_datetime timestamp_ntz"
    ), ("sample_run_id",), True, _CHANGED)
SAMPLE_ATTRS = Table(
    "sample_selection_attrs", ("sample_run_id", "case_key", "strata_id"), (
        "sample_run_id string, case_key string, strata_id int, level_order int, bucket_value string, etl_is_curr_ind string, "
        "load_datetime timestamp_ntz, last_updated_datetime timestamp_ntz"
    ), ("sample_run_id",), True, _CHANGED)
SAMPLING_AUDIT = Table(
    "sampling_audit", ("run_id",), (
        "run_id string, run_key string, sample_config_id int, sampling_method string, random_seed long, target_volume int, "
        "total_candidates long, total_selected long, started_at timestamp_ntz, ended_at timestamp_ntz, status string, triggered_by string, "
        "load_datetime timestamp_ntz"
    ), (), True, "load_datetime", "status = 'RUNNING'")
SAMPLING_ERRORS = Table(
    "sampling_errors", ("error_id",), (
        "error_id long, run_id string, process_name string, run_key string, error_type string, error_message string, error_detail string, "
        "active_ind string, occurred_at timestamp_ntz, last_updated_datetime timestamp_ntz"
    ), (), True, _ERROR_CHANGED)

TABLES = {t.name: t for t in (RULES, EXCEPTIONS, RESULTS, RULE_AUDIT, RULE_ERRORS, SAMPLING_CONFIG, SAMPLING_STRATA, SAMPLING_MIX, SAMPLE_SELECTIONS, SAMPLE_ATTRS, SAMPLING_AUDIT, SAMPLING_ERRORS)}


def now() -> dt.datetime:
    return dt.datetime.now()


def short(message: object) -> str:
    return str(message)[:LONGEST_MESSAGE]


@dataclass(frozen=True)
class Snapshot:
    path: str
    #: The appends it holds, and whether they are there no more or count no more.
    seqs: frozenset[int]
    alone: bool


class MetaStore:
    """``append``, ``current`` and ``history`` of the tables under a folder that all machines share."""

    def __init__(self, spark: SparkSession, path: str, attempts: int = 3, wait: tuple[float, float] = (2.0, 15.0)):
        self.spark, self.path = spark, path.rstrip("/")
        self.attempts, self.wait = attempts, wait
        self._lock, self._last = threading.Lock(), 0
        self._committed: dict[str, set[int]] = {}
        self._snapshots: dict[str, Snapshot] = {}

    def next_seq(self) -> int:
        """Ascending numbers, also over processes whose clocks agree."""
        with self._lock:
            self._last = max(self._last + 1, time.time_ns())
            return self._last

    def folder(self, table: Table) -> str:
        return f"{self.path}/{table.name}"

    def _full(self, table: Table) -> T.StructType:
        return T.StructType([*T._parse_datatype_string(table.schema).fields, T.StructField("_op", T.StringType()), T.StructField("_seq", T.LongType())])

    def _at(self, path: str):
        """The Hadoop path and its file system."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def create_all(self, drop_first: bool = False, dry_run: bool = False) -> list[str]:
        """Makes every table's folder; says what it makes."""
        made = []
        for t in TABLES.values():
            place, fs = self._at(self.folder(t))
            made.append(f"{t.name}: {t.schema}")
            if not dry_run:
                if drop_first:
                    fs.delete(place, True)
                    self._committed.pop(t.name, None)
                fs.mkdirs(place)
        return made

    def rows(self, table: Table, rows: Iterable[dict]) -> DataFrame:
        fields = T._parse_datatype_string(table.schema)
        return self.spark.createDataFrame([tuple(r.get(f.name) for f in fields) for r in rows], fields)

    def _typed(self, table: Table, what: DataFrame | Iterable[dict]) -> DataFrame:
        df = what if isinstance(what, DataFrame) else self.rows(table, what).coalesce(1)
        return df.select(*[F.col(f.name).cast(f.dataType) for f in T._parse_datatype_string(table.schema)])

    def append(self, table: Table, what: DataFrame | Iterable[dict], op: str = "I") -> None:
        """New rows, or new versions of rows with the same key."""
        self.put(table, self.next_seq(), self._typed(table, what).withColumn("_op", F.lit(op)))
        seqs, snapshots = self._listed(table)
        held = max(snapshots, key=lambda s: s.path, default=None)
        if len(seqs - held.seqs if held else seqs) >= SNAPSHOT_EVERY:
            self._snapshot(table, self.current_versions(table), seqs, alone=False)

    def put(self, table: Table, seq: int, rows: DataFrame) -> None:
        """Rows with _op as the append of a number; writing it again replaces it."""
        writer = rows.write.mode("overwrite")
        writer = writer.partitionBy(*table.partition) if table.partition else writer
        retried(lambda: writer.parquet(f"{self.folder(table)}/_seq={seq}"), self.attempts, self.wait)

    def appended(self, table: Table, seq: int) -> DataFrame:
        """The rows of one append, with _op."""
        schema = self._full(table)
        return self.spark.read.schema(schema).option("basePath", self.folder(table)).parquet(f"{self.folder(table)}/_seq={seq}").select(*schema.names).drop("_seq")

    def insert_or_skip(self, table: Table, what: DataFrame | Iterable[dict], op: str = "I") -> int:
        """Appends the rows whose key the table does not have, one a key; returns how many.

        Safe to repeat: a second insert of the same rows adds none.
        """
        given = self._typed(table, what).dropDuplicates(list(table.key))
        new = scratch(_without(given, self.current(table), table.key), "inserts")
        if n := new.count():
            self.append(table, new, op)
        return n

    def _listed(self, table: Table) -> tuple[set[int], list[Snapshot]]:
        """The committed appends that are there, and the snapshots."""
        place, fs = self._at(self.folder(table))
        if not fs.exists(place):
            return set(), []
        known, seqs, snapshots = self._committed.setdefault(table.name, set()), set(), []
        for status in fs.listStatus(place):
            path = status.getPath()
            name = path.getName()
            if name.startswith("_seq="):
                n = int(name.removeprefix("_seq="))
                if n in known or fs.exists(self._at(f"{self.folder(table)}/{name}/_SUCCESS")[0]):
                    seqs.add(n)
            elif name.startswith(".snapshot-"):
                found = self._snapshots.get(path.toString()) or self._manifest(path.toString())
                if found:
                    self._snapshots[path.toString()] = found
                    snapshots.append(found)
        self._committed[table.name] = known | seqs
        return seqs, snapshots

    def _manifest(self, path: str) -> Snapshot | None:
        place, fs = self._at(f"{path}/_manifest")
        if not fs.exists(place):
            return None
        stream = fs.open(place)
        try:
            kind, _, seqs = bytes(stream.readAllBytes()).decode().partition(" ")
        finally:
            stream.close()
        return Snapshot(path, frozenset(map(int, filter(None, seqs.split(",")))), kind == "alone")

    def _snapshot(self, table: Table, rows: DataFrame, seqs: set[int], alone: bool) -> None:
        """rows as the table's state in place of the appends seqs and of all earlier snapshots."""
        held = frozenset(seqs).union(*(s.seqs for s in self._listed(table)[1]))
        path = f"{self.folder(table)}/.snapshot-{self.next_seq()}"
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*table.partition) if table.partition else writer).parquet(path)
        place, fs = self._at(f"{path}/_manifest")
        out = fs.create(place, False)
        try:
            out.write(bytearray(f"{'alone' if alone else 'beside'} {','.join(map(str, sorted(held)))}".encode()))
        finally:
            out.close()

    def _read(self, table: Table, seqs: set[int], snapshot: Snapshot | None, where: str | F.Column | None) -> tuple[DataFrame, DataFrame | None]:
        """The versions of some appends, and the rows of a snapshot."""
        schema = self._full(table)
        if seqs:
            df = self.spark.read.schema(schema).option("basePath", self.folder(table)).parquet(*[f"{self.folder(table)}/_seq={n}" for n in sorted(seqs)]).select(*schema.names)
        else:
            df = self.spark.createDataFrame([], schema)
        base = self.spark.read.schema(schema).parquet(snapshot.path).select(*schema.names) if snapshot else None
        if where is not None:
            df, base = df.filter(where), None if base is None else base.filter(where)
        return df, base

    def history(self, table: Table, where: str | F.Column | None = None) -> DataFrame:
        """All versions since the last compaction or replacement.  where: on partition and key columns only, so that it may come before the choice of versions."""
        seqs, snapshots = self._listed(table)
        base = max((s for s in snapshots if s.alone), key=lambda s: s.path, default=None)
        tail, rows = self._read(table, seqs - base.seqs if base else seqs, base, where)
        return tail if rows is None else rows.unionByName(tail)

    def current_versions(self, table: Table, where: str | F.Column | None = None) -> DataFrame:
        """The latest version of each row, with _op and _seq."""
        seqs, snapshots = self._listed(table)
        base = max(snapshots, key=lambda s: s.path, default=None)
        tail, rows = self._read(table, seqs - base.seqs if base else seqs, base, where)
        latest = W.partitionBy(*table.key).orderBy(F.desc("_seq"))
        tail = tail.withColumn("_nth", F.row_number().over(latest)).filter("_nth = 1").drop("_nth")
        # Snapshot rows have one version a key; they are not shuffled while the appends after it are few.
        return tail if rows is None else _without(rows, tail, table.key).unionByName(tail)

    def current(self, table: Table, where: str | F.Column | None = None) -> DataFrame:
        """The latest version of each row."""
        return self.current_versions(table, where).select(*table.columns)

    def change(self, table: Table, rows: DataFrame, **values: object) -> None:
        """New versions of rows with some columns set to values or columns."""
        lit = {k: v if isinstance(v, F.Column) else F.lit(v) for k, v in values.items()}
        self.append(table, rows.withColumns(lit), "U")

    def replace(self, table: Table, rows: DataFrame) -> None:
        """rows as all that the table holds.  Readers see the old rows until they see the new ones."""
        seqs, _ = self._listed(table)
        self._snapshot(table, self._typed(table, rows).withColumns({"_op": F.lit("R"), "_seq": F.lit(self.next_seq())}), seqs, alone=True)
        self._clear(table)

    def compact(self, table: Table) -> None:
        """Writes the current rows down and drops the versions before them.  Appends of others meanwhile are kept."""
        seqs, _ = self._listed(table)
        self._snapshot(table, self.current_versions(table).withColumn("_op", F.lit("C")), seqs, alone=True)
        self._clear(table)

    def _clear(self, table: Table) -> None:
        """Deletes what the newest snapshot that stands alone took the place of."""
        seqs, snapshots = self._listed(table)
        base = max((s for s in snapshots if s.alone), key=lambda s: s.path)
        for path in [*(s.path for s in snapshots if s.path < base.path), *(f"{self.folder(table)}/_seq={n}" for n in seqs & base.seqs)]:
            place, fs = self._at(path)
            fs.delete(place, True)


def _without(rows: DataFrame, other: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """rows whose key other does not have; null keys are equal."""
    have = other.select(*[F.col(c).alias(f"_has_{c}") for c in key])
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_has_{c}"))
    return rows.join(have, same, "left_anti")
