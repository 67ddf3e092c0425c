"""Where a rule's or a sample's table comes from: catalog tables, files, object stores, JDBC."""

from __future__ import annotations

import logging
import threading
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..functions.settings import Settings
from . import files

log = logging.getLogger(__name__)
#: How each kind of database is logged in to unless its variables say otherwise (fixed values).
JDBC_DEFAULTS = {"teradata": {"logmech": "LDAP"}, "postgres": {"sslmode": "prefer"}}


class Source:
    """One kind of source.  ``load`` gives a table; ``identifier`` what SQL calls it."""

    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark, self.settings = spark, settings

    def load(self, database: str | None, table: str) -> DataFrame:
        return self.spark.table(self.identifier(database, table))

    def identifier(self, database: str | None, table: str) -> str:
        return f"{database}.{table}" if database else table

    def prepare(self, database: str | None, table: str) -> None:
        """Makes the table known to SQL by its identifier."""

    def ping(self) -> bool:
        return True


class CatalogSource(Source):
    """Tables and views that the session knows."""


class ViewSource(Source):
    """Sources that are registered as temporary views, each once.

    Views are known by (database, table); two that would share a view name are
    refused instead of one hiding the other.
    """

    def __init__(self, spark: SparkSession, settings: Settings):
        super().__init__(spark, settings)
        self._views: dict[str, tuple[str | None, str]] = {}
        self._lock = threading.Lock()

    def read(self, database: str | None, table: str) -> DataFrame:
        raise NotImplementedError

    def identifier(self, database: str | None, table: str) -> str:
        return files.view_name(table)

    def load(self, database: str | None, table: str) -> DataFrame:
        self.prepare(database, table)
        return self.spark.table(self.identifier(database, table))

    def prepare(self, database: str | None, table: str) -> None:
        if not table:
            raise ValueError("a source of this kind needs a table name")
        name = self.identifier(database, table)
        with self._lock:
            owner = self._views.get(name)
            if owner == (database, table):
                return
            if owner:
                raise ValueError(f"view {name} already stands for {owner}")
            self.read(database, table).createOrReplaceTempView(name)
            self._views[name] = database, table


class FileSource(ViewSource):
    """Files of a folder: the rule's database, or file_base_path."""

    def path(self, database: str | None, table: str) -> str:
        if table.startswith("/") or "://" in table:
            return table
        folder = database or self.settings.file_base_path
        return f"{folder.rstrip('/')}/{table}" if folder else table

    def read(self, database: str | None, table: str) -> DataFrame:
        return files.read(self.spark, self.path(database, table), self.settings.file_encoding, self.settings.max_file_mb, multiline=self.settings.file_multiline)


class ObjectStoreSource(ViewSource):
    """Keys and globs under a prefix, the rule's database; name=value folders become columns."""

    def read(self, database: str | None, table: str) -> DataFrame:
        if not database:
            raise ValueError("an object store needs a prefix, as the database")
        prefix = database.rstrip("/").replace("s3://", "s3a://", 1)
        return files.read(self.spark, f"{prefix}/{table.lstrip('/')}", self.settings.file_encoding, self.settings.max_file_mb, prefix, self.settings.file_multiline)

    @staticmethod
    def configure(spark: SparkSession, env: Mapping[str, str]) -> None:
        """Credentials from S3_* or AWS_* variables; an endpoint means path-style addresses."""
        get = lambda name: env.get(f"S3_{name}") or env.get(f"AWS_{name}")
        conf = spark._jsc.hadoopConfiguration()
        for key, value in (("access.key", get("ACCESS_KEY_ID")), ("secret.key", get("SECRET_ACCESS_KEY")), ("session.token", get("SESSION_TOKEN")), ("endpoint.region", get("REGION")), ("endpoint", get("ENDPOINT"))):
            if value:
                conf.set(f"fs.s3a.{key}", value)
        if get("ENDPOINT"):
            conf.set("fs.s3a.path.style.access", "true")


class JdbcSource(ViewSource):
    """Tables of a database by JDBC; filters and columns are pushed down.

    With split_column, a table that has it is read by ``splits`` tasks, each a
    range of its values from the least to the greatest; otherwise by one.
    """

    def __init__(self, spark: SparkSession, settings: Settings, url: str, options: Mapping[str, str] | None = None, split_column: str | None = None, splits: int = 8):
        super().__init__(spark, settings)
        self.url, self.options = url, dict(options or {})
        self.split_column, self.splits = split_column, splits

    def identifier(self, database: str | None, table: str) -> str:
        return files.view_name(f"{database}_{table}" if database else table)

    def read(self, database: str | None, table: str) -> DataFrame:
        name = f"{database}.{table}" if database else table
        reader = self.spark.read.format("jdbc").options(url=self.url, **self.options)
        whole = reader.option("dbtable", name).load()
        column = next((c for c in whole.columns if self.split_column and c.lower() == self.split_column.lower()), None)
        if column is None:
            return whole
        # The database itself finds the ends of the ranges.
        quoted = self.spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url).quoteIdentifier(column)
        low, high = self.spark.read.format("jdbc").options(url=self.url, query=f"SELECT MIN({quoted}) AS low, MAX({quoted}) AS high FROM {name}", **self.options).load().first()
        if low is None:
            return whole
        return reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=self.splits).load()

    def ping(self) -> bool:
        return self.spark.read.format("jdbc").options(url=self.url, query="SELECT 1 AS one", **self.options).load().count() == 1


class SourceResolver:
    """Sources by type; a type that could not be built is logged and absent."""

    def __init__(self, spark: SparkSession, settings: Settings | None = None, env: Mapping[str, str] | None = None):
        self.spark, self.settings = spark, settings or Settings()
        self._sources: dict[str, Source] = {}
        self._env = dict(env or {})
        self.register("spark", CatalogSource(spark, self.settings))
        self.register("file", FileSource(spark, self.settings))
        self._builders = {"s3": self._object_store, "teradata": self._jdbc, "postgres": self._jdbc}
        for name, build in self._builders.items():
            try:
                if source := build(name, env or {}):
                    self.register(name, source)
            except Exception:
                log.exception("source %s is not available", name)

    def _object_store(self, name: str, env: Mapping[str, str]) -> Source:
        ObjectStoreSource.configure(self.spark, env)
        return ObjectStoreSource(self.spark, self.settings)

    def _jdbc(self, name: str, env: Mapping[str, str]) -> Source | None:
        start = f"DQ_{name.upper()}_"
        if not (url := env.get(f"{start}URL")):
            return None
        given = {k.lower(): env[f"{start}{k}"] for k in ("USER", "PASSWORD", "DRIVER", "LOGMECH", "SSLMODE", "FETCHSIZE") if env.get(f"{start}{k}")}
        return JdbcSource(self.spark, self.settings, url, {**JDBC_DEFAULTS[name], **given}, env.get(f"{start}SPLIT_COLUMN"), int(env.get(f"{start}SPLITS") or 8))

    def register(self, name: str, source: Source) -> None:
        self._sources[name.lower()] = source

    def live(self, name: str | None) -> Source | None:
        """The source, if it answers; one that does not is built anew once, and None if that does not answer either."""
        key = (name or "spark").lower()
        for again in (False, True):
            if again and key in self._builders:
                try:
                    if (fresh := self._builders[key](key, self._env)) is not None:
                        self.register(key, fresh)
                except Exception:
                    log.exception("source %s could not be built anew", key)
            source = self._sources.get(key)
            try:
                if source is not None and source.ping():
                    return source
            except Exception as e:
                log.warning("source %s does not answer: %s", key, type(e).__name__)
        return None

    def get(self, name: str | None) -> Source | None:
        return self._sources.get((name or "spark").lower())

    def names(self) -> list[str]:
        return sorted(self._sources)
