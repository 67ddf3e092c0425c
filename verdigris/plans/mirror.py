"""A mirror of the metadata tables: whole copies of the small ones, changes of the others."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import metastore as ms

log = logging.getLogger(__name__)
WATERMARK = ms.Table("mirror_watermark", ("table_name",), "table_name string, watermark timestamp_ntz, row_count long, synced_at timestamp_ntz")
EPOCH = dt.datetime(1970, 1, 1)


def changed(rows: DataFrame, table: ms.Table, since: dt.datetime, lookback_minutes: int) -> DataFrame:
    """Rows whose watermark is not before ``since`` less the lookback, or which may still change.  A null watermark is no change."""
    mark = F.expr(table.watermark) >= F.lit(since - dt.timedelta(minutes=lookback_minutes)).cast("timestamp_ntz")
    return rows.filter(F.coalesce(mark, F.lit(False)) | F.coalesce(F.expr(table.reopen or "false"), F.lit(False)))


def upserted(old: DataFrame, new: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """old with the rows of new in place of those of the same key.  If the key is all there is, old rows stay."""
    if set(key) == set(old.columns):
        return old.unionByName(new.join(old, list(key), "left_anti"))
    return old.join(new, list(key), "left_anti").unionByName(new)


class Mirror:
    """Copies ``source`` to ``target``, another store of the same layout.

    An upsert there is an appended version; a whole copy is written beside the
    old one and takes its place in one step, so a copy that fails changes nothing.
    """

    def __init__(self, source: ms.MetaStore, target: ms.MetaStore, lookback_minutes: int = 60):
        self.source, self.target, self.lookback = source, target, lookback_minutes

    def watermark(self, table: ms.Table) -> dt.datetime:
        found = self.target.current(WATERMARK).filter(F.col("table_name") == table.name).collect()
        return found[0]["watermark"] if found and found[0]["watermark"] else EPOCH

    def full_refresh(self, table: ms.Table, dry_run: bool = False) -> int:
        rows = self.source.current(table)
        n = rows.count()
        if not dry_run:
            self.target.replace(table, rows)
            self._mark(table, self.watermark(table), n)
        return n

    def incremental(self, table: ms.Table, dry_run: bool = False) -> int:
        since = self.watermark(table)
        rows = changed(self.source.current(table), table, since, self.lookback)
        seen = rows.agg(F.count("*").alias("n"), F.max(F.expr(table.watermark)).alias("high")).first()
        if not dry_run:
            if seen["n"]:
                self.target.append(table, rows, "U")
            self._mark(table, max(since, seen["high"] or since), seen["n"])
        return seen["n"]

    def _mark(self, table: ms.Table, watermark: dt.datetime, n: int) -> None:
        self.target.append(WATERMARK, [{"table_name": table.name, "watermark": watermark, "row_count": n, "synced_at": ms.now()}], "U")

    def sync(self, tables: list[str] | None = None, full: bool = False, dry_run: bool = False) -> dict[str, int | str]:
        """Rows copied by table, or ERROR; a table that fails does not stop the others."""
        names = tables or list(ms.TABLES)
        if unknown := [n for n in names if n not in ms.TABLES]:
            raise ValueError(f"no table {', '.join(unknown)}")
        out: dict[str, int | str] = {}
        for n in names:
            table = ms.TABLES[n]
            try:
                out[n] = self.incremental(table, dry_run) if table.incremental and not full else self.full_refresh(table, dry_run)
            except Exception:
                log.exception("table %s was not mirrored", n)
                out[n] = "ERROR"
        return out
