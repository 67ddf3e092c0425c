"""Sampling runs: configuration, selection, and what is kept of them."""

from __future__ import annotations

import logging
import random
import secrets
from collections.abc import Mapping

from pyspark.sql import functions as F

from ..functions import ids, keys
from ..operators import sampling as op
from ..sources.resolver import SourceResolver
from . import metastore as ms
from .scratch import scratch

log = logging.getLogger(__name__)
DEFAULT_TARGET = 150


def load_config(store: ms.MetaStore, config_id: int) -> tuple[dict, list[op.Level]]:
    """An active configuration and its strata levels in order; of a bucket named twice the last fraction holds."""
    rows = store.current(ms.SAMPLING_CONFIG).filter((F.col("config_id") == config_id) & (F.col("act_ind") == 1)).collect()
    if not rows:
        raise ValueError(f"no active sampling config {config_id}")
    strata = store.current(ms.SAMPLING_STRATA).filter(F.col("config_id") == config_id).orderBy("level_order").collect()
    mixes: dict[int, dict[str, float]] = {}
    of = [s["strata_id"] for s in strata]
    for m in store.current(ms.SAMPLING_MIX).filter(F.col("strata_id").isin(of)).orderBy("mix_id").collect() if of else []:
        mixes.setdefault(m["strata_id"], {})[m["bucket_value"]] = m["target_fraction"]
    return rows[0].asDict(), [op.Level(s["strata_id"], s["level_order"], s["stratify_expr"], s["level_name"] or "", mixes.get(s["strata_id"], {})) for s in strata]


def discover_configs(store: ms.MetaStore, project: str | None = None, process: str | None = None) -> list[int]:
    df = store.current(ms.SAMPLING_CONFIG).filter("act_ind = 1")
    for column, value in (("project_name", project), ("process_name", process)):
        if value:
            df = df.filter(F.col(column) == value)
    return [r[0] for r in df.select("config_id").orderBy("config_id").collect()]


class SamplingRunner:
    def __init__(self, store: ms.MetaStore, sources: SourceResolver, random_mode: str = "seeded"):
        """random_mode: ``seeded`` draws the places that shuffling the rows with the seed would; ``hash`` orders by a hash and keeps no permutation on the driver."""
        self.store, self.sources, self.random_mode = store, sources, random_mode

    def attempts(self, run_key: str, config_id: int) -> int:
        return self.store.current(ms.SAMPLING_AUDIT).filter((F.col("run_key") == run_key) & (F.col("sample_config_id") == config_id)).count()

    def _error(self, run_id: str, run_key: str, config: Mapping, kind: str, message: object) -> None:
        """Earlier attempts' errors of this run are no longer active; never raises."""
        try:
            old = self.store.current(ms.SAMPLING_ERRORS).filter((F.col("run_key") == run_key) & (F.col("run_id") != run_id) & (F.col("active_ind") == "Y"))
            if not old.isEmpty():
                self.store.change(ms.SAMPLING_ERRORS, scratch(old, "earlier"), active_ind="N", last_updated_datetime=F.lit(ms.now()).cast("timestamp_ntz"))
            self.store.append(ms.SAMPLING_ERRORS, [{
                "error_id": self.store.next_seq(), "run_id": run_id, "process_name": config.get("process_name"), "run_key": run_key, "error_type": kind,
                "error_message": ms.short(message), "active_ind": "Y", "occurred_at": ms.now(),
            }])
        except Exception:
            log.exception("config %s: the error could not be recorded", config.get("config_id"))

    def run(self, config_id: int, run_key: str | None = None, seed: int | None = None, params: Mapping | None = None, triggered_by: str = "SYSTEM") -> dict:
        run_key = run_key or ids.default_run_key()
        config, levels = load_config(self.store, config_id)
        method = (config["sampling_method"] or "RANKED").upper()
        if method not in op.METHODS:
            raise ValueError(f"unknown sampling method {method!r}")
        target = config["target_volume"] or DEFAULT_TARGET
        start = ms.now()
        run_id = ids.run_id(config["sample_name"] or f"config-{config_id}", run_key, f"attempt-{self.attempts(run_key, config_id) + 1}", triggered_by)
        seed = None if method == "RANKED" else secrets.randbits(63) if seed is None else seed

        def finish(status: str, found: int = 0, selected: int = 0, by_stratum: dict | None = None) -> dict:
            self.store.append(ms.SAMPLING_AUDIT, [{
                "run_id": run_id, "run_key": run_key, "sample_config_id": config_id, "sampling_method": method, "random_seed": seed, "target_volume": target, "total_candidates": found,
                "total_selected": selected, "started_at": start, "ended_at": ms.now(), "status": status, "triggered_by": triggered_by, "load_datetime": ms.now(),
            }])
            return {"sample_run_id": run_id, "status": status, "candidates": found, "selected": selected, "target_volume": target, "by_stratum": by_stratum or {}, "seed": seed}

        source = self.sources.get(config["source_type"])
        if source is None:
            self._error(run_id, run_key, config, "CONNECTION_UNAVAILABLE", f"no source {config['source_type']!r}")
            return finish("ERROR")
        database, _, name = (config["universe_table"] or "").rpartition(".")
        settings = self.sources.settings
        clean = {c: settings.env_tokens(config[c]) for c in ("scope_sql", "exclusion_sql", "priority_rank_sql")}
        try:
            universe = source.load(settings.database_name(database) or None, name)
            pool = op.candidates(universe, keys.split_columns(config["key_columns"]), levels, clean["scope_sql"], clean["exclusion_sql"], clean["priority_rank_sql"], method, seed, params, self.random_mode)
            pool = scratch(pool, "pool")
            found = pool.count()
        except Exception as e:
            self._error(run_id, run_key, config, "PULL_FAILURE", e)
            return finish("ERROR")
        if not found:
            return finish("COMPLETED")
        try:
            chosen = op.select(pool, levels, target, method, config["rounding_mode"], random.Random(seed), self.random_mode)
            self._persist(run_id, config, levels, pool, chosen, method, start)
        except Exception as e:
            self._error(run_id, run_key, config, "SELECT_PERSIST_FAILURE", e)
            return finish("ERROR", found)
        try:
            self._deactivate_earlier(config_id, run_key, run_id)
        except Exception as e:  # the sample stands
            self._error(run_id, run_key, config, "DEACTIVATE_PRIOR_RUNS_FAILURE", e)
        return finish("COMPLETED", found, chosen.selected, chosen.by_stratum)

    def _persist(self, run_id: str, config: Mapping, levels: list[op.Level], pool, chosen: op.Selection, method: str, start) -> None:
        """Every candidate, selected or not, and its bucket of every level.  All rows of a selected key are flagged."""
        when = F.lit(start).cast("timestamp_ntz")
        common = {"sample_run_id": F.lit(run_id), "etl_is_curr_ind": F.lit("Y"), "load_datetime": when, "last_updated_datetime": F.lit(None)}
        marked = pool.join(chosen.rows.select("case_key").distinct().withColumn("_selected", F.lit(1)), "case_key", "left")
        rank = F.col("_rank") if method != "RANDOM" or config["priority_rank_sql"] else F.lit(None)
        rows = marked.withColumns({
            **common, "config_id": F.lit(config["config_id"]), "project_name": F.lit(config["project_name"]), "process_name": F.lit(config["process_name"]), "sample_cycle": F.lit(start.date()),
            "priority_rank": rank, "selected_flag": F.coalesce("_selected", F.lit(0)), "excluded_flag": F.lit(0), "exclusion_reason": F.lit(None),
        })
        self.store.append(ms.SAMPLE_SELECTIONS, rows)
        if levels:
            self.store.append(ms.SAMPLE_ATTRS, op.attributes(pool, levels).withColumns(common))

    def _deactivate_earlier(self, config_id: int, run_key: str, run_id: str) -> int:
        audit = self.store.current(ms.SAMPLING_AUDIT).filter((F.col("sample_config_id") == config_id) & (F.col("run_key") == run_key) & (F.col("run_id") != run_id))
        earlier = [r[0] for r in audit.select("run_id").distinct().collect()]
        if earlier:
            when = F.lit(ms.now()).cast("timestamp_ntz")
            for table in (ms.SAMPLE_SELECTIONS, ms.SAMPLE_ATTRS):
                old = self.store.current(table, F.col("sample_run_id").isin(earlier)).filter("etl_is_curr_ind = 'Y'")
                if not old.isEmpty():
                    self.store.change(table, scratch(old, "earlier"), etl_is_curr_ind="N", last_updated_datetime=when)
        return len(earlier)

    def run_process(self, process: str, run_key: str | None = None, project: str | None = None, **options: object) -> dict[int, dict]:
        configs = discover_configs(self.store, project, process)
        if not configs:
            raise ValueError(f"no active sampling config for process {process!r}")
        run_key = run_key or ids.default_run_key()
        return {c: self.run(c, run_key, **options) for c in configs}
