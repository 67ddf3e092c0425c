"""Stratified samples: candidates, their leaves, and who is selected."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys, quota, templating
from ..plans.scratch import scratch
from . import ordering

#: So many leaves at most are broadcast.
BROADCAST_LEAVES = 100_000
METHODS = ("RANKED", "RANDOM", "SYSTEMATIC")


@dataclass(frozen=True)
class Level:
    strata_id: int
    level_order: int
    stratify_expr: str
    level_name: str = ""
    mix: Mapping[str, float] = field(default_factory=dict)

    @property
    def column(self) -> str:
        return f"_strata_{self.strata_id}"


def candidates(universe: DataFrame, key_columns: Sequence[str], levels: Sequence[Level], scope: str | None = None, exclusion: str | None = None, priority: str | None = None, method: str = "RANKED", seed: int | None = None, params: Mapping[str, object] | None = None, random_mode: str = "seeded") -> DataFrame:
    """case_key, the levels' buckets, _rank (place in the order) and _pos (place in its leaf) of every candidate.

    A candidate is in scope and not excluded; an exclusion that is null excludes.
    RANKED and SYSTEMATIC need a priority; ties fall to the keys.  RANDOM
    without one is ordered by the keys, and with random_mode ``hash`` by a hash
    of seed and key, which needs no permutation on the driver.
    """
    if method not in METHODS:
        raise ValueError(f"unknown sampling method {method!r}")
    if not priority and method != "RANDOM":
        raise ValueError(f"{method} needs a priority")
    if not key_columns:
        raise ValueError("a sample needs key columns")
    fill = lambda sql: templating.substitute(sql, params)
    df = universe.filter(F.expr(fill(scope) or "1=1"))
    if exclusion:
        df = df.filter(~F.expr(fill(exclusion)))
    order = ordering.order_columns(fill(priority)) if priority else []
    cols = {lv.column: F.coalesce(keys.text(F.expr(lv.stratify_expr), df.select(F.expr(lv.stratify_expr)).schema[0].dataType), F.lit(keys.NULL_BUCKET)) for lv in levels}
    df = df.withColumns({"case_key": keys.key_column(df, list(key_columns)), **cols})
    if method == "RANDOM" and random_mode == "hash":
        order = [F.md5(F.concat(F.lit(f"{seed}|"), "case_key"))]
    # Sort columns go along under their own names, as the order's expressions read them.
    keyed = [F.col(c) for c in key_columns]
    sort = {f"_o{i}": o for i, o in enumerate([*_plain(order, fill(priority) if not (method == "RANDOM" and random_mode == "hash") else None), *keyed])}
    df = df.select("case_key", *cols, *[c.alias(n) for n, c in sort.items()])
    ways = ordering.split_terms(fill(priority)) if priority and not (method == "RANDOM" and random_mode == "hash") else []
    by = [ordering.order_columns(_renamed(w, f"_o{i}"))[0] for i, w in enumerate(ways)] + [F.col(n) for n in list(sort)[len(ways) :]]
    return ordering.placed(df, by, list(cols), label="candidates").drop(*sort)


def _plain(order: list, priority: str | None) -> list:
    """The order's expressions without their directions."""
    if priority is None:
        return order
    return [F.expr(ordering._TERM.match(t)[1]) for t in ordering.split_terms(priority)]


def _renamed(term: str, name: str) -> str:
    m = ordering._TERM.match(term)
    return " ".join([name, m[2] or "", f"NULLS {m[3]}" if m[3] else ""])


@dataclass
class Selection:
    #: case_key and _order of each selected row; the rows' order in the sample.
    rows: DataFrame
    selected: int
    candidates: int
    by_stratum: dict[str, dict[str, int]]


def select(pool: DataFrame, levels: Sequence[Level], target: int, method: str, rounding: str | None = "FLOOR", rng: random.Random | None = None, random_mode: str = "seeded") -> Selection:
    """Quotas for every leaf, selection in it, top-up of a shortfall, and truncation.

    Only the counts of the leaves, and in seeded random draws the drawn places,
    are on the driver.  A draw permutes places, not rows: the same seed draws
    the same rows as shuffling the rows would.
    """
    rng = rng or random.Random(0)
    spark = pool.sparkSession
    cols = [lv.column for lv in levels]
    counted = pool.groupBy(*cols).agg(F.count("*").alias("n")).collect() if cols else [{"n": pool.count()}]
    counts = {tuple(r[c] for c in cols): r["n"] for r in counted if r["n"]}
    plan = quota.leaves(counts, [lv.mix for lv in levels], target, rounding)
    by_stratum = {leaf.name: {"candidates": leaf.size, "selected": leaf.chosen} for leaf in plan}
    chosen = _leaf_rows(pool, cols, plan, method, rng, random_mode)
    chosen = scratch(chosen.select("case_key", "_leaf", "_in_leaf", "_rank"), "chosen")
    n = sum(leaf.chosen for leaf in plan)
    if n < target:
        rest = pool.join(chosen.select("case_key").distinct(), "case_key", "left_anti")
        more = _top_up(rest, target - n, method, rng, random_mode, len(plan))
        chosen = chosen.unionByName(more)
    chosen = scratch(chosen.orderBy("_leaf", "_in_leaf").limit(target), "selected")
    return Selection(chosen.select("case_key", F.struct("_leaf", "_in_leaf").alias("_order")), chosen.count(), sum(counts.values()), by_stratum)


def _leaf_rows(pool: DataFrame, cols: list[str], plan: list[quota.Leaf], method: str, rng: random.Random, random_mode: str) -> DataFrame:
    """The rows of pool that the leaves select, with _leaf and _in_leaf, their order."""
    spark = pool.sparkSession
    drawn: list[tuple[int, int, int]] = []
    rows = []
    for i, leaf in enumerate(plan):
        step = offset = None
        if method == "SYSTEMATIC" and (found := quota.systematic(leaf.size, leaf.target, rng)):
            step, offset = found
        if method == "RANDOM" and random_mode == "seeded":
            drawn += [(i, place, k) for k, place in enumerate(quota.shuffled(leaf.size, leaf.target, rng))]
        rows.append((i, *leaf.path, leaf.target, step, offset))
    kinds = ", ".join(["_leaf int", *(f"_b{k} string" for k in range(len(cols))), "_target long", "_step long", "_offset long"])
    leaves = spark.createDataFrame([r for r in rows if len(r) == len(cols) + 4], kinds)
    on = F.lit(True)
    for k, c in enumerate(cols):
        on = on & (F.col(c) == F.col(f"_b{k}"))
    # The leaves are as many as there are distinct buckets together, and were collected above; strata by a key have many.
    leaves = F.broadcast(leaves) if len(rows) <= BROADCAST_LEAVES else leaves
    held = pool.join(leaves, on) if cols else pool.withColumns({"_leaf": F.lit(0), "_target": F.lit(plan[0].target).cast("long"), "_step": F.lit(rows[0][-2]).cast("long"), "_offset": F.lit(rows[0][-1]).cast("long")})
    pos = F.col("_pos")
    if method == "RANDOM" and random_mode == "seeded":
        places = spark.createDataFrame(drawn, "_leaf int, _pos long, _in_leaf long")
        return held.join(places, ["_leaf", "_pos"])
    if method == "SYSTEMATIC":
        gone = pos - (F.col("_offset") - 1)
        every = (gone >= 0) & (gone % F.col("_step") == 0) & (gone / F.col("_step") < F.col("_target"))
        taken = F.when(F.col("_step").isNull(), pos < F.col("_target")).otherwise(every)
    else:
        taken = pos < F.col("_target")
    return held.filter(taken).withColumn("_in_leaf", pos)


def _top_up(rest: DataFrame, shortfall: int, method: str, rng: random.Random, random_mode: str, leaf: int) -> DataFrame:
    """Candidates of any leaf to fill up to the target, by the run's own method in the order of rank."""
    named = lambda df: df.select("case_key", F.lit(leaf).alias("_leaf"), "_in_leaf", "_rank")
    if method == "RANKED" or random_mode == "hash" and method == "RANDOM":
        return named(rest.orderBy("_rank").limit(shortfall).withColumn("_in_leaf", F.col("_rank")))
    again = ordering.placed(rest.select("case_key", F.col("_rank").alias("_was")), [F.col("_was")], label="rest").drop("_rank").withColumnRenamed("_was", "_rank")
    size = rest.count()
    plan = [quota.Leaf((), size, shortfall)]
    return named(_leaf_rows(again, [], plan, method, rng, random_mode).drop("_leaf"))


def attributes(pool: DataFrame, levels: Sequence[Level]) -> DataFrame:
    """case_key, strata_id, level_order, bucket_value: a row for each candidate and level."""
    each = [F.struct(F.lit(lv.strata_id).alias("strata_id"), F.lit(lv.level_order).alias("level_order"), F.col(lv.column).alias("bucket_value")) for lv in levels]
    if not each:
        return pool.sparkSession.createDataFrame([], "case_key string, strata_id int, level_order int, bucket_value string")
    return pool.select("case_key", F.explode(F.array(*each)).alias("a")).select("case_key", "a.*")
