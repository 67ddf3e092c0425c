"""Samples against a brute-force quota and draw, and runs on a store."""

import itertools
import math
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from verdigris.functions import quota
from verdigris.operators import ordering, sampling
from verdigris.plans import metastore as ms
from verdigris.plans.sampling import SamplingRunner, discover_configs, load_config
from verdigris.sources.resolver import SourceResolver

DEPOT_MIX = {"north": 0.45, "east": 0.25, "quay": 0.05}  # west and hub share the rest
SIZE_MIX = {"letter": 0.5, "crate": 0.2}
LEVELS = [sampling.Level(4, 1, "depot", "depot", DEPOT_MIX), sampling.Level(7, 2, "size_class", "size", SIZE_MIX)]
TOTAL, LOST = 840, 29  # every 29th parcel is lost


def parcels():
    """(parcel_id, depot, size_class, weight, lost): uneven strata by plain arithmetic, many equal weights."""
    depots = ("north", "north", "west", "east", "hub", "north", "west", "quay")
    sizes = ("letter", "crate", "tube", "letter", "box")
    return [(k, depots[(k * k + k // 3) % 8], sizes[(k * 7 + k // 11) % 5], (k * 13) % 17, k % LOST == 0) for k in range(TOTAL)]


KEPT = sorted((r for r in parcels() if not r[4]), key=lambda r: (-r[3], r[0]))


@pytest.fixture(scope="module")
def universe(spark):
    df = spark.createDataFrame(parcels(), "parcel_id long, depot string, size_class string, weight int, lost boolean")
    df = df.withColumn("week", F.lit("w31"))
    df.createOrReplaceTempView("parcel_universe")
    return df


def pool(universe, method="RANKED", levels=LEVELS, **more):
    return sampling.candidates(universe, ["parcel_id"], levels, "week = '{week}'", "lost", "weight DESC", method, params={"week": "w31"}, **more)


def quotas_by_hand(sizes, levels, target):
    """Leaf to target, floors all the way down: a table of shares for each level, multiplied out path by path."""
    out = {}
    for path in sorted(sizes):
        share = target
        for depth, level in enumerate(levels):
            beside = {p[depth] for p in sizes if p[:depth] == path[:depth]}
            named = level.mix.get(path[depth])
            left = (1.0 - math.fsum(level.mix.values())) / len(beside - set(level.mix)) if named is None else None
            share = share if not level.mix else math.floor(share * (left if named is None else named) + 1e-9)
        out[path] = share
    return out


def test_quotas(universe):
    sizes = Counter(r[1:3] for r in KEPT)
    want = quotas_by_hand(sizes, LEVELS, 200)
    got = sampling.select(pool(universe), LEVELS, 200, "RANKED")
    assert got.by_stratum == {"/".join(p): {"candidates": sizes[p], "selected": min(n, sizes[p])} for p, n in want.items()}
    assert (got.candidates, got.selected, got.rows.distinct().count()) == (len(KEPT), 200, 200)


def test_bucket_targets_over_a_grid():
    """The rest is divided among the unmixed buckets before it is multiplied by the total, whatever that does to floats."""
    ways = {"FLOOR": math.floor, "CEIL": math.ceil, "ROUND": round, None: math.floor, "other": math.floor}
    seen = 0
    for total, first, second, unmixed in itertools.product(range(0, 400, 7), range(0, 101, 5), (0, 10, 35, 80), (1, 2, 3, 7)):
        mix = {"a": first / 100} | ({"b": second / 100} if second else {})
        for mode, way in ways.items():
            each = max(0.0, 1.0 - sum(mix.values())) / unmixed
            assert quota.bucket_target("z", mix, total, mode, unmixed) == max(0, way(total * each))
            assert quota.bucket_target("a", mix, total, mode, unmixed) == max(0, way(total * (first / 100)))
            seen += 1
    assert seen > 43_092
    assert quota.bucket_target("z", {"a": 0.4}, 10, "FLOOR", 3) == 1  # 10 * 0.6 / 3 would be 2
    assert quota.bucket_target("z", {}, 10, "FLOOR", 3) == 10


def drawn_by_hand(method, rows, n, rng):
    """The rows themselves, drawn as each method says."""
    n = max(0, min(n, len(rows)))
    if method == "RANDOM" and n:
        rows = list(rows)
        rng.shuffle(rows)
    if method == "SYSTEMATIC" and 0 < n < len(rows):
        every = len(rows) // n
        first = rng.randint(1, every)
        rows = [r for at, r in enumerate(rows, 1) if at >= first and (at - first) % every == 0]
    return rows[:n]


@pytest.mark.parametrize("method", sampling.METHODS)
@pytest.mark.parametrize(("target", "levels"), [(200, LEVELS), (45, LEVELS[:1]), (805, LEVELS), (31, [])])
def test_same_rows_as_drawing_them_one_by_one(universe, method, target, levels):
    leaves: dict = {}
    for r in KEPT:
        leaves.setdefault(r[1 : 1 + len(levels)], []).append(r)
    rng, want = random.Random(19), []
    for path, n in quotas_by_hand(Counter({p: len(rows) for p, rows in leaves.items()}), levels, target).items():
        want += drawn_by_hand(method, leaves[path], n, rng)
    taken = set(want)
    want += drawn_by_hand(method, [r for r in KEPT if r not in taken], target - len(want), rng)
    got = sampling.select(pool(universe, method, levels), levels, target, method, rng=random.Random(19))
    assert {r["case_key"] for r in got.rows.collect()} == {f"parcel_id={r[0]}" for r in want[:target]}


def test_hash_mode_is_stable(universe):
    draw = lambda seed: {r[0] for r in sampling.select(pool(universe, "RANDOM", seed=seed, random_mode="hash"), LEVELS, 200, "RANDOM", random_mode="hash").rows.select("case_key").collect()}
    assert draw(1) == draw(1) != draw(2)


def test_null_buckets_and_exclusions(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", "x", None), ("c", "x", 0)], "k string, s string, e int")
    got = sampling.candidates(df, ["k"], [sampling.Level(1, 1, "s")], None, "e = 1", "k", "RANKED").collect()
    assert [(r["case_key"], r["_strata_1"]) for r in got] == [("k=c", "x")]
    got = sampling.candidates(df, ["k"], [sampling.Level(1, 1, "s")], None, None, "k", "RANKED").collect()
    assert {r["_strata_1"] for r in got} == {"None", "x"}


def test_refusals(universe):
    with pytest.raises(ValueError, match="method"):
        pool(universe, "BEST")
    with pytest.raises(ValueError, match="priority"):
        sampling.candidates(universe, ["parcel_id"], [], priority=None)
    with pytest.raises(ValueError, match="key"):
        sampling.candidates(universe, [], [], priority="weight")


def test_order_text():
    assert ordering.split_terms("CASE WHEN a IN (1, 2) THEN 0 ELSE 1 END, coalesce(b, ',') DESC NULLS LAST") == ["CASE WHEN a IN (1, 2) THEN 0 ELSE 1 END", "coalesce(b, ',') DESC NULLS LAST"]


def test_places(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS g", "(id * 37) % 1000 AS v")
    got = {r["id"]: (r["_rank"], r["_pos"]) for r in ordering.placed(df, ordering.order_columns("v DESC"), ["g"], parts=13).collect()}
    seen: dict = {}
    for rank, i in enumerate(sorted(range(1000), key=lambda i: -((i * 37) % 1000)), 1):
        assert got[i] == (rank, seen.get(i % 7, 0))
        seen[i % 7] = seen.get(i % 7, 0) + 1


@pytest.fixture
def runner(spark, universe, tmp_path):
    def build(**config):
        store = ms.MetaStore(spark, f"file://{tmp_path}/{uuid.uuid4().hex}")
        store.append(ms.SAMPLING_CONFIG, [{"config_id": 1, "act_ind": 1, "project_name": "P", "process_name": "W", "sample_name": "parcels", "source_type": "spark", "universe_table": "parcel_universe", "key_columns": "parcel_id", "scope_sql": "week = '{week}'", "exclusion_sql": "lost", "target_volume": 200, "sampling_method": "RANKED", "priority_rank_sql": "weight DESC", "rounding_mode": "FLOOR", **config}])
        store.append(ms.SAMPLING_STRATA, [{"strata_id": lv.strata_id, "config_id": 1, "level_order": lv.level_order, "level_name": lv.level_name, "stratify_expr": lv.stratify_expr} for lv in LEVELS])
        mixed = [(lv.strata_id, b, f) for lv in LEVELS for b, f in lv.mix.items()]
        store.append(ms.SAMPLING_MIX, [{"mix_id": k, "strata_id": i, "bucket_value": b, "target_fraction": f} for k, (i, b, f) in enumerate(mixed)])
        return SamplingRunner(store, SourceResolver(spark))

    return build


def test_run(runner):
    r = runner()
    out = r.run(1, "K", params={"week": "w31"})
    assert (out["status"], out["candidates"], out["selected"], out["seed"]) == ("COMPLETED", len(KEPT), 200, None)
    rows = r.store.current(ms.SAMPLE_SELECTIONS)
    assert rows.count() == len(KEPT) and rows.filter("selected_flag = 1").count() == 200
    assert r.store.current(ms.SAMPLE_ATTRS).count() == 2 * len(KEPT)
    again = r.run(1, "K", params={"week": "w31"})
    assert "attempt-2" in again["sample_run_id"]
    current = r.store.current(ms.SAMPLE_SELECTIONS).filter("etl_is_curr_ind = 'Y'")
    assert current.count() == len(KEPT) and current.select("sample_run_id").distinct().first()[0] == again["sample_run_id"]


def test_seeds(runner):
    r = runner(sampling_method="RANDOM")
    params = {"week": "w31"}
    picked = lambda run: {x[0] for x in r.store.current(ms.SAMPLE_SELECTIONS).filter(f"sample_run_id = '{run['sample_run_id']}' AND selected_flag = 1").select("case_key").collect()}
    a = r.run(1, "K", params=params)
    b = r.run(1, "K", seed=a["seed"], params=params)
    assert a["seed"] is not None and picked(a) == picked(b) and len(picked(a)) == 200


@pytest.mark.parametrize(("config", "kind"), [({"source_type": "oracle"}, "CONNECTION_UNAVAILABLE"), ({"scope_sql": "x = '{missing}'"}, "PULL_FAILURE"), ({"priority_rank_sql": None}, "PULL_FAILURE"), ({"key_columns": "nope"}, "PULL_FAILURE")])
def test_failures(runner, config, kind):
    r = runner(**config)
    assert r.run(1, "K", params={"week": "x"})["status"] == "ERROR"
    assert [e["error_type"] for e in r.store.current(ms.SAMPLING_ERRORS).collect()] == [kind]
    assert [a["status"] for a in r.store.current(ms.SAMPLING_AUDIT).collect()] == ["ERROR"]


def test_nothing_to_sample(runner):
    r = runner(target_volume=0)
    out = r.run(1, "K", params={"week": "w0"})
    assert (out["status"], out["candidates"], out["target_volume"], out["by_stratum"]) == ("COMPLETED", 0, 150, {})


def test_configs(runner):
    r = runner()
    config, levels = load_config(r.store, 1)
    assert config["sample_name"] == "parcels" and [lv.mix for lv in levels] == [DEPOT_MIX, SIZE_MIX]
    assert discover_configs(r.store, process="W") == [1] and discover_configs(r.store, project="Q") == []
    with pytest.raises(ValueError, match="2"):
        load_config(r.store, 2)
    with pytest.raises(ValueError, match="method"):
        runner(sampling_method="BEST").run(1)
    with pytest.raises(ValueError, match="no active"):
        r.run_process("none")
    assert r.run_process("W", "K", params={"week": "w31"})[1]["selected"] == 200
