"""Exact and near duplicates, fingerprints."""

import hashlib
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from verdigris.llm import exact_dedup, fingerprint, near_dedup
from verdigris.llm.common import normal_space


def brute_exact(rows):
    import re

    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    none = 1 << 63
    keep, size = {}, {}
    for (i, _), t in zip(rows, norm, strict=True):
        keep[t] = min(keep.get(t, none), none if i is None else i)
        size[t] = size.get(t, 0) + 1
    return sorted(
        ((i, None if keep[t] == none else keep[t], size[t], (none if i is None else i) == keep[t], hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, norm, strict=True)), key=repr
    )


class TestExact:
    def test_awkward(self, table, awkward):
        rows = [*awkward, (20, "a  b"), (21, "a\tb"), (22, "a b "), (23, "a b")]
        assert sorted((tuple(r) for r in exact_dedup.classify(table(rows)).collect()), key=repr) == brute_exact(rows)

    def test_large_group(self, table):
        rows = [(i, "same") for i in range(1000)] + [(i + 1000, f"t{i % 7}") for i in range(50)]
        assert sorted((tuple(r) for r in exact_dedup.classify(table(rows)).collect()), key=repr) == brute_exact(rows)

    def test_collisions(self, table):
        """With digests of one of three values, bytes decide."""
        rows = [(i, f"text {i % 11}") for i in range(90)]
        weak = lambda t: F.unhex(F.hex(F.pmod(F.xxhash64(t), F.lit(3))))
        got = exact_dedup.classify(table(rows), digest=weak).select("doc_id", "keep_id", "group_size", "kept").collect()
        assert sorted(map(tuple, got)) == sorted(r[:4] for r in brute_exact(rows))

    def test_deduplicate(self, table, awkward):
        df = table([*awkward, (7, "other text of seven")], more="__digest")
        kept = exact_dedup.deduplicate(df)
        assert kept.columns == df.columns
        rows = kept.collect()
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(["1", "3", "4", "5", "None", "7", "7", "9", "10"])
        assert all(r["__digest"] == "kept" for r in rows)
        assert exact_dedup.deduplicate(table([])).count() == exact_dedup.classify(table([])).count() == 0

    def test_filter_passes_over_single_rows(self, table):
        """Of 3,000 rows with 20 copies only the copies, and few others, are looked up."""
        rows = table([(i, f"text {i}") for i in range(3000)] + [(5000 + i, f"text {i}") for i in range(20)])
        norm = rows.select(F.col("doc_id").alias("id"), normal_space(F.col("text")).alias("norm"))
        index = exact_dedup.DigestIndex()
        run = index.flush(norm)
        index.compact()
        assert index.filter.agg(F.sum(F.bitmap_count("bits"))).first()[0] == 20
        found = {r["id"]: (r["keep_id"], r["group_size"]) for r in index.lookup(run).collect()}
        assert len(found) == 3020 and all(found[i] == ((i, 2) if i < 20 else (i, 1)) for i in range(3000)) and all(found[5000 + i] == (i, 2) for i in range(20))
        plan = index.lookup(run)._jdf.queryExecution().optimizedPlan().toString()
        assert "bits" in plan and plan.index("Union") < plan.index("shiftright")

    def test_index_grows(self, spark, table):
        index = exact_dedup.DigestIndex()
        rows = lambda some: table(some).select(F.col("doc_id").alias("id"), normal_space(F.col("text")).alias("norm"))
        index.flush(rows([(5, "a"), (6, "b")]))
        index.compact()
        index.flush(rows([(3, "a"), (9, "c")]))
        index.flush(rows([(8, "c")]))
        index.compact()
        assert {(r["keep_id"], r["group_size"]) for r in index.probe(["a", "c", "none"]).collect()} == {(3, 2), (8, 2)}

    def test_sql(self, spark, tmp_path, table, awkward):
        table([r for r in awkward if r[0] is not None]).write.parquet(f"{tmp_path}/documents.parquet")
        duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = duckdb.sql(exact_dedup.OP1_SQL)
        got = exact_dedup.op1_exact_dedup(spark, str(tmp_path))
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def shingles(t):
    w = (t or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def weighted(texts):
    """Each text's shingles with their weights, counted in all texts."""
    split = [(t or "").lower().split() for t in texts]
    sets = [Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter() for w in split]
    seen = Counter(x for s in sets for x in s)

    def idf(x):
        share = min(max(seen[x] / len(texts), near_dedup.RARE), 1)
        fall = (1 - near_dedup.LEAST_IDF) * math.log(share / near_dedup.RARE) / math.log(1 / near_dedup.RARE)
        return 1 - round(fall * near_dedup.IDF_STEPS / (1 - near_dedup.LEAST_IDF)) * (1 - near_dedup.LEAST_IDF) / near_dedup.IDF_STEPS

    return [{x: (1 + math.log(n)) * idf(x) for x, n in s.items()} for s in sets]


def brute_classes(rows, threshold=0.8):
    """Class of each row by comparing all pairs of weighted and of plain sets."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets, weights = [shingles(t) for _, t in rows], weighted([t for _, t in rows])
    sums = [sum(w.values()) for w in weights]

    def near(i, j):
        a, b = sets[i], sets[j]
        if not a or not b or (n := len(a & b)) < len(a | b) / 2:
            return False
        least = sum(min(weights[i][x], weights[j][x]) for x in a & b)
        return max(n / len(a | b), least / (sums[i] + sums[j] - least)) >= threshold - 1e-9

    for i in range(len(rows)):
        for j in range(i):
            alike = (rows[i][1] or "") == (rows[j][1] or "") or near(i, j)
            if alike or rows[i][0] == rows[j][0]:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 63), 1 << 63 if k is None else k)
    return sorted(((k, None if least[find(i)] == 1 << 63 else least[find(i)]) for i, (k, _) in enumerate(rows)), key=repr)


def changed(text, n, rng):
    words = text.split(" ")
    for k in rng.sample(range(len(words)), n):
        words[k] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


class TestNear:
    def test_families(self, table, prose):
        rng, rows = random.Random(3), []
        for f in range(6):
            base = prose(400, 100 + f)
            rows += [(len(rows) + k, changed(base, k % 5, rng)) for k in range(3)]
        star = prose(500, 999)
        rows += [(1000 + k, changed(star, 6, rng)) for k in range(120)] + [(2000, star)]
        rows += [(3000 + k, prose(300, 5000 + k)) for k in range(30)]
        got = sorted((tuple(r)[:2] for r in near_dedup.classify(table(rows)).collect()), key=repr)
        want = brute_classes(rows)
        assert got == want
        assert len({c for i, c in got if 1000 <= i <= 2000}) == 1

    @pytest.mark.parametrize(("n", "words", "edits", "block"), [(150, 500, 7, near_dedup.BLOCK_TEXTS), (150, 500, 7, 40), (150, 400, 5, 40), (300, 1000, 12, near_dedup.BLOCK_TEXTS)])
    def test_family_without_its_original(self, table, prose, monkeypatch, n, words, edits, block):
        """Edited copies that are alike in few pairs: no centre is near them all."""
        monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", block)
        rng, base = random.Random(4), prose(words, 998)
        rows = [(k, changed(base, edits, rng)) for k in range(n)]
        want = brute_classes(rows)
        assert sorted((tuple(r)[:2] for r in near_dedup.classify(table(rows)).collect()), key=repr) == want
        assert len({c for _, c in want}) < n

    @pytest.mark.parametrize("few", [0, 100_000])
    def test_spread_joins_change_nothing(self, spark, few, monkeypatch):
        """A key with half of all rows, others with few, and one that the counts leave out."""
        from verdigris.llm import common

        monkeypatch.setattr(common, "FEW_ROWS", few)
        left = spark.range(4000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 ELSE id END AS k", "id AS v")
        right = spark.range(3500).selectExpr("id AS k", "id * 2 AS w").union(spark.createDataFrame([(7, 14)], "k long, w long"))
        counts = left.groupBy("k").agg(F.count("*").alias("n")).filter("k <> 1")
        for how in ("inner", "left"):
            got = common.join_spread(left, right, "k", "v", counts, how, ("w",))
            want = left.join(right.distinct(), "k", how)
            assert got.columns == want.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0

    def test_awkward(self, table, awkward):
        got = sorted((tuple(r)[:2] for r in near_dedup.classify(table(awkward)).collect()), key=repr)
        assert got == brute_classes(awkward)
        assert near_dedup.classify(table([])).count() == near_dedup.deduplicate(table([])).count() == 0

    def test_boilerplate_and_repeats_are_no_links(self, table, prose):
        passage, line = prose(60, 77), "the same line again.\n" * 300
        rows = [(k, prose(100, 200 + k) + "\n" + (passage if k % 2 else line)) for k in range(60)]
        got = near_dedup.classify(table(rows))
        assert got.filter("kept").count() == 60

    def test_deduplicate(self, table, prose):
        base = prose(300, 8)
        rng = random.Random(1)
        rows = [(5, base), (3, changed(base, 2, rng)), (9, base), (1, prose(200, 9)), (3, changed(base, 1, rng))]
        df = table(rows)
        kept = near_dedup.deduplicate(df)
        assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]

    def test_shingles_are_those_of_words(self, prose):
        given = [prose(n, n) for n in (1, 4, 5, 6, 300)] + ["", None, "a b c d", "A  b\tc\nd", "one " * 50]
        s = near_dedup.Shingles(pa.array(given))
        for i, t in enumerate(given):
            assert s.bounds[i + 1] - s.bounds[i] == len(shingles(t))
        hashes = lambda i: set(s.hash[s.bounds[i] : s.bounds[i + 1]].tolist())
        assert hashes(7) == hashes(8)

    def test_samples_estimate_weighted_similarity(self, prose):
        rng = np.random.default_rng(0)
        words = prose(2000, 4).split()
        gaps = []
        for share in (50, 200, 800):
            other = list(words)
            for k in rng.choice(len(words), share // 5, replace=False):
                other[k] = f"n{rng.integers(1e9)}"
            s = near_dedup.Shingles(pa.array([" ".join(words), " ".join(other)]))
            w = near_dedup.Weights(rng.integers(0, 100, (near_dedup.DEPTH, 1 << near_dedup.WIDTH_BITS)), 100).of(s)
            part = lambda i: (s.hash[s.bounds[i] : s.bounds[i + 1]], w[s.bounds[i] : s.bounds[i + 1]])  # noqa: B023, E731
            sampled = near_dedup.samples(s, w)
            gaps.append((sampled[0] == sampled[1]).mean() - near_dedup.similarities(*part(0), *part(1))[0])
        assert max(map(abs, gaps)) < 0.2 and abs(np.mean(gaps)) < 0.1

    def test_components(self, spark):
        rng = random.Random(2)
        edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1040)]
        parent = {n: n for e in edges for n in e}

        def find(n):
            while parent[n] != n:
                n = parent[n]
            return n

        for a, b in edges:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        got = dict(map(tuple, near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()))
        assert all(got.get(n, n) == find(n) for n in parent)
        assert near_dedup.components(spark.createDataFrame([], "a long, b long")).count() == 0


class TestFingerprints:
    def test_multiset(self):
        a = fingerprint.fingerprint("one line\nand another. With two\nlast")
        assert np.array_equal(a, fingerprint.fingerprint("last\none line\nand another. With two"))
        assert not np.array_equal(a, fingerprint.fingerprint("one line\nand another. With two\nlast\nlast"))
        assert np.array_equal(fingerprint.insert(a, "new part"), fingerprint.fingerprint("new part\none line\nand another. With two\nlast"))
        assert np.array_equal(fingerprint.delete(a, "last"), fingerprint.fingerprint("one line\nand another. With two"))

    def test_likeness(self, prose):
        print_ = fingerprint.fingerprint
        base = prose(2000, 1)
        half = base[: len(base) // 2] + prose(1000, 2)
        assert fingerprint.likeness(print_(base), print_(base)) == 1.0
        assert 0.3 < fingerprint.likeness(print_(base), print_(half)) < 0.7
        assert fingerprint.likeness(print_(base), print_(prose(2000, 3))) < 0.3
        assert fingerprint.likeness(print_(""), print_(None)) == 1.0 and fingerprint.likeness(print_(""), print_(base)) == 0.0

    @pytest.mark.parametrize("times", [1000, 40_000, 65_536, 200_000])
    def test_one_line_many_times(self, times):
        line = "the same line\n"
        whole, other = line * times, line * (times - times // 2) + "another\n" * (times // 2)
        print_ = fingerprint.fingerprint
        assert print_(whole).any() and not np.array_equal(print_(whole), print_(""))
        assert 0.6 < fingerprint.likeness(print_(whole), print_(other)) < 0.95
        assert np.array_equal(fingerprint.delete(print_(whole), "the same line"), print_(line * (times - 1)))

    @pytest.mark.parametrize("n", [1, 3, 50])
    @pytest.mark.parametrize("first", [0, 1 << 60, -(1 << 60)])
    def test_edited_follows_ids(self, table, prose, n, first):
        rng = random.Random(n)
        rows = [(first + k, prose(rng.randrange(0, 90), k)) for k in rng.sample(range(-100, 100), 120)]
        rows += [(rows[7][0], None), (rows[7][0], "again"), (rows[9][0], rows[9][1]), (first + 1000, "last 🙂"), (first + 1000, "last 🙂")]
        got = sorted((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_next"]) for r in fingerprint.edited(table(rows), n=n).collect())
        order, want = sorted((i, t or "") for i, t in rows), []
        for (i, t), (_, following) in zip(order, order[1:] + order[:1], strict=True):
            half = len(t) // 2
            made, print_ = t[: len(t) - half] + following[:half], fingerprint.fingerprint
            want.append((i, len(t), hashlib.sha256(made.encode()).hexdigest(), fingerprint.to_text(print_(t)), fingerprint.to_text(print_(made)), fingerprint.likeness(print_(t), print_(following))))
        assert got == sorted(want)

    def test_awkward(self, table, awkward):
        got = fingerprint.edited(table(awkward)).collect()
        assert len(got) == len(awkward) and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
        assert {r["fingerprint"] for r in got if r["doc_id"] in (7, 8)}.__len__() == 1
        assert fingerprint.edited(table([])).count() == fingerprint.fingerprints(table([])).count() == 0
        alone = fingerprint.edited(table([(1, "only one")])).collect()
        assert alone[0]["near_next"] == 1.0
        assert fingerprint.fingerprints(table(awkward)).count() == len(awkward)
