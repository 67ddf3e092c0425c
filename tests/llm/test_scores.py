"""Classifiers: held-out accuracy, calibration, awkward rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdigris.llm import quality, toxicity
from verdigris.llm.common import calibrated, isotonic

BAD = ["idiot", "moron", "worthless", "pathetic", "scumbag"]


def toxic_docs(prose, n, seed=0):
    rng, rows = random.Random(seed), []
    for i in range(n):
        words, bad = prose(rng.randrange(20, 200), seed * 10_000 + i).split(" "), rng.random() < 0.3
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_isotonic():
    x = np.array([1.0, 2, 3, 4, 5, 6])
    knots = isotonic(x, np.array([0.0, 1, 0, 1, 1, 1]))
    values = np.interp(x, *knots)
    assert (np.diff(values) >= 0).all() and values[0] < 0.5 < values[-1] < 1
    assert (np.diff(calibrated(np.linspace(-40, 40, 9), knots)) >= 0).all()


class TestToxicity:
    def test_training(self, prose):
        rows, fresh = toxic_docs(prose, 600), toxic_docs(prose, 200, 1)
        model = toxicity.train([t for _, t, _ in rows], [y for *_, y in rows])
        s, y = model.scores([t for _, t, _ in fresh]), np.array([y for *_, y in fresh])
        assert (s[y == 1] >= toxicity.THRESHOLD).mean() > 0.95 and (s[y == 0] < toxicity.THRESHOLD).all()
        long = prose(20_000, 3)
        assert model.scores([long + " you moron " + long])[0] >= toxicity.THRESHOLD > model.scores([long])[0]
        unseen = model.scores(["pathetiic kana", "wortless kana", "kana lora"])
        assert unseen[0] > unseen[2] and unseen[1] > unseen[2]

    def test_one_kind_of_label(self):
        assert toxicity.train([], []).scores(["x", ""]).max() < 0.01
        assert toxicity.train(["a", "b"], [1, 1]).scores(["x"])[0] > 0.9

    def test_windows_match_single_words(self, prose):
        w = np.random.default_rng(1).normal(size=1 << toxicity.BITS)
        texts = ["one two three four two", "", "  ", "solo", "a\nlonger  line of Words, ÜNÏ code 🙂 here", "x y"]
        best = toxicity.Bags(texts).best(w)
        mean = lambda x: w[rows].mean() if len(rows := toxicity.bags_of([x])[0]) else 0.0
        for t, got in zip(texts, best, strict=True):
            parts = t.split()
            words = sorted({mean(x) for x in parts}, reverse=True)[: toxicity.TOP]
            pairs = [mean(f"{x} {y}") for x, y in zip(parts, parts[1:], strict=False)]
            shown = [*words, *sorted(pairs)[-1:]]
            least = min([0, *shown])
            want = words + [least] * (toxicity.TOP - len(words)) + [max(pairs, default=least)]
            if "  line" not in t:  # n-grams over two spaces are of no pair
                assert np.allclose(got, want, atol=1e-5), t
        assert [len(x) for x in toxicity.bags_of(["solo", "solo two", "a"])] == [len(toxicity.bags_of([x])[0]) for x in ("solo", "solo two", "a")]

    def test_two_harmless_words_can_be_an_insult(self):
        """Each word is in as many clean texts as toxic ones; only their neighbourhood tells."""
        rng = random.Random(8)
        filler = ["lorem", "dolor", "amet", "tempor", "magna", "aliqua", "veniam", "nostrud", "laboris", "nisi"]

        def text(insult):
            words = [rng.choice(filler) for _ in range(rng.randint(20, 60))]
            at = rng.sample(range(2, len(words), 3), 2)
            words[at[0]], words[at[1]] = ("green potato", rng.choice(filler)) if insult else ("green", "potato")
            return " ".join(words)

        y = [i % 4 == 0 for i in range(900)]
        model = toxicity.train([text(k) for k in y], list(map(int, y)))
        new = [i % 2 == 0 for i in range(300)]
        found = model.scores([text(k) for k in new]) >= 0.5
        assert np.mean(found == np.array(new)) > 0.95

    def test_query(self, spark, tmp_path, prose, table, awkward):
        rows = toxic_docs(prose, 500)
        extra = [(10_000 + i, t) for i, (_, t) in enumerate(awkward)] + [(None, "idiot")]
        table([r[:2] for r in rows] + extra).write.parquet(f"{tmp_path}/documents.parquet")
        labels = [(i, 1, y) for i, _, y in rows] + [(1, 1, None), (77_777, 1, 1), (None, 1, 0)]
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        got = {r["doc_id"]: r for r in toxicity.op4_toxicity(spark, str(tmp_path)).collect()}
        y = {i: y for i, _, y in rows}
        for i in y:
            assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        held = [i for i in y if got[i]["held_out"]]
        assert np.mean([got[i]["predicted"] == y[i] for i in held]) > 0.95
        assert got[None]["held_out"] is False and all(0 <= r["score"] <= 1 for r in got.values())
        assert got[10_001]["predicted"] == 0  # the empty text

    def test_sample_is_bounded_and_stable(self, spark, prose, table):
        rows = toxic_docs(prose, 100)
        docs, labels = table([r[:2] for r in rows]), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
        take = lambda **k: toxicity.sample(docs, labels, "toxic", lambda i: F.lit(True), **k)
        assert len(take(max_rows=10)) == 10 and take(max_rows=10) == take(max_rows=10)
        assert sum(len(t) for _, t, _ in take(max_chars=5000)) <= 5000
        assert take(max_rows=0) == []

    def test_long_texts_cost_only_themselves(self, spark, table):
        short = [(k, f"text {k}") for k in range(30)]
        long = [(100 + k, "x" * 6000) for k in range(30)]
        labels = spark.createDataFrame([(i, 1, 0) for i, _ in short + long], "doc_id long, quality int, toxic int")
        got = toxicity.sample(table(short + long), labels, "toxic", lambda i: F.lit(True), max_rows=30, max_chars=5000)
        assert [i for i, *_ in got] == [i for i, _ in short]

    def test_query_against_brute_force(self, spark, tmp_path, prose, table):
        """The query's scores are those of a model trained here on the same rows, text by text."""
        rows = [(i, prose(40, i) + (" you moron" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(200)]
        table([r[:2] for r in rows]).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
        model = toxicity.train([t for _, t, _ in learned], [y for *_, y in learned])
        got = {r["doc_id"]: r for r in toxicity.op4_toxicity(spark, str(tmp_path)).collect()}
        for i, t, y in rows:
            want = model.scores([t])[0]
            assert abs(got[i]["score"] - want) < 1e-4 and got[i]["predicted"] == (got[i]["score"] >= 0.7) == bool(y)

    def test_scores_replace_a_column_of_their_name(self, spark):
        model = toxicity.Model(np.zeros(1 << toxicity.BITS), np.zeros(toxicity.TOP + 2), (np.zeros(1), np.zeros(1)))
        df = spark.createDataFrame([("a", 5.0)], "text string, Score double")
        assert toxicity.with_score(df, model).columns == ["text", "score"]

    def test_reject_keeps_columns(self, table):
        model = toxicity.Model(np.zeros(1 << toxicity.BITS), np.zeros(toxicity.TOP + 2), (np.zeros(1), np.zeros(1)))
        df = table([(1, "a"), (2, None)], more="__score")
        kept = toxicity.reject(df, model)
        assert kept.columns == df.columns and kept.count() == 2
        assert toxicity.reject(table([]), model).count() == 0


def quality_docs(prose, n):
    rng, rows = random.Random(4), []
    for i in range(n):
        t, bad = prose(rng.randrange(30, 300), i), rng.random() < 0.2
        if bad:
            t = rng.choice([t.upper().replace(" ", "!! "), " | ".join(t.split()), "\n".join([t.split("\n")[0]] * 30), "### ".join(t.split())])
        rows.append((i, t, int(not bad)))
    return rows


class TestQuality:
    def test_query_against_brute_force(self, spark, tmp_path, prose, table):
        """Statistics, sample, ridge, isotonic and threshold of all rows at once, on one machine."""
        rows = quality_docs(prose, 400)
        table([r[:2] for r in rows]).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        got = {r["doc_id"]: r["score"] for r in quality.op2_quality(spark, str(tmp_path)).collect()}
        stats = quality.statistics([t for _, t, _ in rows]).astype(np.float32).astype(float)
        learned = np.array([zlib.crc32(str(i).encode()) % 5 != 0 for i, *_ in rows])
        hashed = {r[0]: r[1] for r in spark.createDataFrame([(i,) for i, *_ in rows], "id long").select("id", F.pmod(F.xxhash64("id"), F.lit(quality.FOLDS))).collect()}
        fold = np.array([hashed[i] for i, *_ in rows])[learned]
        x, y = stats[learned], np.array([y for *_, y in rows], float)[learned]
        model = quality.Model(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6))
        phi = model.features(x)
        ridge = lambda a, b: np.linalg.solve(a.T @ a + quality.RIDGE * max(len(a), 1.0) * np.eye(a.shape[1]) / quality.FEATURES, a.T @ b)
        model.weights = ridge(phi, y)
        crossed = np.zeros(len(y))
        for k in range(quality.FOLDS):
            crossed[fold == k] = phi[fold == k] @ ridge(phi[fold != k], y[fold != k])
        model.knots = quality.isotonic(crossed, y)
        want = model.scores(stats)
        assert np.allclose([got[i] for i, *_ in rows], want, atol=1e-4)

    def test_query(self, spark, tmp_path, prose, table, awkward):
        rows = quality_docs(prose, 600)
        extra = [(10_000 + i, t) for i, (_, t) in enumerate(awkward)] + [(None, "x")]
        table([r[:2] for r in rows] + extra).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(3, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        result = quality.op2_quality(spark, str(tmp_path)).collect()
        got, y = {r["doc_id"]: r for r in result}, {i: y for i, _, y in rows}
        assert len(result) == len(rows) + len(extra) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in result)
        held = [i for i in y if zlib.crc32(str(i).encode()) % 5 == 0]
        assert held == [i for i in sorted(y) if got[i]["held_out"]]
        assert np.mean([got[i]["predicted"] == y[i] for i in held]) > 0.95

    def test_statistics(self):
        s = quality.statistics(["", "Ab 12!! a a\n\nAb 12!! a a", "x"])
        at = dict(zip(quality.STATS, s[1], strict=True))
        assert (s[0] == 0).all() and at["log_words"] == np.log1p(8) and at["repeated_lines"] == 0.5 and at["distinct_words"] == 3 / 8 and at["echoes"] == 2 / 8
        together, alone = quality.statistics(["one two.", "three\nfour"]), [quality.statistics([t])[0] for t in ("one two.", "three\nfour")]
        assert np.allclose(together, alone)

    def test_without_labels(self, spark, table):
        none = spark.createDataFrame([], "doc_id long, quality int")
        assert {r["score"] for r in quality.score(table([(1, "a"), (2, None)]), none).collect()} == {0.5}
        assert quality.score(table([]), none).count() == 0
        one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
        assert min(r["score"] for r in quality.score(table([(1, "a"), (2, "b c"), (3, "d")]), one, use=lambda i: F.lit(True)).collect()) > 0.5

    def test_sums_of_parts_are_the_whole(self, spark, prose, table):
        """The distributed normal equations give the ridge solution of all rows at once."""
        rows = quality_docs(prose, 300)
        stats = quality.with_statistics(table([r[:2] for r in rows]))
        labels = spark.createDataFrame([(i, y) for i, _, y in rows], "id long, y int")
        model = quality.fit(stats.withColumnRenamed("doc_id", "id").join(labels, "id"))
        x = np.array([r["stats"] for r in stats.orderBy("doc_id").collect()], float)
        phi, y = model.features(x), np.array([y for *_, y in rows], float)
        a = phi.T @ phi
        want = np.linalg.solve(a + quality.RIDGE * a[-1, -1] * np.eye(len(a)) / quality.FEATURES, phi.T @ y)
        assert np.allclose(phi @ model.weights, phi @ want, atol=1e-6)
