"""Mixing, URL filters, SentencePiece, the pipeline."""

import itertools
import math
import os
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from verdigris.llm import exact_dedup, mixing, near_dedup, sentencepiece_codec, toxicity, url_filter
from verdigris.llm.common import tables


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, limited = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in limited]
        left = total - sum(2 * sizes[s] for s in limited)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in limited else share[s] for s in names}
        limited |= over


class TestMixing:
    def rows(self, prose, n=400):
        rng = random.Random(1)
        return [(i, prose(rng.randrange(0, 80), i), rng.choice(["a", "b", "c", "d", None, "Ä"] + ["hot"] * 4)) for i in range(n)]

    def test_plan(self, prose, table):
        rows = self.rows(prose)
        got = mixing.schedule(table(rows)).collect()
        sizes: dict = {}
        for _, t, s in rows:
            sizes[s] = sizes.get(s, 0) + words(t)
        want, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
        for r in got:
            assert r["size"] == words(dict((i, t) for i, t, _ in rows)[r["id"]]) and r["source_size"] == sizes[r["source"]]
            assert r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["copies"] <= 2
            taken[r["source"]] += r["copies"] * r["size"]
        assert all(abs(taken[s] - want[s]) <= 160 for s in sizes)
        assert sum(taken.values()) <= 1.5 * sum(sizes.values())
        key = lambda rs: sorted((r["id"], r["copies"]) for r in rs)
        assert key(got) == key(mixing.schedule(table(rows).repartition(7)).collect())

    @pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5}, {"a": 1, "b": 1, "c": 1, "d": 10**6}, {"x": 7}, {"a": 0, "b": 5}, {None: 3, "a": 4}])
    def test_targets(self, spark, sizes):
        got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        assert {r["source"]: pytest.approx(r["target"]) for r in got} == brute_targets(sizes)

    def test_sql(self, spark, tmp_path, prose, table):
        table([(i, t, s) for i, t, s in self.rows(prose)] + [(900, None, "a"), (901, "", "new")]).write.parquet(f"{tmp_path}/documents.parquet")
        duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = duckdb.sql(mixing.OP6_SQL)
        got = mixing.op6_mixing(spark, str(tmp_path))
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())

    def test_mix(self, table, awkward, prose):
        df = table([*((i, t, "a") for i, t in awkward), (50, prose(20, 3), "b"), (50, prose(20, 3), "b")], more="__copies")
        mixed = mixing.mix(df)
        assert mixed.columns == df.columns
        plan = {(r["id"], r["print"]): r["copies"] for r in mixing.schedule(df).collect()}
        assert mixed.count() >= sum(plan.values())
        assert mixing.mix(table([])).count() == mixing.schedule(table([])).count() == 0
        assert mixing.mix(table([(1, None), (2, "")])).count() == 0


URLS = [
    "https://a.example.com/en/1", "https://example.com/en/7", "http://EXAMPLE.com/en/79?x=1#f", "https://x.net/de/8", "https://example.net/de/8", "http://sub.example.net/de/", "http://org/es/", "http://myorg/es/1",
    "https://b.example.com/fr/1", "no scheme", "", None, "https://h", "https://h?q=/en/", "https://h#/en/", "ftp://u:p@WWW.Example.ORG:80/es/x/y", "http://a.b://c/de/", "https://casino-win.example.com/en/2?utm=1",
]


class TestUrls:
    def pages(self, spark, n=300):
        rng = random.Random(2)
        more = [f"http{rng.choice(['', 's'])}://{rng.choice(['www.', 'm.', ''])}{rng.choice(['good', 'bad-bets', 'x'])}.example.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'de', 'es', 'fr'])}/{rng.randrange(99)}{rng.choice(['', '.html', '?page=2&ref=x', '#top'])}" for _ in range(n)]
        return spark.createDataFrame(list(enumerate(URLS + more + more[:20])), "page_id long, url string").withColumn("html", F.lit("x"))

    def test_rules(self, spark):
        for r in url_filter.judge(self.pages(spark, 0)).join(self.pages(spark, 0), "page_id").collect():
            u = r["url"] or ""
            rest = u.split("://", 1)[1] if "://" in u else ""
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
            fits = [x for x in url_filter.RULES if (host == x[0] or host.endswith(f".{x[0]}")) and path.startswith(x[1])]
            best = max(fits, key=lambda x: len(x[0] + x[1]), default=None)
            assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[0] + best[1]), u
            if best:
                assert (r["verdict"], r["decided_by"]) == (best[2], "rule")

    def test_sql(self, spark, tmp_path):
        self.pages(spark).write.parquet(f"{tmp_path}/pages.parquet")
        duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        want = duckdb.sql(url_filter.OP8_SQL)
        got = url_filter.op8_url_filter(spark, str(tmp_path))
        assert sorted(map(repr, map(tuple, got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))
        assert got.filter("decided_by = 'mined'").count() > 0

    def test_given_labels(self, spark):
        labelled = [(f"http://bad-bets.com/{i}", "block") for i in range(40)] + [(f"http://news.org/{i}", "allow") for i in range(40)]
        labelled = spark.createDataFrame(labelled, "url string, label string")
        pages = spark.createDataFrame([(1, "http://www.bad-bets.com/x"), (2, "http://news.org/y"), (3, "http://other.io/"), (3, "http://other.io/")], "page_id long, url string")
        got = url_filter.judge(pages, rules=(), labelled=labelled).collect()
        assert sorted((r["page_id"], r["verdict"], r["decided_by"]) for r in got) == [(1, "block", "mined"), (2, "allow", "mined"), (3, "allow", "default"), (3, "allow", "default")]

    def test_rules_of_many_tokens(self, spark):
        """Only all four query keys together tell a label: any three of them come with either."""
        keys = ["a", "b", "c", "d"]
        url = lambda some: "http://x.io/?" + "&".join(f"{k}=1" for k in some)
        labelled = [(url(keys), "block")] * 40 + [(url([k for k in keys if k != x]), "allow") for x in keys for _ in range(20)]
        got = url_filter.judge(spark.createDataFrame([(1, url(keys) + "&e=1")], "page_id long, url string"), rules=(), labelled=spark.createDataFrame(labelled, "url string, label string"))
        assert [(r["verdict"], r["decided_by"], r["confidence"]) for r in got.collect()] == [("block", "mined", 1.0)]

    def test_items_of_several_tokens_change_no_rule(self, spark):
        """Against every combination of tokens, counted one by one."""
        rng = random.Random(11)
        sites = ["a.io", "b-c.org", "d.net"]
        urls = [f"http://{rng.choice(sites)}/{rng.choice('xy')}?" + "&".join(k + "=1" for k in rng.sample("klm", rng.randint(0, 3))) for _ in range(120)]
        labelled = [(u, "block" if ("k=1" in u and "b-c" in u) or rng.random() < 0.1 else "allow") for u in urls]
        asked = [(i, u) for i, u in enumerate({*urls, "http://b.org/x", "http://c.org/?k=2", "https://a.io/y?m"})]
        df = spark.createDataFrame(labelled, "url string, label string")
        got = {r["url"]: (r["label"], r["confidence"]) for r in url_filter.match(spark.createDataFrame(asked, "page_id long, url string"), url_filter.mine(df)).collect()}
        sets = {r[0]: frozenset(r[1]) for r in spark.createDataFrame([(u,) for u in {*urls, *(u for _, u in asked)}], "url string").select("url", url_filter.tokens(F.col("url"))).collect()}
        joint: dict = {}
        for u, label in labelled:
            for k in range(1, len(sets[u]) + 1):
                for some in itertools.combinations(sorted(sets[u]), k):
                    joint.setdefault(some, {}).setdefault(label, 0)
                    joint[some][label] += 1
        n, rules = len(labelled), []
        for some, by in joint.items():
            rules += [(c / sum(by.values()), c / n, label, frozenset(some)) for label, c in by.items() if c >= math.ceil(url_filter.MIN_SUPPORT * n) and c / sum(by.values()) >= url_filter.MIN_CONFIDENCE]
        for _, u in asked:
            best = max((r[:3] for r in rules if r[3] <= sets[u]), default=None)
            assert got.get(u) == (best and (best[2], best[0])), u

    def test_thirty_shared_keys(self, spark):
        """All URLs of a site carry the same thirty query keys: one item, not 2^30 itemsets."""
        query = "&".join(f"key{k}=1" for k in range(30))
        labelled = spark.createDataFrame([(f"http://shop.io/{'in' if i % 2 else 'out'}?{query}", "block" if i % 2 else "allow") for i in range(60)], "url string, label string")
        rules = url_filter.mine(labelled)
        assert rules.count() < 20
        pages = spark.createDataFrame([(1, "http://shop.io/in?key7=2"), (2, "http://shop.io/out"), (3, "ftp://none")], "page_id long, url string")
        got = url_filter.judge(pages, rules=(), labelled=labelled).collect()
        assert sorted((r["page_id"], r["verdict"], r["decided_by"]) for r in got) == [(1, "block", "mined"), (2, "allow", "mined"), (3, "allow", "default")]

    def test_long_urls_and_clashing_columns(self, spark):
        pages = spark.createDataFrame([(1, "http://a.com/en/" + "x/" * 50_000 + "?" + "k=1&" * 20_000, "h", "r", "f"), (2, None, "h", "r", "f")], "page_id long, url string, host string, rule string, fixed string")
        got = {r["page_id"]: r for r in url_filter.judge(pages).collect()}
        assert (got[1]["host"], got[1]["rule"], got[1]["verdict"]) == ("a.com", "com/en/", "block") and len(got[1]["path"]) == 100_004
        assert (got[2]["host"], got[2]["path"], got[2]["verdict"]) == ("", "", "allow")

    def test_empty(self, spark):
        pages = spark.createDataFrame([], "page_id long, url string")
        assert url_filter.judge(pages).count() == 0
        assert url_filter.mine(spark.createDataFrame([], "url string, label string")).count() == 0


needs_model = pytest.mark.skipif(not os.path.exists(sentencepiece_codec.MODEL), reason="no model file")
PIECES = ["▁", " ", "  ", "a", "aaa", "the", "<s>", "</s>", "<unk>", "<0x41>", "é", "日本", "🙂", "\n", "\t", "\x00", "ing", "1", "12", "   ", "zzz", "\ufeff"]


def unigram_model():
    """A small hand-made unigram model with byte fallback."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback, m.trainer_spec.unk_id = 1, True, 0
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.escape_whitespaces, m.normalizer_spec.remove_extra_whitespaces = "identity", True, True, False
    add = lambda piece, score, kind: m.pieces.add(piece=piece, score=score, type=kind)
    add("<unk>", 0, 2), add("<s>", 0, 3), add("</s>", 0, 3)
    for b in range(256):
        add(f"<0x{b:02X}>", 0, 6)
    for i, p in enumerate(["▁", "▁the", "the", "ing", "a", "aa", "▁a", "t", "h", "e", "i", "n", "g", "z"]):
        add(p, -1.0 - 0.37 * i, 1)
    return m.SerializeToString()


class TestSentencePiece:
    @needs_model
    def test_parity(self):
        import sentencepiece

        with open(sentencepiece_codec.MODEL, "rb") as f:
            raw = f.read()
        codec, plain = sentencepiece_codec.Codec(raw), sentencepiece.SentencePieceProcessor(model_proto=raw)
        rng = random.Random(1)
        texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
        ids, same = codec.encode(texts)
        whole = [e.ids for e in codec.tok.encode_batch(texts, add_special_tokens=False)]
        assert all(same) and ids == whole == plain.encode(texts)
        back = [plain.decode(x) for x in ids]
        assert codec.decode(ids) == back == codec.tok.decode_batch(ids, skip_special_tokens=False)
        assert [t for t, b in zip(texts, back, strict=True) if t.replace("▁", " ") != b] == []

    def test_unigram(self):
        import sentencepiece

        raw = unigram_model()
        codec, plain = sentencepiece_codec.Codec(raw), sentencepiece.SentencePieceProcessor(model_proto=raw)
        rng = random.Random(2)
        texts = ["".join(rng.choice(["the", "ing", "a", "aa", " ", "z", "é", "t", "n"]) for _ in range(rng.randint(0, 12))) for _ in range(500)]
        ids, same = codec.encode(texts)
        assert ids == [e.ids for e in codec.tok.encode_batch(texts, add_special_tokens=False)]
        assert same == [x == y for x, y in zip(ids, plain.encode(texts), strict=True)] and sum(same) / len(same) > 0.9  # ties apart
        assert codec.decode(ids) == texts

    @needs_model
    def test_tables(self, table, awkward):
        df = table(awkward)
        got = sentencepiece_codec.encode(df, keep=("source",))
        rows = got.collect()
        assert len(rows) == len(awkward) and all(r["parity"] and r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in rows)
        back = sentencepiece_codec.decode(got).collect()
        assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(i), t or "") for i, t in awkward)
        assert sentencepiece_codec.encode(table([])).count() == 0
        assert "token_ids" not in sentencepiece_codec.encode(df, ids=False).columns


    @needs_model
    def test_query_hands_over_ids(self, spark, tmp_path, table, awkward):
        table(awkward).write.parquet(f"{tmp_path}/documents.parquet")
        back = sentencepiece_codec.decode(sentencepiece_codec.op9_sentencepiece(spark, str(tmp_path))).collect()
        assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(i), t or "") for i, t in awkward)


@needs_model
def test_pipeline_against_its_stages_by_hand(spark, tmp_path, table, prose):
    """Documents with copies, near copies and insults, and what each stage must do to them."""
    rng = random.Random(9)
    clean = [(i, prose(rng.randrange(80, 200), i), f"s{i % 4}") for i in range(150)]
    bad = [(1000 + i, prose(60, 900 + i) + " you idiot moron", "s1") for i in range(60)]
    copies = [(2000 + i, clean[i][1].replace(" ", "  "), "s2") for i in range(20)]
    near = [(3000 + i, " ".join("x" if k == 40 else w for k, w in enumerate(clean[i][1].split(" "))), "s3") for i in range(20)]
    docs = table([*clean, *bad, *copies, *near])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i, *_ in clean] + [(i, 1, 1) for i, *_ in bad]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        seen.append((name, ids(now), now.columns))
    want = sorted(i for i, *_ in [*clean, *copies, *near])
    assert seen[0][1] == want and seen[1][1] == sorted(i for i, *_ in [*clean, *near]) and seen[2][1] == sorted(i for i, *_ in clean)
    assert all(s[2] == docs.columns for s in seen[:-1])
    mixed = seen[3][1]
    assert set(mixed) <= set(seen[2][1]) and max(mixed.count(i) for i in mixed) == 2
    assert seen[4][1] == mixed == ids(corpus_pipeline.run(spark, str(tmp_path)))
    assert {exact_dedup, near_dedup, mixing, sentencepiece_codec, toxicity}


@needs_model
def test_pipeline_of_awkward_rows(spark, tmp_path, table, awkward):
    """Nulls, empty and very long texts, ties, repeated rows, a clashing column; no labels at all; then no rows at all."""
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, rows in (("some", awkward), ("none", [])):
        folder = f"{tmp_path}/{name}"
        docs = table(rows, more="__score")
        docs.write.parquet(f"{folder}/documents.parquet")
        no_labels.write.parquet(f"{folder}/labels.parquet")
        before = tables(spark)
        got = [r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()]
        assert set(got) == ({4, None, 7, 9, 10} if rows else set())
        assert len(got) <= 2 * len(set(got))
        left = [t for t in tables(spark) if t not in before]
        assert len(left) == 1 and "/pipeline-" in left[0]
    now = spark.read.parquet(f"{tmp_path}/some/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, f"{tmp_path}/some")
        kept.append(sorted(str(r["doc_id"]) for r in now.collect()))
        assert now.columns == docs.columns
    assert kept[0] == sorted(str(i) for i, _ in awkward) and kept[1] == sorted(map(str, [1, 3, 4, 5, None, 7, 9, 10])) and kept[2] == sorted(map(str, [1, 3, 4, None, 7, 9, 10]))
