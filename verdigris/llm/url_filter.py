"""Op 8, URL filters: fixed host and path rules, and rules mined from labels by FP-growth.

A URL is a set of tokens: scheme, host labels and their hyphenated words, path
segments with digits as #, query keys, and whether it has a fragment.  FP-growth
mines token combinations of labelled URLs; those that imply a label with enough
support and confidence become rules.  An inverted index holds each rule under
its rarest token, so a URL meets only rules that share that token with it, and a
rule matches if all its tokens are there.  Of several matches the one with the
highest confidence, then support, decides; a URL without any is allowed.

Tokens that always come together in labelled URLs are one item for FP-growth, as
every combination that differs only in which of them it holds has the same
support and confidence; a URL has the item if it has any of them, which matches
just where some of those combinations would.  So thirty query keys that one
site's URLs share cost one item, not 2^30 itemsets.  Tokens that come together
mostly, but not always, still count as several.

The labelled URLs of the query are those that a fixed rule judges.  Everything
is DataFrame functions and Spark's FP-growth.  Frequent items are at most (mean
tokens of a URL) / min_support, so what FP-growth keeps on the driver does not
grow with the input.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
no tokens, and is allowed; repeated URLs are judged alike; without labelled
URLs nothing is mined; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_checked, table, written

#: (host, path, verdict) of the query's fixed rules.
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
MIN_SUPPORT = 0.02
MIN_CONFIDENCE = 0.9
_LABEL = "label="
RULE = "need array<array<string>>, label string, confidence double, support double, key array<string>"


def host(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def fixed_rule(host_: Column, path_: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host_ == h) | host_.endswith(f".{h}")) & path_.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def tokens(url: Column) -> Column:
    """The URL's distinct tokens."""
    whole = F.coalesce(url, F.lit(""))
    pieces = lambda text, by: F.filter(F.split(text, by), lambda x: x != "")
    tagged = lambda tag, items: F.transform(items, lambda x: F.concat(F.lit(tag), x))
    labels = pieces(host(url), r"\.")
    words = F.flatten(F.transform(F.filter(labels, lambda x: x.contains("-")), lambda x: F.split(x, "-")))
    keys = F.transform(pieces(F.regexp_extract(whole, r"://[^?#]*\?([^#]*)", 1), "&"), lambda x: F.substring_index(x, "=", 1))
    scheme = F.when(whole.contains("://"), F.array(F.concat(F.lit("s:"), F.substring_index(whole, "://", 1)))).otherwise(F.array().cast("array<string>"))
    fragment = F.when(whole.rlike("://[^#]*#"), F.array(F.lit("f:"))).otherwise(F.array().cast("array<string>"))
    segments = F.transform(pieces(path(url), "/"), lambda x: F.regexp_replace(x, "[0-9]+", "#"))
    return F.array_distinct(F.concat(scheme, tagged("h:", labels), tagged("w:", F.filter(words, lambda x: x != "")), tagged("p:", segments), tagged("q:", keys), fragment))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """need, label, confidence, support, key of the rules mined from rows (url, label).

    need: items, each the list of its tokens, any of which will do; key: the
    tokens of its rarest item.
    """
    spark = labelled.sparkSession
    rows = labelled.select(F.monotonically_increasing_id().alias("row"), "label", tokens(F.col("url")).alias("tokens"))
    rows = written(rows, "url-labelled")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], RULE)
    each = rows.select("row", "label", F.explode_outer("tokens").alias("token"))
    # Tokens of one set of rows have one signature of it.
    signed = each.groupBy("token").agg(F.count("*").alias("freq"), F.bit_xor(F.xxhash64("row")).alias("s1"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("s2"))
    often = signed.filter((F.col("freq") >= F.lit(min_support * n)) & F.col("token").isNotNull())
    items = often.groupBy("freq", "s1", "s2").agg(F.array_sort(F.collect_list("token")).alias("any"))
    items = written(items.select(F.col("any")[0].alias("item"), "any", "freq"), "url-items")
    of = items.select("item", F.explode("any").alias("token"))
    # Frequent tokens are at most tokens of a URL / min_support.
    held = each.join(F.broadcast(of), "token", "left").groupBy("row", "label").agg(F.collect_set("item").alias("items"))
    baskets = written(held.select(F.array_append("items", F.concat(F.lit(_LABEL), "label")).alias("items")), "url-baskets")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.filter((F.size("consequent") == 1) & F.col("consequent")[0].startswith(_LABEL) & ~F.exists("antecedent", lambda x: x.startswith(_LABEL)))
    rules = rules.select(F.array_sort("antecedent").alias("need"), F.substring(F.col("consequent")[0], len(_LABEL) + 1, 1 << 20).alias("label"), "confidence", "support")
    parts = rules.select("*", F.explode("need").alias("item")).join(F.broadcast(items), "item")
    whole = parts.groupBy("need", "label", "confidence", "support").agg(F.collect_list("any").alias("all"), F.min(F.struct("freq", "any"))["any"].alias("key"))
    return written(whole.select(F.col("all").alias("need"), "label", "confidence", "support", "key"), "url-rules")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, label, confidence of the best rule for each distinct url that any rule matches."""
    held = urls.select("url").distinct().select("url", tokens(F.col("url")).alias("has"))
    asked = held.select("url", "has", F.explode("has").alias("token"))
    index = rules.select("*", F.explode("key").alias("token"))
    met = join_checked(asked, index, "token", "inner").filter(F.forall("need", lambda some: F.arrays_overlap(some, "has")))
    best = met.groupBy("url").agg(F.max(F.struct("confidence", "support", "label")).alias("best"))
    return best.select("url", F.col("best.label").alias("label"), F.col("best.confidence").alias("confidence"))


def judge(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """id, host, path, rule, verdict, decided_by (rule, mined or default), confidence (of the mined rule) for each row of df.

    labelled: rows (url, label) to mine from; by default the URLs that the fixed rules judge.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    rows = rows.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url"))).withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        labelled = rows.filter("fixed IS NOT NULL").select("url", F.col("fixed.verdict").alias("label"))
    best = match(rows.filter("fixed IS NULL AND url IS NOT NULL"), mine(labelled))
    out = rows.join(best, "url", "left")
    by_rule = F.col("fixed").isNotNull()
    return out.select(
        F.col("id").alias(id_col), "host", "path", F.col("fixed.rule").alias("rule"),
        F.coalesce(F.col("fixed.verdict"), "label", F.lit("allow")).alias("verdict"),
        F.when(by_rule, "rule").when(F.col("label").isNotNull(), "mined").otherwise("default").alias("decided_by"),
        F.when(~by_rule, F.col("confidence")).alias("confidence"),
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


OP8_SQL = """
WITH RECURSIVE parsed AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(h, p, verdict) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), fixed AS (
  SELECT x.*, (SELECT arg_max(h || p, length(h || p)) FROM rules WHERE (x.host = h OR ends_with(x.host, '.' || h)) AND starts_with(x.path, p)) AS rule
  FROM parsed x
), judged AS (
  SELECT f.*, r.verdict AS fixed_verdict FROM fixed f LEFT JOIN rules r ON f.rule = r.h || r.p
), urls AS (
  SELECT DISTINCT url, host, path, regexp_extract(url, '://[^?#]*[?]([^#]*)', 1) AS query FROM judged
), tokens AS (
  SELECT url, 's:' || split_part(url, '://', 1) AS token FROM urls WHERE contains(url, '://')
  UNION SELECT url, 'h:' || x FROM (SELECT url, unnest(string_split(host, '.')) AS x FROM urls) WHERE x <> ''
  UNION SELECT url, 'w:' || x FROM (SELECT url, unnest(string_split(l, '-')) AS x FROM (SELECT url, unnest(string_split(host, '.')) AS l FROM urls) WHERE contains(l, '-')) WHERE x <> ''
  UNION SELECT url, 'p:' || regexp_replace(x, '[0-9]+', '#', 'g') FROM (SELECT url, unnest(string_split(path, '/')) AS x FROM urls) WHERE x <> ''
  UNION SELECT url, 'q:' || split_part(x, '=', 1) FROM (SELECT url, unnest(string_split(query, '&')) AS x FROM urls) WHERE x <> ''
  UNION SELECT url, 'f:' FROM urls WHERE regexp_matches(url, '://[^#]*#')
), labelled AS (
  SELECT row_number() OVER () AS n, url, fixed_verdict AS label FROM judged WHERE fixed_verdict IS NOT NULL
), least AS (
  SELECT ceil(0.02::DOUBLE * count(*)) AS rows FROM labelled
), items AS (
  SELECT n, label, token FROM labelled JOIN tokens USING (url)
  WHERE token IN (SELECT token FROM labelled JOIN tokens USING (url) GROUP BY token HAVING count(*) >= (SELECT rows FROM least))
), combos AS (
  SELECT n, label, [token] AS need, token AS last FROM items
  UNION ALL SELECT c.n, c.label, list_append(c.need, i.token), i.token FROM combos c JOIN items i ON c.n = i.n AND i.token > c.last
), counted AS (
  SELECT need, label, count(*) AS joint, sum(count(*)) OVER (PARTITION BY need) AS alone FROM combos GROUP BY need, label
), mined AS (
  SELECT need, label, joint::DOUBLE / alone::DOUBLE AS confidence, joint::DOUBLE / (SELECT count(*) FROM labelled) AS support
  FROM counted WHERE joint >= (SELECT rows FROM least) AND joint::DOUBLE / alone::DOUBLE >= 0.9
), held AS (
  SELECT url, list(token) AS has FROM tokens WHERE url IN (SELECT url FROM judged WHERE rule IS NULL) GROUP BY url
), best AS (
  SELECT url, max({'confidence': confidence, 'support': support, 'label': label}) AS best
  FROM held JOIN mined ON list_has_all(has, need) GROUP BY url
)
SELECT page_id, host, path, rule, coalesce(fixed_verdict, b.best.label, 'allow') AS verdict,
       CASE WHEN rule IS NOT NULL THEN 'rule' WHEN b.best IS NOT NULL THEN 'mined' ELSE 'default' END AS decided_by,
       CASE WHEN rule IS NULL THEN b.best.confidence END AS confidence
FROM judged LEFT JOIN best b USING (url)
"""
