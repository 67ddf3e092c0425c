"""Op 6, mixing sources to target weights by weighted fair queueing.

Every source's documents stand in a queue in shuffled order (by MD5 of seed and
identifier), and after the last the queue may begin once more.  A document's
virtual finish time is its source's cumulative words up to its end, divided by
the source's target.  All queue entries are range-sorted by that time, and the
mix takes from the front what the total budget holds.  So sources advance in
proportion to their targets, and each ends near its own.

Sources, by code point with null last, weigh ``weights`` in turn and share
``share`` of all words; a target stops at ``most`` times its source's words and
the excess goes to the others by weight.

Scale: texts are read once, to count words.  What is sorted are identifiers and
numbers.  Cumulative sums over a source are made in buckets of its shuffled
order, so that a source with a third of all rows is spread over many tasks;
sums over a global order are made within range partitions, and only the
partitions' totals meet.  Reruns agree, as nothing depends on the order of
rows or partitions.

Defined cases: null and empty texts have size 0 and are taken 0 times; a null
source is a source; rows that repeat identifier, source and text are told apart
arbitrarily, which no result shows; an empty table gives an empty result;
further columns are kept by ``mix``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, free_name, partitions, table, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix"
#: Queue entries that one bucket of a source's shuffled order holds, about.
BUCKET_ROWS = 2000
#: Rows for which a global order is dealt over one more partition, as far as there are partitions.
RUN_ROWS = 2000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running(df: DataFrame, order: list[Column], sums: dict[str, Column], parts: int | None = None) -> DataFrame:
    """df with sums, each cumulated in the order up to and with the row.

    The rows are range-sorted; the totals of the partitions, of which there are
    few, are cumulated apart and added.
    """
    parts = parts or min(partitions(df.sparkSession), df.count() // RUN_ROWS + 1)
    dealt = written(df.withColumns(sums).repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "running")
    totals = dealt.groupBy("__part").agg(*[F.sum(c).alias(c) for c in sums]).orderBy("__part").collect()
    before, so_far = [], dict.fromkeys(sums, 0)
    for t in totals:
        before.append((t["__part"], *[type(t[c])(so_far[c]) for c in sums]))
        so_far = {c: so_far[c] + t[c] for c in sums}
    kinds = ", ".join(f"`__before_{c}` {dealt.schema[c].dataType.simpleString()}" for c in sums)
    offsets = df.sparkSession.createDataFrame(before, f"__part int, {kinds}")
    within = W.partitionBy("__part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    out = dealt.join(F.broadcast(offsets), "__part")  # one row a partition
    return out.withColumns({c: F.sum(c).over(within) + F.col(f"__before_{c}") for c in sums}).drop("__part", *[f"__before_{c}" for c in sums])


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target of a table of sources and their sizes.

    With the limits' ratios most * size / weight in ascending order, the first
    k sources stop at their limit, for the least k such that the rest share
    what is left without reaching theirs.
    """
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("__nth") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = running(sources, [F.col("source").asc_nulls_last()], {"__nth": F.lit(1).cast("long")}).withColumn("__weight", w.cast("long")).drop("__nth")
    ranked = ranked.withColumn("__ratio", F.lit(float(most)) * F.col("source_size") / F.col("__weight"))
    by_ratio = running(ranked, [F.col("__ratio"), F.col("source").asc_nulls_last()], {"__limited": F.col("source_size").cast("long"), "__weighed": F.col("__weight")})
    weight_sum = ranked.agg(F.sum("__weight")).first()[0] or 0
    # The level before each source: what a weight of 1 gets if all sources before it stop at their limit.
    left = F.lit(weight_sum) - F.col("__weighed") + F.col("__weight")
    level = (F.lit(total) - F.lit(float(most)) * (F.col("__limited") - F.col("source_size"))) / left
    first = by_ratio.filter(level <= F.col("__ratio")).agg(F.min(F.struct(F.col("__ratio"), level.alias("level")))).first()[0]
    at = F.lit(float(most)) * F.col("source_size") if first is None else F.least(F.lit(float(most)) * F.col("source_size"), F.lit(first["level"]) * F.col("__weight"))
    return ranked.select("source", "source_size", at.cast("double").alias("target"))


def schedule(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """For each row of df: id, source, size, source_size, target, copies taken, and the digest of its text that tells rows of one id apart."""
    docs = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("print"))
    docs = docs.withColumn("turn", F.md5(F.concat_ws("|", F.lit(seed), F.col("id"), F.col("print"))))
    docs = written(docs, "mix-sizes")
    per = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    aims = written(targets(per.drop("rows"), weights, share, most), "mix-targets")
    budget = int((docs.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]) * share)
    # Cumulative sums over each source's shuffled order: in buckets, and of the buckets' sums.
    buckets = max(1, -(-(per.agg(F.max("rows")).first()[0] or 0) // BUCKET_ROWS))
    scale = F.conv(F.substring("turn", 1, 8), 16, 10).cast("long")
    docs = docs.withColumn("bucket", F.floor(scale * buckets / F.lit(1 << 32)).cast("long"))
    sums = docs.groupBy("source", "bucket").agg(F.sum("size").alias("sum"))
    # What comes before a bucket in its source is what comes before it in all, less what comes before the source.
    sums = written(running(sums, [F.col("source").asc_nulls_last(), F.col("bucket")], {"through": F.col("sum").cast("long")}), "mix-buckets")
    bases = sums.groupBy(F.col("source").alias("base_of")).agg(F.min(F.col("through") - F.col("sum")).alias("base"))
    known = aims.join(bases, aims["source"].eqNullSafe(F.col("base_of"))).select("base_of", "base", "source_size", "target")
    sums = sums.join(known, sums["source"].eqNullSafe(F.col("base_of")))
    sums = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), (F.col("through") - F.col("sum") - F.col("base")).alias("before"), "source_size", "target")
    queue = W.partitionBy("source", "bucket").orderBy("turn", "size").rowsBetween(W.unboundedPreceding, 0)
    docs = docs.withColumn("upto", F.sum("size").over(queue))
    docs = docs.join(sums, docs["source"].eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).withColumn("upto", F.col("upto") + F.col("before")).drop("s", "b", "bucket", "before")
    docs = written(docs, "mix-queues")
    finish = lambda again: F.when(F.col("target") > 0, (F.lit(again) * F.col("source_size") + F.col("upto")) / F.col("target"))
    entries = docs.filter("size > 0").select("size", "turn", F.posexplode(F.array(*[finish(k) for k in range(most)])).alias("again", "finish")).filter("finish IS NOT NULL")
    order = ["finish", "again", "turn"]
    taken = running(entries, [F.col(c) for c in order], {"sum": F.col("size")}).filter(F.col("sum") <= budget)
    last = taken.agg(F.max(F.struct(*order)).alias("last")).first()["last"]
    if last is None:
        copies = F.lit(0)
    else:
        cut = F.struct(F.lit(last["finish"]).alias("finish"), F.lit(last["again"]).alias("again"), F.lit(last["turn"]).alias("turn"))
        copies = sum((F.coalesce((F.struct(finish(k).alias("finish"), F.lit(k).alias("again"), F.col("turn")) <= cut).cast("int"), F.lit(0)) for k in range(most)), F.lit(0))
    return docs.select("id", "source", "size", "print", "source_size", "target", F.when(F.col("size") > 0, copies).otherwise(0).alias("copies"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix: the rows of df, each as often as it is taken."""
    plan = schedule(df, id_col, text_col, source_col, **options).filter("copies > 0").select("id", "print", "source", "copies")
    id_, print_, source, copies, nth = (free_name(df, f"__{c}") for c in ("id", "print", "source", "copies", "nth"))
    # Rows that repeat id, source and text have one entry here and stay several rows of df.
    plan = plan.groupBy(F.col("id").alias(id_), F.col("print").alias(print_), F.col("source").alias(source)).agg(F.max("copies").alias(copies))
    rows = df.withColumn(print_, F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    joined = rows.join(plan, rows[id_col].eqNullSafe(F.col(id_)) & (rows[print_] == plan[print_]) & rows[source_col].eqNullSafe(F.col(source)))
    return joined.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[df[c] for c in df.columns])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = schedule(table(spark, sf_dir, "documents"))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


OP6_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5(concat_ws('|', 'mix', doc_id, md5(coalesce(text, '')))) AS turn
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::BIGINT AS weight
  FROM docs GROUP BY source
), ratios AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS ratio FROM per
), leveled AS (
  SELECT *, ((SELECT sum(source_size) FROM per)::DOUBLE * 1.5 - 2.0::DOUBLE * (sum(source_size) OVER w - source_size))
            / ((SELECT sum(weight) FROM per) - sum(weight) OVER w + weight)::DOUBLE AS level
  FROM ratios WINDOW w AS (ORDER BY ratio, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), lev AS (
  SELECT level FROM leveled WHERE level <= ratio ORDER BY ratio, level LIMIT 1
), aims AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce((SELECT level FROM lev) * weight, 2.0::DOUBLE * source_size))::DOUBLE AS target
  FROM per
), queues AS (
  SELECT d.*, a.source_size, a.target, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.turn, d.size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM docs d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source
), entries AS (
  SELECT doc_id, turn, size, again, (again * source_size + upto)::DOUBLE / target AS finish
  FROM queues, (VALUES (0), (1)) v(again) WHERE size > 0 AND target > 0
), cumulated AS (
  SELECT *, sum(size) OVER (ORDER BY finish, again, turn ROWS UNBOUNDED PRECEDING) AS upto FROM entries
), chosen AS (
  SELECT doc_id, turn, sum(size)::BIGINT AS taken FROM cumulated
  WHERE upto <= floor((SELECT sum(size) FROM docs)::DOUBLE * 1.5) GROUP BY doc_id, turn
)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(c.taken, 0)::BIGINT AS taken
FROM queues q LEFT JOIN chosen c ON q.doc_id = c.doc_id AND q.turn = c.turn
"""
