"""Op 1, exact dedup: a log-structured merge index of text digests.

Memtables are the tasks of a scan: each normalises and digests its texts and
flushes a run of (digest, identifier), sorted by digest, with the minimum,
maximum and a Bloom filter of the digests in each file, to the shared folder.
Compaction merges all runs into one sorted run that keeps for each digest the
smallest identifier and the number of rows, and makes a filter of the digests
that several rows have: FILTER_BITS bits, whatever the input.  A row whose digest
is not in the filter is its own keeper, and takes no further part; only the
others are shuffled and looked up in the compacted run.  Rows that hit a keeper
other than themselves are verified byte for byte, and those whose bytes differ
(a digest collision) are grouped anew by their whole text.  Everything is
DataFrame functions.

A hot group is split: compaction sums each digest in every task before anything
is shuffled, look-ups are joins that AQE splits, and verification deals the copies of one keeper
over ``COPIES`` at a time, each share with its own copy of the keeper's text.

Defined cases: null texts count as empty and equal each other; a null
identifier is larger than any other; rows that repeat both identifier and text
are one document and are marked alike (``deduplicate`` returns one of them);
an empty table gives an empty result; further columns are kept by
``deduplicate``, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, join_checked, normal_space, table, written

#: Copies that share one copy of their keeper's text in verification.
COPIES = 64
#: Runs are compacted files with Bloom filters of their digests, at this false positive rate.
FILTER = {"parquet.bloom.filter.enabled#digest": "true", "parquet.bloom.filter.fpp#digest": "0.01", "parquet.bloom.filter.max.bytes#digest": "1048576"}
#: Bits of the filter of shared digests, in bitmaps of 2^15: it is 8 MB at most, whatever the input, so it is broadcast.
FILTER_BITS = 26
_NONE = (1 << 63) - 1  # stands for a null identifier in the index


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _place(digest: Column) -> Column:
    """Where a digest's bit is in the filter."""
    return F.xxhash64(digest).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))


class DigestIndex:
    """Sorted runs of (id, digest) in the shared folder, and what compaction made of them."""

    def __init__(self, digest=sha256):
        self.digest, self.runs, self.merged, self.filter = digest, [], None, None

    def flush(self, rows: DataFrame) -> DataFrame:
        """Adds rows (id, norm) as runs, one for each task of their scan, without a shuffle; returns them."""
        run = rows.select(F.coalesce("id", F.lit(_NONE)).alias("id"), self.digest(F.col("norm")).alias("digest"))
        run = written(run.sortWithinPartitions("digest", "id"), "dedup-run", **FILTER)
        self.runs.append(run)
        return run

    def compact(self) -> DataFrame:
        """Merges all runs, and what was compacted before, into one: digest, keep_id (the smallest), group_size."""
        parts = [run.groupBy("digest").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")) for run in self.runs]
        if self.merged is not None:
            parts.append(self.merged)
        every = reduce(DataFrame.unionByName, parts)
        merged = every if len(parts) == 1 else every.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        self.merged, self.runs = written(merged.sortWithinPartitions("digest"), "dedup-compacted", **FILTER), []
        place = _place(F.col("digest"))
        shared = self.merged.filter("group_size > 1").select(F.shiftright(place, 15).alias("bucket"), place.bitwiseAND(F.lit(0x7FFF)).alias("bit"))
        self.filter = written(shared.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), "dedup-filter")
        return self.merged

    def lookup(self, run: DataFrame) -> DataFrame:
        """id, digest, keep_id, group_size for rows (id, digest) that are in the compacted run."""
        place = _place(F.col("digest"))
        asked = run.withColumn("bucket", F.shiftright(place, 15)).join(F.broadcast(self.filter), "bucket", "left")
        byte = F.conv(F.hex(F.substring(F.col("bits"), (F.shiftright(place, 3).bitwiseAND(F.lit(0xFFF)) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        bit = F.call_function("shiftright", byte, place.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1))
        asked = asked.withColumn("shared", F.col("bits").isNotNull() & (bit == 1))
        alone = asked.filter(~F.col("shared")).select("id", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
        return alone.unionByName(asked.filter("shared").select("id", "digest").join(self.merged, "digest").select("id", "digest", "keep_id", "group_size"))

    def probe(self, texts: list[str]) -> DataFrame:
        """The compacted entries of a few texts; statistics and Bloom filters pass over the files without them."""
        spark = self.merged.sparkSession
        asked = spark.createDataFrame([(t,) for t in texts], "text string").select(self.digest(normal_space(F.col("text"))).alias("digest"))
        return self.merged.filter(F.col("digest").isin([r[0] for r in asked.collect()]))


def classify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """id, keep_id, group_size, kept, text_sha256 for each row of df; ids are whole numbers.

    digest: another digest of the normalised text, for tests of collisions.
    """
    kind = df.schema[id_col].dataType.simpleString()
    real = lambda c: F.when(F.col(c) != _NONE, F.col(c)).cast(kind)
    return _grouped(df, id_col, text_col, digest).select(
        real("id").alias(id_col), real("keep_id").alias("keep_id"), "group_size", (F.col("id") == F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def _grouped(df: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    rows = df.select(F.col(id_col).cast("long").alias("id"), normal_space(F.col(text_col)).alias("norm"))
    index = DigestIndex(digest)
    run = index.flush(rows)
    index.compact()
    out = written(index.lookup(run), "dedup-looked-up")
    hits = out.filter("group_size > 1")
    return out if hits.isEmpty() else _verified(rows, out, hits, digest)


def _verified(rows: DataFrame, out: DataFrame, hits: DataFrame, digest) -> DataFrame:
    """out after a comparison of every hit with its keeper's text, byte for byte.

    A keeper's text is repeated once for so many of its copies, and each copy
    goes to one of them.
    """
    shares = F.ceil(F.col("group_size") / COPIES).cast("int")
    copies = hits.filter("id != keep_id").select("id", "digest", F.pmod(F.xxhash64("id"), shares).cast("int").alias("share")).distinct()
    keepers = hits.filter("id = keep_id").select("id", "digest", "group_size").distinct()
    texts = rows.select(F.coalesce("id", F.lit(_NONE)).alias("id"), "norm")
    texts = join_checked(texts, hits.select("id").distinct(), "id", "left_semi").withColumn("digest", digest(F.col("norm")))
    texts = written(texts, "dedup-texts")
    own = texts.join(copies, ["id", "digest"])
    kept = texts.join(keepers, ["id", "digest"]).select("digest", F.col("norm").alias("kept_norm"), F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"))
    other = written(own.join(kept, ["digest", "share"]).filter("norm != kept_norm").select("id", "digest", "norm"), "dedup-differing")
    if other.isEmpty():
        return out
    # Digests collided: these rows make groups of their own, by their whole text, and leave their digest's group.
    groups = other.groupBy("digest", "norm").agg(F.min("id").alias("new_keep"), F.count("*").alias("new_size"))
    moved = other.join(groups, ["digest", "norm"]).select("id", "digest", "new_keep", "new_size").distinct()
    left = other.groupBy("digest").agg(F.count("*").alias("gone"))
    out = out.join(moved, ["id", "digest"], "left").join(left, "digest", "left")
    return written(out.select("id", "digest", F.coalesce("new_keep", "keep_id").alias("keep_id"), F.coalesce("new_size", F.col("group_size") - F.coalesce("gone", F.lit(0))).alias("group_size")), "dedup-regrouped")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df without the rows that have an equal of a smaller identifier, with all its columns."""
    groups = _grouped(df, id_col, text_col, sha256)
    id_, digest = free_name(df, "__id"), free_name(df, "__digest")
    keyed = df.withColumns({id_: F.coalesce(F.col(id_col).cast("long"), F.lit(_NONE)), digest: sha256(normal_space(F.col(text_col)))})
    named = lambda rows: rows.select(F.col("id").alias(id_), F.col("digest").alias(digest)).distinct()
    dropped = named(groups.filter("id != keep_id"))
    kept = join_checked(keyed, dropped, [id_, digest], "left_anti")
    repeated = named(groups.filter("id = keep_id").groupBy("id", "digest").count().filter("count > 1"))
    if not repeated.isEmpty():
        once = join_checked(kept, repeated, [id_, digest], "left_semi").dropDuplicates([id_, digest])
        kept = join_checked(kept, repeated, [id_, digest], "left_anti").unionByName(once)
    return kept.select(df.columns)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))


OP1_SQL = """
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""
