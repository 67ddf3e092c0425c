"""Op 3, document fingerprints: a homomorphic multiset hash.

Each paragraph (a line; long lines also by sentence, so that short documents
have parts) is hashed by SHAKE-128 to LANES words, odd numbers from -255 to 255,
and a document's fingerprint is the sum of its paragraphs' vectors modulo 2^32
in every lane.  So the order of paragraphs does not matter, a paragraph is
inserted by adding its vector and deleted by subtracting it.  Different
multisets have equal sums by a chance of about 2^-LANES or less; sums of
LANES lanes are no guard against texts that are made to collide.  As the words
have mean zero, the product of two sums estimates how many parts the documents
share, with a standard error of about 1/sqrt(LANES) of their sizes.

Equality, insertion and deletion hold for any number of paragraphs.  The
likeness reads lanes as signed numbers, which they are up to 8,421,504 copies of
one paragraph (2^31 / 255); beyond that its value means nothing.

Defined cases: a null text counts as empty, whose fingerprint is all zeros and
which is like another empty one (1.0) and unlike any other (0.0); a null id
comes after all others; rows of one id follow each other by text; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, table, text_batches

LANES = 256
_SENTENCE = re.compile(r"(?<=[.!?])\x20+")
_LAST = (1 << 63) - 1


def parts_of(text: str) -> list[str]:
    """The paragraphs, and the sentences of those that have several; blank ones have no weight."""
    parts = []
    for line in text.split("\n"):
        if line and not line.isspace():
            parts.append(line)
            sentences = _SENTENCE.split(line)
            if len(sentences) > 1:
                parts += sentences
    return parts


def vector(parts: list[str]) -> np.ndarray:
    """The sum of the parts' vectors, modulo 2^32: of bytes w, each the word 2 w - 255."""
    total = np.zeros(LANES, np.int64)
    for at in range(0, len(parts), 1024):
        block = Counter(parts[at : at + 1024])
        words = b"".join(hashlib.shake_128(p.encode("utf-8", "surrogatepass")).digest(LANES) for p in block)
        times = np.fromiter(block.values(), np.int64, len(block))
        total += 2 * (times @ np.frombuffer(words, np.uint8).reshape(len(block), LANES)) - 255 * times.sum()
    return (total & 0xFFFFFFFF).astype(np.uint32)


def fingerprint(text: str | None) -> np.ndarray:
    return vector(parts_of(text or ""))


def insert(print_: np.ndarray, paragraph: str) -> np.ndarray:
    """The fingerprint of the document with one more paragraph, wherever it stands."""
    return print_ + vector(parts_of(paragraph))


def delete(print_: np.ndarray, paragraph: str) -> np.ndarray:
    return print_ - vector(parts_of(paragraph))


def to_text(print_: np.ndarray) -> str:
    return print_.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the shared parts over the parts of both, from 0 to 1; 1.0 only for equal fingerprints."""
    if np.array_equal(a, b):
        return 1.0
    x, y = a.view(np.int32).astype(np.float64), b.view(np.int32).astype(np.float64)
    like = 2 * float(x @ y) / float(x @ x + y @ y)
    return min(max(like, 0.0), 1.0 - 2.0**-20)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fingerprint (hexadecimal, 8 digits a lane) for each row of df."""
    kind = df.schema[id_col].dataType.simpleString()

    def scan(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([to_text(fingerprint(t)) for t in b.column(1).to_pylist()], pa.string())], names=["id", "fingerprint"])

    return text_batches(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).mapInArrow(scan, f"id {kind}, fingerprint string").withColumnRenamed("id", id_col)


def edit(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by as many of the following text, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(df: DataFrame, n: int | None = None) -> DataFrame:
    """id, text of df in parts whose rows follow each other by id, each with the first row of the next part.

    The parts begin at ids that are about the quantiles of all ids.  A row whose id begins
    a part also goes to the part before it, marked as ahead; the first id of all
    goes also to the last part.  So each text is shuffled once, no row's
    neighbour lies in another part, and no part holds more than its share.
    """
    spark = df.sparkSession
    n = n or partitions(spark)
    keyed = df.select("id", F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(F.col("id").cast("long"), F.lit(_LAST)).alias("k"))
    ids = keyed.select("k")
    # Quantiles are doubles, which hold no long beyond 2^53: they only say about where parts begin, and the least id of each part says where.
    marks = np.array(sorted({min(int(x), _LAST) for x in ids.approxQuantile("k", [i / n for i in range(1, n)], 1 / (4 * n))} if n > 1 else ()), np.int64)

    @F.pandas_udf("int")
    def nearly(k):
        import pandas as pd

        return pd.Series(np.searchsorted(marks, k.to_numpy(), side="right"))

    starts = sorted(r["least"] for r in ids.groupBy(nearly("k").alias("part")).agg(F.min("k").alias("least")).collect())  # n at most
    least, starts = (starts[0], starts[1:]) if starts else (None, [])
    count = len(starts) + 1
    bounds = spark.sparkContext.broadcast(np.array(starts, np.int64))

    @F.pandas_udf("array<int>")
    def parts(k):
        import pandas as pd

        ids_ = k.to_numpy()
        own = np.searchsorted(bounds.value, ids_, side="right")
        begins = (own > 0) & (bounds.value[np.maximum(own - 1, 0)] == ids_) if len(bounds.value) else np.zeros(len(ids_), bool)
        return pd.Series([[o, -o] if b else [o, -count] if i == least else [o] for o, b, i in zip(own.tolist(), begins.tolist(), ids_.tolist(), strict=True)])

    # A part p as it is; ahead of part p - 1 as -p.
    dealt = keyed.withColumn("p", F.explode(parts("k")))
    ahead = F.col("p") < 0
    dealt = dealt.select("id", "text", "k", ahead.alias("ahead"), F.when(ahead, -F.col("p") - 1).otherwise(F.col("p")).alias("part"))
    return dealt.repartitionById(count, F.col("part")).sortWithinPartitions("part", "ahead", "k", "text")


def edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int | None = None) -> DataFrame:
    """For each row: n_chars, its edited text's SHA-256, both fingerprints, and the likenesses.

    Numeric ids only, as the next document is the next by id.
    """
    def scan(batches):
        rows = itertools.chain.from_iterable(zip(*(c.to_pylist() for c in b.columns), strict=True) for b in batches)
        for _, part in itertools.groupby(rows, key=lambda r: r[4]):
            yield from out(part)

    def out(part):
        done, size, before = [], 0, None
        for id_, text, _, is_ahead, _ in part:
            print_ = fingerprint(text)
            if before:
                done.append(row(*before, text, print_))
                size += 1
                before = None
            if is_ahead:
                break  # the others begin the next part too, after this one
            before = id_, text, print_
            if size == 512:
                yield pack(done)
                done, size = [], 0
        for _ in part:
            pass
        if before:
            raise RuntimeError(f"no row after id {before[0]}: every part ends with a row ahead")
        if done:
            yield pack(done)

    def row(id_, text, print_, following, next_print):
        changed = edit(text, following)
        its = fingerprint(changed)
        return id_, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), to_text(print_), to_text(its), likeness(print_, its), likeness(print_, next_print)

    kind = df.schema[id_col].dataType.simpleString()
    names = ("id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())

    def pack(done):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=list(names))

    dealt = with_next(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), n).withColumn("id", F.col("id").cast("long"))
    made = text_batches(dealt).mapInArrow(scan, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return made.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited(table(spark, sf_dir, "documents"))
