"""What the operators share: tables in the shared folder, checked broadcasts,
free column names, and text turned into numpy arrays."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scratch import shared_folder

#: Largest side, in rows, that is broadcast after it has been counted.
BROADCAST_ROWS = 200_000
#: A key with a larger share of the rows than one in so many is dealt over so many tasks.
HOT_KEYS, SALTS = 1000, 64
#: So many rows are no burden for a task, whatever their keys.
FEW_ROWS = 100_000
#: Texts are turned into arrays in blocks of about so many characters.
BLOCK_CHARS = 1 << 18
#: Rows of texts that travel to Python at once; Spark's own setting of 10,000 long texts would fill an executor.
BATCH_ROWS = 1000

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again.

    It cuts the lineage, fixes what nondeterministic plans gave, outlives lost
    executors, and goes when the application ends, or by ``forget``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    df.write.options(**options).parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


_written: dict[str, list[str]] = {}


def tables(spark: SparkSession) -> list[str]:
    """The paths of the tables that are there now."""
    return list(_written.get(spark.sparkContext.applicationId, []))


def forget(spark: SparkSession, paths: list[str]) -> None:
    """Deletes tables that nothing reads any more."""
    mine = _written.get(spark.sparkContext.applicationId, [])
    for path in paths:
        if path in mine:
            mine.remove(path)
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """True if df has at most so many rows; counts no further than that."""
    return df.limit(most + 1).count() <= most


def lowest(df: DataFrame, order: Column, ties: str, k: int) -> DataFrame:
    """The k rows of df (a written table) of the lowest hash.

    Only about those are sorted: a bound below which a little more than k
    hashes fall is known from the number of rows.  Should there be fewer, as
    one key may have many rows, all are sorted.
    """
    if (n := df.count()) > 2 * k:
        bound = min(-(1 << 63) + int((1 << 64) * 1.3 * k / n), (1 << 63) - 1)
        cut = df.filter(order <= F.lit(bound))
        if cut.count() >= k:
            df = cut
    return df.orderBy(order, ties).limit(k)


def join_checked(left: DataFrame, right: DataFrame, on, how: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """left joined with right, which is broadcast if its counted rows allow it
    and else shuffled like left.  right has narrow rows and is cheap to read."""
    return left.join(F.broadcast(right) if small(right, most) else right, on, how)


def join_spread(left: DataFrame, right: DataFrame, on: str, by: str, counts: DataFrame, how: str = "inner", distinct: tuple[str, ...] = ()) -> DataFrame:
    """left joined with right, where one key may have a large share of left's rows.

    counts: rows (on, n), how many rows of left have a key; keys may be left
    out that have few.  A key with more than 1/HOT_KEYS of their sum is dealt
    over SALTS tasks by the hash of left's column ``by``, and right's rows for
    it go to each of them.  There are fewer than HOT_KEYS such keys, so they are
    broadcast.  distinct: columns of right that make its rows of a key distinct,
    found where the join needs them anyway, without a shuffle of their own.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if total <= FEW_ROWS:
        return left.join(right.repartition(on).dropDuplicates([on, *distinct]) if distinct else right, on, how)
    hot = F.broadcast(counts.filter(F.col("n") > total / HOT_KEYS).select(on, F.lit(True).alias("__hot")))
    salt, every = F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"), F.sequence(F.lit(0), F.lit(SALTS - 1))
    dealt = left.join(hot, on, "left").withColumn("__salt", F.when(F.col("__hot"), salt).otherwise(0)).drop("__hot")
    repeated = right.join(hot, on, "left").withColumn("__salt", F.explode(F.when(F.col("__hot"), every).otherwise(F.array(F.lit(0))))).drop("__hot")
    if distinct:
        repeated = repeated.repartition(on, "__salt").dropDuplicates([on, "__salt", *distinct])
    return dealt.join(repeated, [on, "__salt"], how).drop("__salt")


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with underscores before it, that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def normal_space(text: Column) -> Column:
    """Each run of ASCII white space as one space; null counts as empty.

    Only runs that are no single space already are matched, which gives the
    same text for less work.
    """
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def text_batches(df: DataFrame) -> DataFrame:
    """df, with its session set to send at most BATCH_ROWS rows to Python at once."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, BATCH_ROWS)
    return df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's strings; null counts as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def blocks(batch: pa.RecordBatch, column: str = "text", chars: int = BLOCK_CHARS) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about so many bytes of text; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64) + 64)
    at = 0
    while at < len(ends):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + chars, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the nondecreasing function nearest to y over x (pool adjacent violators).

    Each pool has the mean of its labels with one more label of either kind, so
    no small pool is certain; between pools the function is linear.
    """
    order = np.argsort(x, kind="stable")
    w = np.ones(len(x)) if w is None else w
    pools: list[list[float]] = []  # weight, weighted sum, least x, largest x
    for a, b, c in zip(x[order].tolist(), y[order].tolist(), w[order].tolist(), strict=True):
        pools.append([c, b * c, a, a])
        while len(pools) > 1 and (pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0] or pools[-2][3] == pools[-1][2]):
            n, s, _, high = pools.pop()
            pools[-1][0] += n
            pools[-1][1] += s
            pools[-1][3] = high
    value = np.maximum.accumulate([(s + 1) / (n + 2) for n, s, _, _ in pools])
    return np.array([p[k] for p in pools for k in (2, 3)]), np.repeat(value, 2)


def calibrated(x: np.ndarray, knots: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The isotonic score, with a thousandth of x's own order so that pools keep theirs."""
    return 0.999 * np.interp(x, *knots) + 0.001 / (1 + np.exp(-np.clip(x, -30, 30)))
