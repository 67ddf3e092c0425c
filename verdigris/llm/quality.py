"""Op 2, quality classifier: ridge regression on random Fourier features of document statistics.

Whole texts become a row of statistics (lengths, character classes, repeated
words and lines, symbols).  Random Fourier features cos(w.x + b) approximate a
Gaussian kernel over the standardised statistics.  Each partition sums its
normal equations, per fold; the sums give the ridge solution, and also the
solutions without each fold, whose scores of that fold calibrate the result by
isotonic regression.

Texts are read once: statistics go to a table in the shared folder, from which
both fitting and scoring read.  Fitting takes at most ``max_rows`` labelled rows,
by a hash of the identifier, in FIT_PARTS partitions, so that the sums that
reach the driver are of fixed size.

Defined cases: null and empty texts have all statistics 0 and a score like any
other; a null identifier is not held out; labels other than 0 and 1 are no
labels; without labels every score is 0.5, with one kind of label near that
label; repeated rows give repeated results; an empty table gives an empty
result; further columns are ignored or kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, calibrated, isotonic, lowest, mix64, table, text_batches, texts, written

FEATURES = 256
#: Width of the Gaussian kernel, in standardised units.
WIDTH = 4.0
RIDGE = 1e-3
FOLDS = 4
FIT_PARTS = 16
MAX_ROWS = 40_000
THRESHOLD = 0.3

STATS = (
    "log_chars", "log_words", "word_length", "word_spread", "short_words", "long_words", "upper", "digits", "symbols", "marks", "bars", "shouts",
    "stops", "spaces", "log_lines", "line_length", "repeated_lines", "closed_lines", "distinct_words", "top_word", "symbol_words", "upper_words", "echoes", "beyond_ascii",
)


def statistics(given: list[str]) -> np.ndarray:
    """A row of STATS for each text."""
    n = len(given)
    sizes = np.fromiter((len(t) + 1 for t in given), np.int64, n)
    points = np.frombuffer("".join(f"{t}\n" for t in given).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    total = np.maximum(sizes - 1, 1).astype(float)

    def per_text(flags: np.ndarray) -> np.ndarray:
        so_far = np.concatenate([[0], np.cumsum(flags, dtype=np.float64)])
        return so_far[ends] - so_far[starts]

    def is_any(chars: str) -> np.ndarray:
        held = np.zeros(128, bool)
        held[[ord(c) for c in chars]] = True
        return held[np.minimum(points, 127)] & (points < 127)

    lines_end = points == 10
    space = (points <= 32) & (points >= 9)
    upper = (points >= 65) & (points <= 90)
    lower = ((points >= 97) & (points <= 122)) | (points >= 0xC0)
    digit = (points >= 48) & (points <= 57)
    symbol = is_any("#$%&*@^~_=<>\\{}[]+/|")
    mark = is_any(".,;:!?'\"()-")
    word = ~space
    edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0))
    ws, we = edge[::2], edge[1::2]
    text_of_word = np.searchsorted(ends, ws, side="right")
    count = np.maximum(np.bincount(text_of_word, minlength=n), 1).astype(float)
    lengths = (we - ws).astype(float)
    by_word = lambda x: np.bincount(text_of_word, x, minlength=n)

    def within(flags: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        so_far = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return so_far[b] - so_far[a]

    # Hashes of words and lines: sums of mixed (place, character) pairs.
    def hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(a):
            return np.zeros(0, np.uint64)
        length = b - a
        place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        at = np.repeat(a, length) + place
        mixed = mix64((points[at].astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64) + np.uint64(1))
        return np.add.reduceat(mixed, np.cumsum(length) - length)

    def counted(text: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct items of each text, and how often its most frequent one comes."""
        if not len(h):
            return np.zeros(n), np.zeros(n)
        order = np.lexsort((h, text))
        t, k = text[order], h[order]
        new = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (k[1:] != k[:-1])]))
        often = np.diff(np.concatenate([new, [len(t)]]))
        most = np.zeros(n)
        np.maximum.at(most, t[new], often)
        return np.bincount(t[new], minlength=n).astype(float), most

    wh = hashes(ws, we)
    distinct, most = counted(text_of_word, wh)
    echo = np.zeros(len(wh))
    if len(wh) > 1:
        echo[1:] = (wh[1:] == wh[:-1]) & (text_of_word[1:] == text_of_word[:-1])
    le = np.flatnonzero(lines_end)
    ls = np.concatenate([[0], le[:-1] + 1])
    full = le > ls
    ls, le = ls[full], le[full]
    text_of_line = np.searchsorted(ends, ls, side="right")
    lines = np.bincount(text_of_line, minlength=n).astype(float)
    line_kinds, _ = counted(text_of_line, hashes(ls, le))
    closed = np.bincount(text_of_line, is_any(".!?")[np.maximum(le - 1, 0)].astype(float), minlength=n) if len(le) else np.zeros(n)
    mean = by_word(lengths) / count
    letters = np.maximum(per_text(upper | lower), 1)
    some = np.maximum(lines, 1)
    cols = [
        np.log1p(sizes - 1), np.log1p(count), np.minimum(mean, 50), np.minimum(np.sqrt(np.maximum(by_word(lengths**2) / count - mean**2, 0)), 50),
        by_word(lengths <= 2) / count, by_word(lengths >= 15) / count, per_text(upper) / letters, per_text(digit) / total, per_text(symbol) / total, per_text(mark) / total, per_text(points == 124) / count, per_text(points == 33) / count,
        per_text(is_any(".?")) / count, per_text(space) / total, np.log1p(lines), np.log1p(total / some), 1 - line_kinds / some, closed / some, distinct / count, most / count,
        by_word(within(symbol, ws, we) > 0) / count, by_word(within(upper, ws, we) == we - ws) / count, by_word(echo) / count, per_text(points > 127) / total,
    ]
    out = np.stack([np.asarray(c, float) for c in cols], axis=1)
    out[sizes == 1] = 0
    return out


def with_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, stats (array of float) for each row of df."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for b in blocks(batch):
                s = statistics(texts(b)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(s) + 1) * s.shape[1], pa.int32()), pa.array(s.ravel(), pa.float32()))], names=["id", "stats"])

    return text_batches(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).mapInArrow(run, f"id {kind}, stats array<float>").withColumnRenamed("id", id_col)


class Model:
    """Standardisation, the random features, their weights, and the isotonic knots."""

    def __init__(self, centre, scale, weights=None, knots=None, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.centre, self.scale, self.weights, self.knots = centre, scale, weights, knots
        self.W = rng.normal(0, 1 / WIDTH, (len(STATS), FEATURES))
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.centre) / self.scale, -8, 8)
        return np.concatenate([np.sqrt(2 / FEATURES) * np.cos(x @ self.W + self.b), np.ones((len(x), 1))], axis=1)

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), 0.5)
        return calibrated(self.features(stats) @ self.weights, self.knots)


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, len(STATS))


def fit(labelled: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """The model of rows (id, stats, y)."""
    rows = lowest(written(labelled, "quality-labelled"), F.xxhash64("id"), "id", max_rows).withColumn("fold", (F.pmod(F.xxhash64("id"), F.lit(FOLDS))).cast("int"))
    rows = written(rows.repartition(FIT_PARTS), "quality-fit")
    each = [F.element_at("stats", k + 1) for k in range(len(STATS))]
    sums = rows.agg(F.count("*").alias("n"), *[F.avg(c).alias(f"a{k}") for k, c in enumerate(each)], *[F.stddev_pop(c).alias(f"s{k}") for k, c in enumerate(each)]).first()
    if not sums["n"]:
        return Model(np.zeros(len(STATS)), np.ones(len(STATS)))
    model = Model(np.array([sums[f"a{k}"] for k in range(len(STATS))]), np.array([max(sums[f"s{k}"], 1e-6) for k in range(len(STATS))]))

    def equations(batches):
        left, right = np.zeros((FOLDS, FEATURES + 1, FEATURES + 1)), np.zeros((FOLDS, FEATURES + 1))
        for b in batches:
            phi, y, fold = model.features(_matrix(b.column(0))), b.column(1).to_numpy(zero_copy_only=False).astype(float), b.column(2).to_numpy(zero_copy_only=False)
            for k in range(FOLDS):
                left[k] += phi[fold == k].T @ phi[fold == k]
                right[k] += phi[fold == k].T @ y[fold == k]
        yield pa.RecordBatch.from_arrays([pa.array([left.tobytes()]), pa.array([right.tobytes()])], names=["l", "r"])

    parts = rows.select("stats", "y", "fold").mapInArrow(equations, "l binary, r binary").collect()
    left = sum(np.frombuffer(p["l"]).reshape(FOLDS, FEATURES + 1, -1) for p in parts)
    right = sum(np.frombuffer(p["r"]).reshape(FOLDS, -1) for p in parts)

    def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.linalg.solve(a + RIDGE * max(a[-1, -1], 1.0) * np.eye(len(a)) / FEATURES, b)

    model.weights = solve(left.sum(axis=0), right.sum(axis=0))
    without = [solve(left.sum(axis=0) - left[k], right.sum(axis=0) - right[k]) for k in range(FOLDS)]

    def crossed(batches):
        for b in batches:
            phi, fold = model.features(_matrix(b.column(0))), b.column(2).to_numpy(zero_copy_only=False)
            z = np.einsum("ij,ij->i", phi, np.stack(without)[fold])
            yield pa.RecordBatch.from_arrays([pa.array(z), b.column(1)], names=["z", "y"])

    out = rows.select("stats", "y", "fold").mapInArrow(crossed, "z double, y int").collect()
    model.knots = isotonic(np.array([r["z"] for r in out]), np.array([r["y"] for r in out], float))
    return model


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string")) % 5 == 0, F.lit(False))


def with_score(stats: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """id, score for rows (id, stats)."""
    kind = stats.schema[id_col].dataType.simpleString()
    held = stats.sparkSession.sparkContext.broadcast((model.centre, model.scale, model.weights, model.knots))

    def run(batches):
        m = Model(*held.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.scores(_matrix(b.column(1))))], names=["id", "score"])

    return stats.select(F.col(id_col).alias("id"), "stats").mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def score(docs: DataFrame, labels: DataFrame, use=lambda i: ~held_out(i), id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> DataFrame:
    """id, score for each row of docs; learns from the labels (doc_id, quality) of rows whose id passes ``use``."""
    stats = written(with_statistics(docs, id_col, text_col), "quality-stats")
    marks = labels.filter(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("y")).groupBy("id").agg(F.max("y").alias("y"))
    labelled = stats.select(F.col(id_col).alias("id"), "stats").filter(use(F.col("id"))).join(marks, "id")
    return with_score(stats, fit(labelled, max_rows), id_col)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
