"""Op 4, toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A window, a word or a pair of neighbouring words, is a bag of character n-grams
(with word boundaries; a pair also has those that span both words, so two
harmless words can be an insult together), each hashed to a row of an embedding
table.  The average of the rows goes through a linear softmax; embeddings and
softmax are trained together by Adam from random values.  As labels are of whole
texts, training alternates: at first random windows stand for their texts; then
the present model picks each text's most toxic windows, which are learned with
the text's label, positives also with random misspellings.  Unseen misspellings
share most n-grams with the words they come from.  N-grams of fewer than SUPPORT
texts do not count.

A text shows its TOP most toxic different words and its most toxic pair, so one
insult in a long text counts, and so do several words that are each no proof.
A quarter of the labelled texts is kept from training, for a logistic regression
on these and an isotonic calibration of its score.

The softmax of an average is linear, so for scoring each n-gram needs one
number (its row times the difference of the two classes' weights), and whole
texts are scored as arrays of code points.

Training sees at most ``max_rows`` labelled texts of at most ``max_chars``
characters together, chosen by a hash of the identifier; scoring sees every
character of every text.

Defined cases: null and empty texts get the score of windows without n-grams,
which is below every threshold used here; text with fewer words or pairs counts
its least one, or 0, for those it has not; a null identifier is not held out; a
null label is no label; without both labels to learn from, every score is near the
share of toxic labels, or 0 without any; repeated rows give repeated results;
an empty table gives an empty result; further columns are ignored or kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, calibrated, free_name, isotonic, lowest, table, text_batches, texts, written

BITS = 18
DIM = 8
LENGTHS = (3, 4, 5, 6)
#: A text shows its so many most toxic different words, and its most toxic pair.
TOP = 3
#: Texts that must have an n-gram before it counts, and windows that the first round learns from, about.
SUPPORT, SAMPLED = 3, 100_000
MAX_ROWS = 8_000
MAX_CHARS = 25_000_000
THRESHOLD = 0.7
#: Punctuation that a window found toxic is learned without.
STRIP = " .,;:!?\"'()[]"


class Bags:
    """A block of texts as code points, with the n-grams, words and pairs of words."""

    def __init__(self, given: list[str]):
        joined = " " + " ".join(t.lower() + " " for t in given)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.word = points > 32
        self.points = np.where(self.word, points, np.uint32(32))
        edge = np.flatnonzero(self.word[1:] != self.word[:-1]) + 1
        self.starts, self.ends = edge[::2], edge[1::2]
        sizes = np.fromiter((len(t.lower()) + 2 for t in given), np.int64, len(given))
        #: The first word of each text, and one past the last text's.
        self.first = np.searchsorted(self.starts, np.concatenate([[0], np.cumsum(sizes)]))
        self.text = np.repeat(np.arange(len(given)), np.diff(self.first))
        #: First words of pairs: those whose next word is of the same text.
        self.pairs = np.flatnonzero(self.text[1:] == self.text[:-1]) if len(self.text) else np.zeros(0, np.int64)

    def grams(self):
        """For each length: the n-grams' rows by start, whether each lies in one word (its borders may be in it), and whether it spans two."""
        n = len(self.points)
        h, breaks = self.points * np.uint32(0x9E3779B1), np.cumsum(~self.word)
        for k in range(2, max(LENGTHS) + 1):
            if n < k:
                return
            h = h[:-1] * np.uint32(0x01000193) + self.points[k - 1 :] * np.uint32(0x85EBCA6B)
            if k in LENGTHS:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                inside = breaks[k - 2 : n - 1] - breaks[: n - k + 1]
                yield ((mixed ^ (mixed >> np.uint32(13))) * np.uint32(0x297A2D39)) >> np.uint32(32 - BITS), inside == 0, (inside == 1) & self.word[: n - k + 1] & self.word[k - 1 :]

    def scored(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The average of the n-grams' weights of each word, and of each pair."""
        sums = np.zeros((4, len(self.points) + 1))
        for rows, within, across in self.grams():
            found = weights[rows]
            for at, sel in ((0, within), (2, across)):
                sums[at, 1 : len(rows) + 1] += np.where(sel, found, 0)
                sums[at + 1, 1 : len(rows) + 1] += sel
        sums = np.cumsum(sums, axis=1)
        value, count, over, overs = sums
        a, b = self.starts - 1, self.ends - 1
        words = (value[b] - value[a]) / np.maximum(count[b] - count[a], 1)
        p, q = self.pairs, self.pairs + 1
        total = value[b[q]] - value[a[p]] + over[self.ends[p]] - over[a[p]]
        return words, total / np.maximum(count[b[q]] - count[a[p]] + overs[self.ends[p]] - overs[a[p]], 1)

    def best(self, weights: np.ndarray) -> np.ndarray:
        """For each text its TOP highest different words, and its highest pair; what a text has not counts as its least, or 0."""
        words, pairs = self.scored(weights)
        out = np.full((len(self.first) - 1, TOP + 1), np.nan)
        order = np.lexsort((-words, self.text))
        text, value = self.text[order], words[order]
        # Equal words have equal scores, but for rounding.
        new = np.concatenate([[True], (text[1:] != text[:-1]) | (value[:-1] - value[1:] > 1e-6)]) if len(text) else np.zeros(0, bool)
        text, value = text[new], value[new]
        nth = np.arange(len(text)) - np.searchsorted(text, text)
        few = nth < TOP
        out[text[few], nth[few]] = value[few]
        if len(pairs):
            of = self.text[self.pairs]
            at = np.flatnonzero(np.diff(of, prepend=-1))
            out[of[at], TOP] = np.maximum.reduceat(pairs, at)
        least = np.fmin(np.fmin.reduce(out, axis=1), 0) if len(out) else np.zeros(0)
        return np.where(np.isnan(out), np.nan_to_num(least)[:, None], out)


def bags_of(windows: list[str]) -> list[np.ndarray]:
    """For each window, a word or a pair of words, the embedding rows of all its n-grams."""
    out: list[np.ndarray] = []
    for _, part in _parts(windows):
        b = Bags(part)
        at = np.concatenate([[0], np.cumsum(np.fromiter((len(w.lower()) + 2 for w in part), np.int64, len(part)))])
        text_at = np.repeat(np.arange(len(part)), np.diff(at))
        text_at = np.concatenate([text_at, [len(part)] * (len(b.points) - len(text_at))])
        # The space before a window's first word ends the window before it.
        text_at = np.concatenate([text_at[1:], [len(part)]])
        rows, of = [], []
        for r, within, across in b.grams():
            sel = within | across
            rows.append(r[sel].astype(np.int64))
            of.append(text_at[: len(r)][sel])
        rows, of = np.concatenate(rows or [np.zeros(0, np.int64)]), np.concatenate(of or [np.zeros(0, np.int64)])
        order = np.argsort(of, kind="stable")
        out += np.split(rows[order], np.searchsorted(of[order], np.arange(1, len(part) + 1)))[: len(part)]
    return out


def misspelled(window: str, rng: np.random.Generator) -> str:
    """The window with one or two letters of each word dropped, doubled, swapped or replaced."""
    out = []
    for w in window.split():
        for _ in range(int(rng.integers(1, 3))):
            if len(w) > 3:
                k, how = int(rng.integers(len(w) - 1)), int(rng.integers(4))
                w = (w[:k] + w[k + 1 :], w[: k + 1] + w[k:], w[:k] + w[k + 1] + w[k] + w[k + 2 :], w[:k] + "0134578@$*"[int(rng.integers(10))] + w[k + 1 :])[how]
        out.append(w)
    return " ".join(out)


class Model:
    """weights: one number for each embedding row; pool: how a text's best windows are weighed; knots: the isotonic calibration of that."""

    def __init__(self, weights: np.ndarray, pool: np.ndarray, knots: tuple[np.ndarray, np.ndarray]):
        self.weights, self.pool, self.knots = weights.astype(np.float32), pool, knots

    def scores(self, given: list[str]) -> np.ndarray:
        return calibrated(Bags(given).best(self.weights) @ self.pool[:-1] + self.pool[-1], self.knots)


def _parts(given: list[str], chars: int = 1 << 18):
    at = 0
    while at < len(given):
        end, n = at, 0
        while end < len(given) and (end == at or n + len(given[end]) <= chars):
            n += len(given[end])
            end += 1
        yield at, given[at:end]
        at = end


def _support(given: list[str]) -> np.ndarray:
    """In how many texts each row is, whatever their labels."""
    seen = np.zeros(1 << BITS, np.int64)
    for _, part in _parts(given):
        b = Bags(part)
        text_of = np.searchsorted(b.first[1:], np.searchsorted(b.starts, np.arange(len(b.points)), side="right") - 1, side="right")
        for rows, within, across in b.grams():
            sel = within | across
            pairs = np.unique((text_of[: len(rows)][sel].astype(np.int64) << BITS) | rows[sel].astype(np.int64))
            seen += np.bincount(pairs & ((1 << BITS) - 1), minlength=1 << BITS)
    return seen


def _windows(given: list[str], weights: np.ndarray | None, most: list[int], some: list[int], rng: np.random.Generator) -> list[list[str]]:
    """For each text its ``most`` highest words and as many highest pairs, and ``some`` random ones of either."""
    out = []
    for start, part in _parts(given):
        b = Bags(part)
        low = " " + " ".join(t.lower() + " " for t in part)
        words, pairs = b.scored(weights) if weights is not None else (None, None)
        bounds, each, second = np.searchsorted(b.pairs, b.first), np.arange(len(b.starts)), b.pairs + 1
        for i in range(len(part)):
            mine = []
            for score, a, z, first, last in ((words, b.first[i], b.first[i + 1], each, each), (pairs, bounds[i], bounds[i + 1], b.pairs, second)):
                if z <= a:
                    continue
                picked = rng.integers(a, z, some[start + i])
                if score is not None and most[start + i]:
                    picked = np.concatenate([a + np.argsort(-score[a:z], kind="stable")[: most[start + i]], picked])
                mine += [" ".join(low[b.starts[first[k]] : b.ends[last[k]]].split()) for k in picked]
            out.append(mine)
    return out


def _fit(bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray, state: dict, rng: np.random.Generator, epochs: int, rate: float = 0.01, batch: int = 256, decay: float = 1e-6) -> None:
    """Adam on embeddings and softmax together; the gradient of an average is shared by its rows."""
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            flat = np.concatenate([bags[i] for i in pick])
            lengths = np.array([len(bags[i]) for i in pick])
            sizes, of = np.maximum(lengths, 1), np.repeat(np.arange(len(pick)), lengths)
            summed = lambda x, at, n: np.stack([np.bincount(at, x[:, k], n) for k in range(x.shape[1])], axis=1)
            mean = summed(state["E"][flat], of, len(pick))
            mean /= sizes[:, None]
            logits = mean @ state["W"] + state["b"]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = (p - np.eye(2)[y[pick]]) * weight[pick, None] / len(pick)
            grads = {"W": mean.T @ g + decay * state["W"], "b": g.sum(axis=0)}
            rows, at_row = np.unique(flat, return_inverse=True)
            ge = summed((g @ state["W"].T / sizes[:, None])[of], at_row, len(rows)) + decay * state["E"][rows]
            state["t"] += 1
            for name, grad, sel in (("W", grads["W"], slice(None)), ("b", grads["b"], slice(None)), ("E", ge, rows)):
                m, v = state["m" + name], state["v" + name]
                m[sel] = 0.9 * m[sel] + 0.1 * grad
                v[sel] = 0.999 * v[sel] + 0.001 * grad**2
                state[name][sel] -= rate * (m[sel] / (1 - 0.9 ** state["t"])) / (np.sqrt(v[sel] / (1 - 0.999 ** state["t"])) + 1e-8)


def train(given: list[str], labels: list[int], seed: int = 7, rounds: int = 3) -> Model:
    y = np.array(labels, np.int64)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(1 << BITS), np.zeros(TOP + 2), (np.zeros(1), np.full(1, share)))
    rng = np.random.default_rng(seed)
    held = rng.random(len(y)) < 0.25
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held = np.zeros(len(y), bool)
    mine, my = [t for t, h in zip(given, held, strict=True) if not h], y[~held]
    state: dict = {"E": rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32), "W": rng.normal(0, 0.3, (DIM, 2)), "b": np.zeros(2), "t": 0}
    state |= {p + k: np.zeros_like(state[k]) for k in ("E", "W", "b") for p in "mv"}
    common = _support(mine) >= SUPPORT
    weights = None
    for turn in range(rounds + 1):
        # At first any window stands for its text's label; then those that the model finds worst do, and clean texts' worst ones are learned as clean.
        rich = SAMPLED // max(1, 2 * int((my == 1).sum())), SAMPLED // max(1, 2 * int((my == 0).sum()))
        some = [min(48, max(2, rich[1 - label] if label else rich[1])) if not turn else 1 for label in my]
        found: tuple[dict[str, int], dict[str, int]] = ({}, {})
        for wins, label in zip(_windows(mine, weights, [4 if turn else 0] * len(mine), some, rng), my, strict=True):
            for w in set(wins):
                found[label][w] = found[label].get(w, 0) + 1
        if turn:  # labels can be wrong, so what one toxic text has counts little, and what clean texts have as often not at all
            share = (my == 0).sum() / (my == 1).sum()
            pos = {w: min(n - 0.9, 8.0) for w, n in found[1].items() if n * share > 4 * found[0].get(w, 0)}
            for w, n in list(pos.items()):
                if n >= 1:
                    for _ in range(4):
                        bad = misspelled(w, rng)
                        if bad not in found[0]:
                            pos.setdefault(bad, n / 16)
        else:
            pos = {w: float(n) for w, n in found[1].items()}
        keys, wy = [*pos, *found[0]], np.array([1] * len(pos) + [0] * len(found[0]))
        weight = np.array([*pos.values(), *map(float, found[0].values())])
        for label in (0, 1):
            weight[wy == label] *= len(keys) / 2 / max(1e-9, weight[wy == label].sum())
        bags = [r[common[r]] for r in bags_of(keys)]
        _fit(bags, wy, weight, state, rng, 2 if not turn else 4)
        weights = np.where(common, state["E"] @ (state["W"][:, 1] - state["W"][:, 0]), 0)
    check = [t for t, h in zip(given, held, strict=True) if h] if held.any() else mine
    cy = y[held] if held.any() else my
    best = np.concatenate([Bags(p).best(weights) for _, p in _parts(check)])
    pool = _pooled(best, cy)
    return Model(weights, pool, isotonic(best @ pool[:-1] + pool[-1], cy))


def _pooled(best: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The logistic regression of labels on texts' best windows, which may only add to toxicity; ridge and Newton steps."""
    scale = best.std(axis=0) + 1e-9
    x = np.concatenate([best / scale, np.ones((len(best), 1))], axis=1)
    use = np.ones(x.shape[1], bool)
    while True:
        w = np.zeros(x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x[:, use] @ w[use], -30, 30)))
            h = (x[:, use] * (p * (1 - p))[:, None]).T @ x[:, use] + 1e-2 * len(x) ** 0.5 * np.eye(use.sum())
            w[use] -= np.linalg.solve(h, x[:, use].T @ (p - y) + 1e-2 * len(x) ** 0.5 * w[use])
        bad = use.copy()
        bad[:-1] &= w[:-1] < 0
        bad[-1] = False
        if not bad.any():
            return np.concatenate([w[:-1] / scale, w[-1:]])
        use &= ~bad


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, use: Column, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """At most max_rows labelled texts with at most max_chars characters together, by a hash of the identifier.

    First the identifiers are chosen, by their lengths, then only their texts are
    fetched.  A text that does not fit is passed over.
    """
    marks = labels.filter(F.col(label).isin(0, 1)).select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).groupBy("id").agg(F.max("y").alias("y"))
    sized = docs.select(F.col(id_col).alias("id"), F.length(text_col).alias("n")).filter(use(F.col("id")) & F.col("n").isNotNull())
    sized = written(sized.join(marks, "id").groupBy("id", "y").agg(F.max("n").alias("n")).filter(F.col("n") <= max_chars), "toxicity-labelled")
    found = lowest(sized, F.xxhash64("id"), "id", max_rows).collect()
    chosen, n = {}, 0
    for r in found:
        if n + r["n"] > max_chars:
            continue
        n += r["n"]
        chosen[r["id"]] = r["y"]
    if not chosen:
        return []
    ids = docs.sparkSession.createDataFrame([(i,) for i in chosen], f"id {docs.schema[id_col].dataType.simpleString()}")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")  # max_rows identifiers at most
    return sorted((i, t or "", chosen[i]) for i, t in rows.groupBy("id").agg(F.min("text")).collect())


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> Model:
    found = sample(docs, labels, "toxic", lambda i: ~held_out(i), max_rows, max_chars, id_col, text_col)
    return train([t for _, t, _ in found], [y for _, _, y in found])


def with_score(df: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """df with the toxicity of its texts, from 0 to 1; a column of that name is replaced."""
    df = df.drop(*[c for c in df.columns if c.lower() == name.lower()])
    held = df.sparkSession.sparkContext.broadcast((model.weights, model.pool, model.knots))

    def score(batches):
        m = Model(*held.value)
        for batch in batches:
            for b in blocks(batch, text_col):
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(m.scores(texts(b, text_col)), pa.float64())], names=[*b.schema.names, name])

    from pyspark.sql import types as T

    return text_batches(df).mapInArrow(score, T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())]))


def reject(df: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """df without its toxic texts."""
    name = free_name(df, "__score")
    return with_score(df, model, text_col, name).filter(F.col(name) < threshold).drop(name)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"))
    scored = with_score(docs, model).drop("text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
