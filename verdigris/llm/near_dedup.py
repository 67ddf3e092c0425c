"""Op 7, near-dedup: improved consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of five-word shingles (lower case, split at white
space; a shorter text is one shingle), of weight (1 + ln occurrences) x IDF, so
that a line repeated a thousand times does not make the text.  Document
frequencies of all documents are counted in a count-min sketch of fixed size.
IDF is 1 up to a share of RARE of the documents and falls to LEAST_IDF for a
shingle that all have, so boilerplate weighs less, and a large family of copies
does not lose its own shingles.

Improved consistent weighted sampling draws HASHES samples of each set, equal
for two sets with a probability of their weighted Jaccard similarity.  ROWS
samples make a band.  Texts that share a band are candidates:

- exact copies count as one text from the start;
- in a bucket of at most ALL_PAIRS texts every pair is a candidate;
- in a larger one each text is compared with the bucket's centre, the text whose
  bands are the most common ones (edited copies share bands with their original
  more than with each other), and again with the centres of finer buckets, of
  two bands at a time, whose pairs are all candidates if they are few;
- what is then still in different classes of a larger bucket is compared text by
  text, in tiles of two blocks of the bucket, so no pair of a bucket is left out.

Candidates are verified on their whole texts: two texts are linked if their
weighted Jaccard similarity, or that of the plain sets, is THRESHOLD or more.
Classes are the connected components of the links, found by alternating large
and small stars; a class is named by its smallest identifier.

Scale: texts are read once for frequencies, once for samples, and those of
candidates once more.  Copies of a hot group are summed before any shuffle, no
bucket is collected into one task, and hosts of many comparisons are repeated
once for SHARE partners.  The tiles of a bucket are quadratic in its texts if these
are of several classes; each tile is bounded, and its pairs are no rows.

Defined cases: null and empty texts are copies of each other and like no other
text; rows that share an identifier share its class; a null identifier is
larger than any other; an empty table gives an empty result; further columns
are kept by ``deduplicate``, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_CHARS, FEW_ROWS, blocks, free_name, join_checked, join_spread, mix64, partitions, table, text_batches, written

SHINGLE = 5
THRESHOLD = 0.8
RARE, LEAST_IDF, IDF_STEPS = 0.005, 0.5, 16
HASHES, ROWS = 60, 3
BANDS = HASHES // ROWS
ALL_PAIRS, FINE_PAIRS = 8, 4
SHARE = 128
#: Most texts and shingles of a block, on average; two blocks make a tile.
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 1 << 21
#: The count-min sketch: DEPTH rows of WIDTH counters, moved in pieces.
DEPTH, WIDTH_BITS, PIECE_BITS = 3, 18, 14
#: Entries in the tables of random variables that samples draw from.
DRAWS_BITS = 15
_NONE = (1 << 63) - 1
_DOC_BITS = 15
_HASH_BITS = 64 - _DOC_BITS
_P, _Q = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_odd = lambda n, seed: np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingles:
    """The distinct shingles of a block of texts: by text, hash (49 bits) and occurrences, sorted."""

    def __init__(self, column: pa.Array):
        low = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
        self.n = n = len(low)
        ends = np.frombuffer(low.buffers()[1], np.int64)[low.offset : low.offset + n + 1]
        data = np.frombuffer(low.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]] if n else np.zeros(0, np.uint8)
        ends = ends - ends[0]
        word = ~((data == 32) | ((data >= 9) & (data <= 13)))
        border = np.zeros(len(data) + 1, bool)
        border[ends] = True
        before = np.concatenate([[True], ~word])[:-1] | border[:-1] if len(data) else np.zeros(0, bool)
        after = np.concatenate([~word[1:], [True]]) | border[1:] if len(data) else np.zeros(0, bool)
        starts, stops = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
        # Polynomial hashes of the words from one running sum modulo 2^64.
        power = np.full(len(data) + 1, _P, np.uint64)
        power[:1] = 1
        power = np.multiply.accumulate(power)
        inverse = np.full(len(data) + 1, pow(_P, -1, 1 << 64), np.uint64)
        inverse[:1] = 1
        inverse = np.multiply.accumulate(inverse)
        so_far = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1])])
        words = mix64((so_far[stops] - so_far[starts]) * inverse[starts])
        text = np.searchsorted(ends, starts, side="right") - 1
        count = np.bincount(text, minlength=n)[:n] if n else np.zeros(0, np.int64)
        first = np.cumsum(count) - count
        hashes = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
        factor = [np.uint64(pow(_Q, k + 1, 1 << 64)) for k in range(SHINGLE)]
        for k in range(SHINGLE):
            hashes += words[k : len(words) - SHINGLE + 1 + k] * factor[k]
        inside = text[: len(hashes)] == text[SHINGLE - 1 :] if len(hashes) else np.zeros(0, bool)
        short = np.flatnonzero((count > 0) & (count < SHINGLE))
        whole = count[short].astype(np.uint64)
        for k in range(SHINGLE - 1):
            has = k < count[short]
            whole = whole + np.where(has, words[np.where(has, first[short] + k, 0)] * factor[k], np.uint64(0)) if len(words) else whole
        of = np.concatenate([text[: len(hashes)][inside], short]).astype(np.uint64)
        h = mix64(np.concatenate([hashes[inside], whole])) >> np.uint64(_DOC_BITS)
        key = np.sort((of << np.uint64(_HASH_BITS)) | h)
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        self.times = np.diff(np.concatenate([new, [len(key)]]))
        key = key[new]
        self.hash = key & np.uint64((1 << _HASH_BITS) - 1)
        self.text = (key >> np.uint64(_HASH_BITS)).astype(np.int64)
        self.bounds = np.searchsorted(self.text, np.arange(n + 1))


def _slots(h: np.ndarray, depth: int) -> np.ndarray:
    return ((h * _odd(DEPTH, 3)[depth]) >> np.uint64(64 - WIDTH_BITS)).astype(np.int64)


def _text_blocks(batch: pa.RecordBatch):
    for b in blocks(batch, chars=2 * BLOCK_CHARS):
        for at in range(0, b.num_rows, 1 << _DOC_BITS):
            yield b.slice(at, 1 << _DOC_BITS)


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """The count-min sketch of document frequencies of all rows (text), and the number of rows.

    Each task sends its sketch in compressed pieces; pieces are summed as they
    come.  The sketch has a fixed size, so it can be collected and broadcast.
    """
    pieces = DEPTH << (WIDTH_BITS - PIECE_BITS)

    def count(batches):
        total, rows = np.zeros((DEPTH, 1 << WIDTH_BITS), np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for b in _text_blocks(batch):
                h = Shingles(b.column(b.schema.get_field_index("text"))).hash
                for d in range(DEPTH):
                    total[d] += np.bincount(_slots(h, d), minlength=1 << WIDTH_BITS)
        parts = total.reshape(pieces, -1)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(range(pieces), pa.int32()), pa.array([rows] * pieces, pa.int64()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts])], names=["piece", "rows", "counts"])

    def add(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for piece, rows, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine = held.setdefault(piece, [0, np.zeros(1 << PIECE_BITS, np.int64)])
                mine[0] += rows
                mine[1] += np.frombuffer(zlib.decompress(counts), np.int64)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x[0] for x in held.values()], pa.int64()), pa.array([zlib.compress(x[1].tobytes(), 1) for x in held.values()])], names=["piece", "rows", "counts"])

    kinds = "piece int, rows long, counts binary"
    summed = text_batches(docs.select("text")).mapInArrow(count, kinds).repartition(min(pieces, partitions(docs.sparkSession)), "piece").mapInArrow(add, kinds).collect()
    sketch = np.zeros((pieces, 1 << PIECE_BITS), np.int64)
    for r in summed:
        sketch[r["piece"]] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return sketch.reshape(DEPTH, -1), summed[0]["rows"] if summed else 0


class Weights:
    """TF-IDF weights from a sketch: IDF in steps, by the share of documents that have a shingle."""

    def __init__(self, sketch: np.ndarray, rows: int):
        share = sketch / max(rows, 1)
        fall = (1 - LEAST_IDF) * np.log(np.clip(share, RARE, 1) / RARE) / np.log(1 / RARE)
        self.idf = (1 - np.round(fall * IDF_STEPS / (1 - LEAST_IDF)) * (1 - LEAST_IDF) / IDF_STEPS).astype(np.float32)

    def of(self, s: Shingles) -> np.ndarray:
        idf = self.idf[0][_slots(s.hash, 0)]
        for d in range(1, DEPTH):
            idf = np.maximum(idf, self.idf[d][_slots(s.hash, d)])
        return (1 + np.log(s.times)) * idf


class _Kept(list):
    """What a process has made; it does not travel with the functions that use it."""

    def __reduce__(self):
        return _Kept, ()


_kept = _Kept()


def _draws():
    """Per hash: multipliers, and tables of r, ln c (both Gamma(2, 1)) and beta with the key of a shingle of weight 1."""
    if not _kept:
        rng = np.random.default_rng(2010)
        size = (HASHES, 1 << DRAWS_BITS)
        gamma = lambda: rng.standard_exponential(size, np.float32) + rng.standard_exponential(size, np.float32)
        r, c, beta = gamma(), np.log(gamma()), rng.random(size, np.float32)
        _kept.append((_odd(HASHES, 5), _odd(HASHES, 7), r, c, beta, _sortable(c + r * beta - r) << np.uint64(32)))
    return _kept[0]


def _sortable(x: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the floats."""
    bits = x.astype(np.float32).view(np.uint32)
    return np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)


def samples(s: Shingles, weight: np.ndarray) -> np.ndarray:
    """HASHES samples of 32 bits for each text with shingles; a row for each text, 0 for those without.

    By Ioffe's scheme: a shingle of weight S has t = floor(ln S / r + beta) and
    ln a = ln c - r (t - beta) - r; the least a is the sample, with its t.
    """
    first, second, r, c, beta, unit = _draws()
    out = np.zeros((s.n, HASHES), np.uint32)
    some = np.flatnonzero(np.diff(s.bounds))
    if not len(some):
        return out
    at = s.bounds[some]
    other = np.flatnonzero(weight != 1)
    log_weight = np.log(weight[other]).astype(np.float32)
    for k in range(HASHES):
        draw = (s.hash * first[k]) >> np.uint64(64 - DRAWS_BITS)
        name = (s.hash * second[k]) >> np.uint64(32)
        key = unit[k][draw]
        if len(other):
            d = draw[other]
            t = np.floor(log_weight / r[k][d] + beta[k][d])
            key[other] = _sortable(c[k][d] - r[k][d] * (t - beta[k][d]) - r[k][d]) << np.uint64(32)
            name[other] = (name[other] + (t.astype(np.int64) * 0x9E3779B1).astype(np.uint64)) & np.uint64(0xFFFFFFFF)
        out[some, k] = (np.minimum.reduceat(key | name, at) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return out


def bands(sampled: np.ndarray) -> np.ndarray:
    """BANDS keys of 64 bits for each row of samples."""
    keys = np.zeros((len(sampled), BANDS), np.uint64)
    for k in range(ROWS):
        keys = mix64(keys * np.uint64(_Q) + sampled[:, k::ROWS].astype(np.uint64) + np.uint64(k + 1))
    return mix64(keys + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(_P)).astype(np.int64)


def _signed(docs: DataFrame, held) -> DataFrame:
    """id, digest, bands (none for a text without words) and number of shingles for rows (id, text)."""
    def run(batches):
        w = Weights(*held.value)
        for batch in batches:
            for b in _text_blocks(batch):
                s = Shingles(b.column(2))
                sampled = samples(s, w.of(s))
                has = np.diff(s.bounds) > 0
                offsets = pa.array(np.concatenate([[0], np.cumsum(has * BANDS)]), pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(offsets, pa.array(bands(sampled)[has].ravel(), pa.int64())), pa.array(np.diff(s.bounds), pa.int64())], names=["id", "digest", "bands", "shingles"])

    rows = docs.select("id", F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    return text_batches(rows).mapInArrow(run, "id long, digest binary, bands array<long>, shingles long")


def _centred(members: DataFrame) -> DataFrame:
    """members (id, key, size) with the pivot of their key: the text whose keys are the most common."""
    common = members.groupBy("id").agg(F.sum("size").alias("common"))
    known = members.join(common, "id")
    pivots = known.groupBy("key").agg(F.max(F.struct("common", (-F.col("id")).alias("minus")))["minus"].alias("minus"), F.count("*").alias("n"))
    pivots = written(pivots.select("key", (-F.col("minus")).alias("pivot"), "n"), "near-pivots")
    return join_spread(members, pivots.drop("n"), "key", "id", pivots.select("key", "n"))


def _bucketed(keyed: DataFrame) -> DataFrame:
    """Rows (id, key) of keys that several have, with their number: id, key, size."""
    sizes = written(keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "near-sizes")
    return join_spread(keyed, sizes, "key", "id", sizes.withColumnRenamed("size", "n"))


def _pairs_within(members: DataFrame, most: int) -> DataFrame:
    """All pairs (a < b) of the keys with at most so many texts; equal groups are listed once."""
    groups = members.filter(F.col("size") <= most).groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids")).select("ids").distinct()
    pairs = F.flatten(F.transform("ids", lambda a: F.transform(F.filter("ids", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return groups.select(F.explode(pairs).alias("p")).select("p.a", "p.b")


def _to_pivots(members: DataFrame) -> DataFrame:
    """Pairs (a = pivot, b) of each text with its key's pivot."""
    return members.filter("id != pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b"))


def _verified(pairs: DataFrame, docs: DataFrame, held, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are alike.

    a is the host of the comparison.  A host with many partners is repeated for
    each share of them; partners and host then meet in one sorted partition,
    through which the comparison streams.
    """
    pairs = written(pairs.distinct(), "near-pairs")
    hosted = written(pairs.groupBy("a").agg(F.count("*").alias("n")), "near-hosts")
    many = hosted.filter(F.col("n") > SHARE).select("a", F.ceil(F.col("n") / SHARE).cast("int").alias("shares"))
    placed = join_spread(pairs, many, "a", "b", hosted, "left")
    placed = placed.select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("shares", F.lit(1))).cast("int").alias("share"))
    wanted = placed.select(F.col("b").alias("id"), F.col("a").alias("host"), "share", F.lit(1).alias("part"))
    hosts = placed.select(F.col("a").alias("id"), F.col("a").alias("host"), "share", F.lit(0).alias("part")).distinct()
    wanted = written(wanted.unionByName(hosts), "near-wanted")
    counts = written(wanted.groupBy("id").agg(F.count("*").alias("n")), "near-counts")
    texts = join_checked(docs, counts.select("id"), "id", "left_semi")
    rows = join_spread(wanted, texts, "id", "host", counts, distinct=("text",)).select("host", "share", "part", "id", "text")

    def compare(batches):
        w, host, now = Weights(*held.value), [], None
        for batch in batches:
            for b in _text_blocks(batch):
                s = Shingles(b.column(4))
                weight = w.of(s)
                found = []
                for i, (h, share, part, id_) in enumerate(zip(*(b.column(k).to_pylist() for k in range(4)), strict=True)):
                    mine = s.hash[s.bounds[i] : s.bounds[i + 1]], weight[s.bounds[i] : s.bounds[i + 1]]
                    if part == 0:
                        host = [*host, mine] if now == (h, share) else [mine]
                        now = h, share
                    elif now == (h, share) and any(_alike(*x, *mine, threshold) for x in host):
                        found.append((h, id_))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

    dealt = rows.repartition("host", "share").sortWithinPartitions("host", "share", "part")
    return written(text_batches(dealt).mapInArrow(compare, "a long, b long"), "near-links")


def similarities(h1: np.ndarray, w1: np.ndarray, h2: np.ndarray, w2: np.ndarray) -> tuple[float, float]:
    """Weighted and plain Jaccard similarity of two sorted weighted sets."""
    if not len(h1) or not len(h2):
        return 0.0, 0.0
    at = np.minimum(np.searchsorted(h1, h2), len(h1) - 1)
    both = h1[at] == h2
    n = int(both.sum())
    least = float(np.minimum(w1[at[both]], w2[both]).sum())
    return least / (float(w1.sum()) + float(w2.sum()) - least), n / (len(h1) + len(h2) - n)


def _alike(h1, w1, h2, w2, threshold: float) -> bool:
    if min(len(h1), len(h2)) == 0:
        return False
    return max(similarities(h1, w1, h2, w2)) >= threshold - 1e-9


class _Tile:
    """The texts of one block of a bucket, with which others are compared at once through an index of their shingles.

    Links are told that join two classes the tile has not joined yet.
    """

    def __init__(self):
        self.hosts, self.parts, self.root = [], [], {}

    def _find(self, class_: int) -> int:
        while (up := self.root.get(class_, class_)) != class_:
            class_ = up
        return class_

    def index(self) -> None:
        """Two indexes: the texts of the most common class need not be compared with each other."""
        common = Counter(x[1] for x in self.hosts).most_common(1)[0][0]
        for only, group in ((common, [x for x in self.hosts if x[1] == common]), (None, [x for x in self.hosts if x[1] != common])):
            if group:
                h, weight = (np.concatenate([x[k] for x in group]) for k in (2, 3))
                sizes = np.array([len(x[2]) for x in group])
                order = np.argsort(h, kind="stable")
                self.parts.append((only, group, h[order], np.repeat(np.arange(len(group)), sizes)[order], weight[order], sizes, np.array([x[3].sum() for x in group])))

    def links(self, text: tuple, threshold: float) -> list[tuple[int, int]]:
        id_, class_, mine, weight = text
        found = []
        for only, group, h, of, w, sizes, sums in self.parts:
            if class_ == only:
                continue
            low = np.searchsorted(h, mine)
            n = np.searchsorted(h, mine, side="right") - low
            at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.bincount(of[at], minlength=len(group))
            least = np.bincount(of[at], np.minimum(w[at], np.repeat(weight, n)), len(group))
            like = np.maximum(both / (sizes + len(mine) - both), least / (sums + weight.sum() - least))
            for k in np.flatnonzero(like >= threshold - 1e-9):
                a, b = self._find(class_), self._find(group[k][1])
                if a != b:
                    self.root[max(a, b)] = min(a, b)
                    found.append((group[k][0], id_))
        return found

    def among(self, threshold: float) -> list[tuple[int, int]]:
        return [x for text in self.hosts for x in self.links(text, threshold)]


def _across(large: DataFrame, crowded: DataFrame, classes: DataFrame, docs: DataFrame, held, threshold: float) -> DataFrame:
    """Links (a, b) between texts of a bucket that are in different classes, enough of them to join the classes that any such link joins."""
    sized = crowded.groupBy("id").agg(F.sum("shingles").alias("shingles"))
    known = large.select("key", "id").distinct().join(sized, "id").join(classes, "id", "left").withColumn("class_id", F.coalesce("class_id", "id"))
    known = written(known, "near-known")
    blocks_ = F.ceil(F.greatest(F.count("*") / BLOCK_TEXTS, F.sum("shingles") / BLOCK_SHINGLES)).cast("int")
    mixed = known.groupBy("key").agg(F.min("class_id").alias("least"), F.max("class_id").alias("most"), blocks_.alias("blocks"), F.count("*").alias("n"))
    mixed = written(mixed.filter("least < most").select("key", "blocks", "n"), "near-mixed")
    placed = join_spread(known, mixed.drop("n"), "key", "id", mixed.select("key", "n")).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    tiles = placed.select("key", "id", "class_id", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    tiles = tiles.select("key", "id", "class_id", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("part"))
    tiles = written(tiles, "near-tiles")
    texts = join_checked(docs, tiles.select("id").distinct(), "id", "left_semi").repartition("id").dropDuplicates(["id", "text"])
    rows = texts.join(tiles, "id").select("key", "i", "j", "part", "id", "class_id", "text")

    def compare(batches):
        w, tile, now = Weights(*held.value), _Tile(), None

        def begun():
            """Index the block when all of it is there; its own pairs are those of the tile on the diagonal."""
            if now is None or tile.parts or not tile.hosts:
                return []
            tile.index()
            return tile.among(threshold) if now[1] == now[2] else []

        def told(found):
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for b in _text_blocks(batch):
                s = Shingles(b.column(6))
                weight = w.of(s)
                found = []
                for n, (key, i, j, part, id_, class_) in enumerate(zip(*(b.column(k).to_pylist() for k in range(6)), strict=True)):
                    # Copies: a slice would keep its whole block.
                    text = id_, class_, s.hash[s.bounds[n] : s.bounds[n + 1]].copy(), weight[s.bounds[n] : s.bounds[n + 1]].copy()
                    if now != (key, i, j):
                        found += begun() if now and now[1] == now[2] else []
                        tile, now = _Tile(), (key, i, j)
                    if part == 0:
                        tile.hosts.append(text)
                    else:
                        found += begun() + tile.links(text, threshold)
                if found:
                    yield told(found)
        if now and now[1] == now[2]:
            yield told(begun())

    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "part")
    return written(text_batches(dealt).mapInArrow(compare, "a long, b long"), "near-across")


def components(links: DataFrame) -> DataFrame:
    """id, class_id (the smallest id connected with it) for every id in links (a, b).

    Alternating large and small stars until no link changes: each round hangs
    larger neighbours, then smaller ones, on the smallest one known.
    """
    links = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "stars")
    state, spread = None, links.count() > FEW_ROWS // 2
    # What is read several times is written down, unless it is little.
    fixed = written if spread else lambda df, _: df
    meet = join_spread if spread else lambda left, right, on, *_: left.join(right, on)
    while True:
        both = links.union(links.select("v", "u"))
        least = fixed(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n")), "stars-least")
        large = meet(both.filter("v > u"), least.drop("n"), "u", "v", least.select("u", "n"))
        large = fixed(large.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct(), "stars-large")
        low = fixed(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "stars-low")
        small = meet(large, low.drop("n"), "u", "v", low.select("u", "n")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        links = written(small.filter("u != v").distinct(), "stars")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return links.select(F.col("u").alias("id"), F.col("v").alias("class_id"))


def classify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id, class_id (the smallest id of its class), kept for each row of df; ids are whole numbers."""
    kind = df.schema[id_col].dataType.simpleString()
    real = lambda c: F.when(F.col(c) != _NONE, F.col(c)).cast(kind)
    return _classified(df, id_col, text_col, threshold).select(real("id").alias(id_col), real("class_id").alias("class_id"), (F.col("id") == F.col("class_id")).alias("kept"))


def _classified(df: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    spark = df.sparkSession
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NONE)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    held = spark.sparkContext.broadcast(frequencies(docs))
    signed = written(_signed(docs, held), "near-signed")
    # Texts, each by the smallest id that has it.
    unique = signed.groupBy("digest").agg(F.min("id").alias("text_id"), F.first("bands").alias("bands"), F.first("shingles").alias("shingles"), F.count("*").alias("n"))
    unique = written(unique, "near-texts")
    keyed = unique.select(F.col("text_id").alias("id"), F.explode("bands").alias("key"))
    members = written(_bucketed(keyed), "near-members")
    large = written(_centred(members.filter(F.col("size") > ALL_PAIRS)), "near-large")
    candidates = _pairs_within(members, ALL_PAIRS).union(_to_pivots(large))
    # Finer buckets: two bands at a time.
    crowded = join_checked(unique.withColumnRenamed("text_id", "id"), large.select("id").distinct(), "id", "left_semi")
    two = F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda i: F.xxhash64(F.element_at("bands", i), F.element_at("bands", (i % BANDS) + 1), i))
    finer = written(_bucketed(crowded.filter(F.size("bands") > 0).select("id", F.explode(two).alias("key"))), "near-finer")
    candidates = candidates.union(_pairs_within(finer, FINE_PAIRS)).union(_to_pivots(_centred(finer.filter(F.col("size") > FINE_PAIRS))))
    links = _verified(candidates, docs, held, threshold)
    # Texts of one id are one document.
    classes = components(links)
    across = _across(large, crowded, classes, docs, held, threshold)
    if not across.isEmpty():
        classes = components(classes.select(F.col("id").alias("a"), F.col("class_id").alias("b")).union(across))
    texts = unique.select("digest", "text_id").join(classes.withColumnRenamed("id", "text_id"), "text_id", "left").select("digest", F.coalesce("class_id", "text_id").alias("class_id"))
    return join_spread(signed.select("id", "digest"), texts, "digest", "id", unique.select("digest", "n")).select("id", "class_id")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """df with one row of each class, that of its smallest id, with all its columns."""
    groups = written(_classified(df, id_col, text_col, threshold), "near-groups")
    id_ = free_name(df, "__id")
    keyed = df.withColumn(id_, F.coalesce(F.col(id_col).cast("long"), F.lit(_NONE)))
    kept = join_checked(keyed, groups.filter("id != class_id").select(F.col("id").alias(id_)).distinct(), id_, "left_anti")
    repeated = groups.filter("id = class_id").groupBy("id").count().filter("count > 1").select(F.col("id").alias(id_))
    if not repeated.isEmpty():
        once = join_checked(kept, repeated, id_, "left_semi").dropDuplicates([id_])
        kept = join_checked(kept, repeated, id_, "left_anti").unionByName(once)
    return kept.select(df.columns)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))
