"""Near duplicates: a word n-gram Jaccard join with Bayesian candidate pruning.

Texts with the same set of n-grams are one *set*; its first row stands for it, so copies are never compared. Candidates are the sets that share a band of MinHash
values. A candidate pair's values are compared a few at a time, and the pair is dropped when the posterior probability that its similarity reaches the threshold
falls below the tolerance; what is left is verified on the n-grams themselves. Classes are the connected components of the verified links.

Every two sets that share a band are compared, once, so ``n_links`` counts all of a set's links. Pairs are never moved as such: sets that share a band go as lists into cells, a fixed
square of places by a hash, where the pairs are formed, made distinct and pruned; what survives is verified in tiles of neighbours, and of a tile only each set's number of
links and a spanning forest go on. A band that many share spreads over all cells, so no task has a whole hot band's pairs. All aggregates combine before the shuffle.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.rows import row_key, slices
from corpuskit.storage import discard, kept_at, written

NGRAM, THRESHOLD, TOLERANCE = 3, 0.5, 1e-6
#: At the threshold 0.994 of all pairs share a band (1 - (1 - 0.5 ** 4) ** 80), at 0.6 all but some in a hundred thousand.
BANDS, BAND_ROWS = 80, 4
#: MinHash values compared at a time.
STEP = 32
#: MinHash values by which pairs are pruned first; only sets of pairs that outlive them are looked at further.
HEAD = 64
#: Rows of ids that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 19
#: Sets of a band that are paired where they are found; those of a larger band go on in parts of so many and meet, part by part, in the cells.
BLOCK = 512
#: Cells, pairs of which the candidates are spread over, for each partition.
CELLS = 4
#: Sets, and n-grams of them, of one side of a tile, about: pairs are verified in tiles, each of which gets a set once for all its pairs.
TILE_SETS, TILE_SHINGLES = 256, 1 << 20
#: Pairs of a cell or a tile that are looked at at once.
PAIRS = 1 << 20
#: Code points hashed at once.
PIECE = 1 << 19

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Of each code point: 0 no part of a word, 1 a part of one, 2 a word by itself (ideographs and kana, which are written without spaces)."""
    import unicodedata

    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        out[c] = unicodedata.category(chr(c))[0] in "LMN"
    out[ord("_")] = 1
    for a, b in ((0x3041, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)):
        out[a : b + 1][out[a : b + 1] == 1] = 2
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(size: int) -> np.ndarray:
    return np.cumprod(np.full(size, np.uint64(0x9E3779B97F4A7C15)))


def _words_of(x: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Hashes of the words of a stretch of code points."""
    inside = kinds > 0
    start = inside.copy()
    start[1:] &= ~inside[:-1] | (kinds[1:] == 2) | (kinds[:-1] == 2)
    begins = np.flatnonzero(start)
    if not len(begins):
        return np.zeros(0, np.uint64)
    at = np.flatnonzero(inside)
    word = np.cumsum(start[at]) - 1
    place = at - begins[word]
    longest = int(place.max()) + 1
    value = (x[at].astype(np.uint64) + np.uint64(1)) * _powers(1 << (longest - 1).bit_length() if longest > 64 else 64)[place]
    return _mixed(np.add.reduceat(value, np.searchsorted(at, begins)))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the lower-cased words of a whole text, in order."""
    x = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(x):
        return np.zeros(0, np.uint64)
    kinds = _kinds()[x]
    out, at = [], 0
    while at < len(x):
        end = min(len(x), at + PIECE)
        if end < len(x):  # cut between words: back to the last place that is none, or on to the next
            gaps = np.flatnonzero(kinds[at:end] == 0)
            if len(gaps) and gaps[-1]:
                end = at + int(gaps[-1])
            else:
                gaps = np.flatnonzero(kinds[end:] == 0)
                end = end + int(gaps[0]) if len(gaps) else len(x)
        out.append(_words_of(x[at:end], kinds[at:end]))
        at = end
    return np.concatenate(out)


def shingles(text: str, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; of fewer than n words, the one of all of them; of none, nothing."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = min(n, len(w))
    size = len(w) - n + 1
    h = np.full(size, np.uint64(n))
    for k in range(n):
        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + w[k : k + size])
    return np.unique(h)


@lru_cache(maxsize=4)
def _multipliers(count: int) -> np.ndarray:
    return np.random.default_rng(11).integers(0, 1 << 31, count, np.uint32) * np.uint32(2) + np.uint32(1)


def minhashes(s: np.ndarray, count: int) -> np.ndarray:
    """``count`` MinHash values of a non-empty set."""
    a = _multipliers(count)
    x = (s >> np.uint64(32)).astype(np.uint32)
    least = np.full(count, np.uint32(0xFFFFFFFF))
    for at in range(0, len(x), 512):
        np.minimum(least, (x[at : at + 512, None] * a).min(axis=0), out=least)
    return least


def bands_of(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    v = values[: bands * rows].reshape(bands, rows).astype(np.uint64)
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + v[:, k])
    return h.view(np.int64)


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float, count: int, step: int = STEP) -> tuple[tuple[int, int], ...]:
    """(values compared, matches needed to go on). A match of a value's 8 bits has probability p = s + (1 - s) / 256 at similarity s; the prior of s is uniform."""
    s = (np.arange(20000) + 0.5) / 20000
    p = s + (1 - s) / 256
    out = []
    for n in range(step, count + 1, step):
        needed = n + 1
        for m in range(n, -1, -1):
            log = m * np.log(p) + (n - m) * np.log(1 - p)
            weight = np.exp(log - log.max())
            if weight[s >= threshold].sum() < tolerance * weight.sum():
                break
            needed = m
        out.append((n, needed))
    return tuple(out)


def surviving(a: np.ndarray, b: np.ndarray, threshold: float, tolerance: float) -> np.ndarray:
    """Of pairs of signatures (rows of bytes), which ones pass every step."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    at = 0
    for n, needed in least_matches(threshold, tolerance, a.shape[1]):
        matches[alive] += (a[alive, at:n] == b[alive, at:n]).sum(axis=1)
        alive = alive[matches[alive] >= needed]
        at = n
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets."""
    if not len(a) and not len(b):
        return 1.0
    common = len(a) + len(b) - len(np.union1d(a, b))
    return common / (len(a) + len(b) - common)


def _featured(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.binary()), ("set_key", pa.binary()), ("n_shingles", pa.int64()), ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                keys, counts, sigs, every = [], [], [], []
                for text in part.column(2).to_pylist():
                    s = shingles(text, n)
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    counts.append(len(s))
                    if len(s):
                        v = minhashes(s, bands * rows)
                        sigs.append(v.astype(np.uint8).tobytes())
                        every.append(bands_of(v, bands, rows))
                    else:
                        sigs.append(b"")
                        every.append(np.zeros(0, np.int64))
                offsets = np.cumsum([0] + [len(e) for e in every]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(every)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(part.column(1).to_pylist(), pa.binary()), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(sigs, pa.binary()), lists], schema=schema)

    return docs.mapInArrow(run, "doc_id long, row_key binary, set_key binary, n_shingles long, sig binary, bands array<long>")


def _small(ids: DataFrame) -> DataFrame:
    """A column or two of ids out of a written table, to be broadcast if they are few."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def _cell(uids: np.ndarray, cells: int) -> np.ndarray:
    return (_mixed(uids.view(np.uint64)) % np.uint64(cells)).astype(np.int64)


BLOCKS = "cell long, key long, part int, left array<long>, right array<long>"


def _blocks(feats: DataFrame, sets: DataFrame, partitions: int, cells: int) -> DataFrame:
    """Uids of sets that share a band, as BLOCKS, written. A set has one of ``cells`` numbers, by a hash, and a cell is a pair of numbers, so that a pair of sets lies in the same cell by whichever band it is found.

    A band of at most BLOCK sets is paired here: each of ``left`` is to be held against each of ``right``, or against each other where right is null. Of a larger one the sets go by their
    number (``part``) into rows without a cell, which ``_spread`` brings to all the cells of that number; nothing holds such a band as a whole.
    """
    rows = feats.where("n_shingles > 0").select("uid", "bands").join(_small(sets.select("uid")), "uid", "left_semi").select(F.explode("bands").alias("key"), "uid")
    schema = pa.schema([("cell", pa.int64()), ("key", pa.int64()), ("part", pa.int32()), ("left", pa.list_(pa.int64())), ("right", pa.list_(pa.int64()))])

    def paired(bucket: np.ndarray) -> Iterator[tuple]:
        own = _cell(bucket, cells)
        if len(bucket) == 2:
            i, j = sorted((0, 1), key=lambda k: own[k])
            yield own[i] * cells + own[j], None, None, bucket[i : i + 1], bucket[j : j + 1]
            return
        order = np.argsort(own, kind="stable")
        parts = np.split(bucket[order], np.flatnonzero(np.diff(own[order])) + 1)
        numbers = np.unique(own)
        for i, left in enumerate(parts):
            if len(left) > 1:
                yield numbers[i] * cells + numbers[i], None, None, left, None
            for j in range(i + 1, len(parts)):
                yield numbers[i] * cells + numbers[j], None, None, left, parts[j]

    class Bucket:
        """The band that is being read, as far as it has come."""

        def __init__(self, key: int) -> None:
            self.key, self.size, self.held = key, 0, []
            self.parts: dict[int, list[np.ndarray]] | None = None

        def add(self, uids: np.ndarray) -> Iterator[tuple]:
            self.size += len(uids)
            self.held.append(uids)
            if self.size > BLOCK:
                yield from self.deal(BLOCK)

        def deal(self, least: int) -> Iterator[tuple]:
            self.parts = {} if self.parts is None else self.parts
            uids = np.concatenate(self.held) if self.held else np.zeros(0, np.int64)
            self.held = []
            own = _cell(uids, cells)
            for n in np.unique(own).tolist():
                self.parts.setdefault(n, []).append(uids[own == n])
            for n, some in self.parts.items():
                if some and sum(map(len, some)) >= least:
                    whole = np.concatenate(some)
                    some.clear()
                    for at in range(0, len(whole), BLOCK):
                        yield None, self.key, n, whole[at : at + BLOCK], None

        def end(self) -> Iterator[tuple]:
            if self.parts is not None:
                yield from self.deal(1)
            elif self.size > 1:
                yield from paired(np.concatenate(self.held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        last: Bucket | None = None

        def found(batch: pa.RecordBatch) -> Iterator[tuple]:
            nonlocal last
            keys, uids = (batch.column(k).to_numpy() for k in (0, 1))
            cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            sizes = np.diff(cuts)
            # Bands of one set, and most are, say nothing; the first and the last of a batch may go on beyond it.
            telling = np.flatnonzero(sizes > 1).tolist()
            for k in sorted({0, *telling, len(sizes) - 1}):
                key, own = int(keys[cuts[k]]), uids[cuts[k] : cuts[k + 1]]
                if last is None or last.key != key:
                    if last is not None:
                        yield from last.end()
                    last = Bucket(key)
                yield from last.add(own)

        def flush() -> pa.RecordBatch:
            columns = [pa.array([x[k] for x in out], f.type) for k, f in enumerate(schema)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            if batch.num_rows:
                for x in found(batch):
                    out.append(x)
                    if len(out) >= 1024:
                        yield flush()
        if last is not None:
            out.extend(last.end())
        if out:
            yield flush()

    return written(rows.repartition(partitions, "key").sortWithinPartitions("key").mapInArrow(run, BLOCKS), "blocks")


def _spread(blocks: DataFrame, cells: int) -> DataFrame:
    """The blocks with their cells; parts of large bands in all cells of their number, with the side on which they stand (2: the same number on both sides)."""
    own = blocks.where("cell is not null").select("cell", F.lit(None).cast("long").alias("key"), F.lit(None).cast("int").alias("side"), "left", "right")
    parts = blocks.where("cell is null").select("key", "part", "left", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("other"))
    at = (F.least("part", "other").cast("long") * cells + F.greatest("part", "other")).alias("cell")
    side = F.when(F.col("part") < F.col("other"), 0).when(F.col("part") > F.col("other"), 1).otherwise(2).cast("int").alias("side")
    return own.unionByName(parts.select(at, "key", side, "left", F.lit(None).cast("array<long>").alias("right")))


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    """Rows (a, b) of all parts, each pair once, a < b."""
    pairs = np.concatenate(parts)
    pairs = np.stack([pairs.min(axis=1), pairs.max(axis=1)], axis=1)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    first = np.ones(len(pairs), bool)
    first[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
    return pairs[first]


def _product(x: np.ndarray, y: np.ndarray | None) -> np.ndarray:
    """All pairs of the two, or of the one."""
    if y is None:
        i, j = np.triu_indices(len(x), 1)
        return np.stack([x[i], x[j]], axis=1)
    return np.stack([np.repeat(x, len(y)), np.tile(y, len(x))], axis=1)


def _candidates(blocks: DataFrame, feats: DataFrame, partitions: int, cells: int, threshold: float, tolerance: float) -> DataFrame:
    """The pairs (a, b), a < b, of the blocks that aren't dropped by their first HEAD MinHash values. A cell gets these values once for each of its sets, and each pair however many bands it shares; a pair may be given twice where a cell has more than PAIRS."""
    spread = _spread(blocks, cells)
    members = spread.select("cell", F.explode(F.concat("left", F.coalesce("right", F.array().cast("array<long>")))).alias("uid")).distinct()
    sig = members.join(feats.select("uid", F.substring("sig", 1, HEAD).alias("sig")), "uid").select("cell", "uid", "sig")
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    rows = sig.select("cell", "uid", "sig", none("key", "long"), none("side", "int"), none("left", "array<long>"), none("right", "array<long>"))
    rows = rows.unionByName(spread.select("cell", none("uid", "long"), none("sig", "binary"), "key", "side", "left", "right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = key = None
        uids: list[int] = []
        sigs: list[bytes] = []
        known: tuple[np.ndarray, np.ndarray] | None = None
        parts: list[np.ndarray] = []
        facing: list[np.ndarray] = []  # of the part of a large band that is being read
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size, known
            if parts:
                if known is None:
                    known = np.array(uids, np.int64), np.frombuffer(b"".join(sigs), np.uint8).reshape(len(uids), -1)
                pairs = _distinct(parts)
                for at in range(0, len(pairs), 1 << 15):
                    some = pairs[at : at + (1 << 15)]
                    a, b = (known[1][np.searchsorted(known[0], some[:, k])] for k in (0, 1))
                    some = some[surviving(a, b, threshold, tolerance)]
                    if len(some):
                        yield pa.RecordBatch.from_arrays([pa.array(some[:, 0].copy()), pa.array(some[:, 1].copy())], names=["a", "b"])
            parts.clear()
            size = 0

        for batch in batches:
            columns = [batch.column(k) for k in range(7)]
            heads = list(zip(*(columns[k].to_pylist() for k in (0, 1, 2, 3, 4))))
            for k, (at, uid, sig, band, side) in enumerate(heads):
                if at != cell:
                    yield from flush()
                    cell, key, uids, sigs, known = at, None, [], [], None
                if uid is not None:
                    uids.append(uid)
                    sigs.append(sig)
                    continue
                left = columns[5][k].values.to_numpy()
                if side is None:
                    right = columns[6][k]
                    found = [_product(left, right.values.to_numpy() if right.is_valid else None)]
                else:
                    if band != key:
                        key, facing = band, []
                    found = [_product(x, left) for x in facing] if side else []
                    if side == 2:
                        found.append(_product(left, None))
                    if side != 1:
                        facing.append(left)
                for x in found:
                    parts.append(x)
                    size += len(x)
                    if size >= PAIRS:
                        yield from flush()
        yield from flush()

    return rows.repartition(partitions, "cell").sortWithinPartitions("cell", F.col("uid").asc_nulls_last(), "key", "side").select("cell", "uid", "sig", "key", "side", "left", "right").mapInArrow(run, "a long, b long")


def _tile_links(pairs: np.ndarray, uids: list[int], sets: list[np.ndarray], sigs: list[bytes], threshold: float, tolerance: float) -> np.ndarray:
    """The distinct pairs that outlive all their MinHash values and whose n-grams reach the threshold; exact."""
    pairs = _distinct([pairs])
    order = np.argsort(np.array(uids, np.int64))
    known = np.array(uids, np.int64)[order]
    sig = np.frombuffer(b"".join(sigs[k] for k in order), np.uint8).reshape(len(uids), -1)
    own = [sets[k] for k in order]
    a, b = (np.searchsorted(known, pairs[:, k]) for k in (0, 1))
    alive = np.concatenate([surviving(sig[a[at : at + 8192]], sig[b[at : at + 8192]], threshold, tolerance) for at in range(0, len(a), 8192)])
    pairs, a, b = pairs[alive], a[alive], b[alive]
    # n-grams as small numbers, so that those of one set can be marked and the others' marks counted.
    sizes = np.array([len(s) for s in own])
    starts = np.cumsum(sizes) - sizes
    numbers = np.unique(np.concatenate(own), return_inverse=True)[1]
    marks = np.zeros(int(numbers.max(initial=-1)) + 1, bool)
    good = np.zeros(len(pairs), bool)
    cuts = np.flatnonzero(np.diff(a)) + 1
    for some in np.split(np.arange(len(a)), cuts) if len(a) else ():
        x = a[some[0]]
        mine = numbers[starts[x] : starts[x] + sizes[x]]
        marks[mine] = True
        for k in some:
            y = b[k]
            common = int(np.count_nonzero(marks[numbers[starts[y] : starts[y] + sizes[y]]]))
            good[k] = common >= threshold * (sizes[x] + sizes[y] - common)
        marks[mine] = False
    return pairs[good]


def _verified(pairs: DataFrame, feats: DataFrame, keyed: DataFrame, n: int, threshold: float, tolerance: float) -> DataFrame:
    """(uid, other, n_links), a row for each tile in which a set has links: how many, and a set of its component within the tile. Every pair lies in one tile."""
    pairs = written(pairs, "pruned")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
    ids = written(ids, "ids")
    needed = written(feats.select("uid", "row_key", "n_shingles", "sig").join(_small(ids), "uid", "left_semi"), "needed")
    texts = keyed.select("row_key", "text").join(_small(needed.select("uid", "row_key")), "row_key").dropDuplicates(["uid"]).select("uid", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([shingles(t, n).tobytes() for t in part.column(1).to_pylist()], pa.binary())], names=["uid", "s"])

    sets = written(texts.mapInArrow(cut, "uid long, s binary"), "shingles")
    # A near group's sets have about the same least neighbour; by that, and cut by a hash where it has many, they are placed.
    ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("uid"), F.col("b").alias("other")), F.struct(F.col("b").alias("uid"), F.col("a").alias("other")))).alias("x")).select("x.*")
    led = ends.groupBy("uid").agg(F.least(F.min("other"), F.col("uid")).alias("lead")).join(needed.select("uid", "n_shingles"), "uid")
    cuts = led.groupBy("lead").agg(F.ceil(F.greatest(F.count(F.lit(1)) / TILE_SETS, F.sum("n_shingles") / TILE_SHINGLES)).alias("cuts"))
    places = written(led.join(cuts, "lead").select("uid", F.xxhash64("lead", F.pmod(F.xxhash64("uid"), F.col("cuts"))).alias("place")), "places")
    tile = F.xxhash64(F.least("place_a", "place_b"), F.greatest("place_a", "place_b")).alias("tile")
    tiled = written(pairs.join(places.toDF("a", "place_a"), "a").join(places.toDF("b", "place_b"), "b").select(tile, "a", "b"), "tiled")
    members = tiled.select("tile", F.explode(F.array("a", "b")).alias("uid")).distinct()
    rows = members.join(sets.join(needed.select("uid", "sig"), "uid"), "uid").select("tile", F.lit(None).cast("long").alias("a"), F.col("uid").alias("b"), "s", "sig")
    rows = rows.unionByName(tiled.select("tile", "a", "b", F.lit(None).cast("binary").alias("s"), F.lit(None).cast("binary").alias("sig")))

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = None
        uids: list[int] = []
        sets: list[np.ndarray] = []  # the sets of a tile come before its pairs
        sigs: list[bytes] = []
        parts: list[np.ndarray] = []

        def counted() -> Iterator[pa.RecordBatch]:
            if not parts:
                return
            links = _tile_links(np.concatenate(parts), uids, sets, sigs, threshold, tolerance)
            parts.clear()
            if not len(links):
                return
            ends, counts = np.unique(links, return_counts=True)
            parent = dict(zip(ends.tolist(), ends.tolist()))

            def root(x: int) -> int:
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for a, b in links.tolist():
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            yield pa.RecordBatch.from_arrays([pa.array(ends), pa.array([root(x) for x in ends.tolist()], pa.int64()), pa.array(counts.astype(np.int64))], names=["uid", "other", "n_links"])

        for batch in batches:
            tiles, a = batch.column(0).to_numpy(), batch.column(1)
            bounds = [0, *(np.flatnonzero(tiles[1:] != tiles[:-1]) + 1).tolist(), len(tiles)]
            for begin, end in zip(bounds, bounds[1:]):
                if begin == end:
                    continue
                if tiles[begin] != tile:
                    yield from counted()
                    tile, uids, sets, sigs = tiles[begin], [], [], []
                part = batch.slice(begin, end - begin)
                named = part.column(1).null_count
                for uid, s, sig in zip(*(part.slice(0, named).column(k).to_pylist() for k in (2, 3, 4))):
                    uids.append(uid)
                    sets.append(np.frombuffer(s, np.uint64))
                    sigs.append(sig)
                rest = part.slice(named)
                if rest.num_rows:
                    parts.append(np.stack([rest.column(1).to_numpy(), rest.column(2).to_numpy()], axis=1))
        yield from counted()

    by_tile = rows.repartition(int(feats.sparkSession.conf.get("spark.sql.shuffle.partitions")), "tile").sortWithinPartitions("tile", F.col("a").asc_nulls_first())
    links = written(by_tile.mapInArrow(hold, "uid long, other long, n_links long"), "links")
    discard(pairs, ids, needed, sets, places, tiled)
    return links


def components(edges: DataFrame) -> DataFrame:
    """(uid, comp) of every end of the edges (a, b): comp is the least uid of its component. Alternating large-star and small-star steps, each written, until nothing changes."""

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())

    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "star")
    before = state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")).select("x.*")
        e, old = written(small.where("u <> v").distinct(), "star"), e
        discard(old)
        after = state(e)
        if after == before:
            break
        before = after
    both = e.select(F.col("u").alias("uid"), F.col("v").alias("comp")).unionByName(e.select(F.col("v").alias("uid"), F.col("v").alias("comp")).distinct())
    return kept_at(both, e._written_path)


def ngram_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = NGRAM,
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """One row per input row: doc_id, class_id, class_size, set_id, n_links, kept, row_key.

    ``class_id`` is the smallest doc_id of the row's class (null ids sort last), ``class_size`` its number of rows; exactly one row of each class, the one with that
    id, has ``kept``. ``set_id`` is the smallest doc_id with the same set of n-grams, ``n_links`` the number of verified links of the row's set to other sets,
    of all that share a band with it. ``row_key`` is ``rows.row_key`` of the row.
    A null text is the empty text; texts without words form one class. A text of fewer than ``n`` words has all its words as its one n-gram. An empty table gives an
    empty result; other columns are ignored, whatever their names.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(F.col(id_col), F.col(text_col)).alias("row_key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # The row numbers hold from here on: every later step reads this table.
    feats = written(_featured(keyed, n, bands, band_rows).withColumn("uid", F.monotonically_increasing_id()), "minhash")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")
    sets = written(feats.groupBy("set_key").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).select("set_key", "n", "first", F.col("first.uid").alias("uid")), "sets")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = math.ceil(math.sqrt(2 * CELLS * partitions))
    blocks = _blocks(feats, sets, partitions, cells)
    links = _verified(_candidates(blocks, feats, partitions, cells, threshold, tolerance), feats.drop("bands"), keyed, n, threshold, tolerance)
    discard(blocks)
    comps = components(links.select(F.col("uid").alias("a"), F.col("other").alias("b")))
    rows = written(feats.select("doc_id", "row_key", "set_key", "uid"), "rows")
    discard(feats)
    count = links.groupBy("uid").agg(F.sum("n_links").alias("n_links"))
    bound = sets.join(comps, "uid", "left").withColumn("comp", F.coalesce("comp", "uid")).join(count, "uid", "left")
    classes = bound.groupBy("comp").agg(F.min("first").alias("head"), F.sum("n").alias("class_size"))
    known = bound.join(classes, "comp").select("set_key", "first", "n_links", "head", "class_size")
    return rows.join(known, "set_key").select(
        "doc_id",
        F.col("head.doc_id").alias("class_id"),
        "class_size",
        F.col("first.doc_id").alias("set_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        (F.col("uid") == F.col("head.uid")).alias("kept"),
        "row_key",
    )
