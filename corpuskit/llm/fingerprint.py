"""Similarity digests from improbable features.

Every window of 64 bytes of a text has an entropy. A window's rank says how rare its entropy is: the lowest rank goes to middling entropies, the highest to the ones that
any prose is full of or that carry nothing. In each run of 64 successive windows the leftmost of lowest rank gains a point; windows with at least 16 points are the text's
features. Their hashes fill a chain of Bloom filters, of 2048 bits and at most 160 features each. Two digests are compared filter by filter: the overlap of bits over what chance
gives, normalised by what was possible, the best partner of each filter of the shorter digest, and the mean of those.

A text without a feature (any of under 142 bytes, and one of only windows that carry nothing) has instead all its runs of GRAM bytes, with its ends marked, as features. Where one of two
texts is such a one, both are compared by these.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.rows import documents, slices
from corpuskit.storage import written

WINDOW, RUN, POINTS = 64, 64, 16
#: Bytes of the features of texts that have no other.
GRAM = 6
BITS, PER_FILTER, HASHES = 2048, 160, 5
#: Bytes of texts that are worked on at once.
AT_ONCE = 1 << 18

#: Entropy counts in whole steps, so that a window's value doesn't depend on what was summed before it: step k of c*log2(c).
_SCALE = 1 << 20
_CLOGC = np.array([0] + [round(c * math.log2(c) * _SCALE) for c in range(1, WINDOW + 1)], np.int64)
_STEP = np.diff(_CLOGC)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB, 0xBF58476D1CE4E5B9], np.uint64)


def _ranks() -> np.ndarray:
    """Rank by entropy in 1/1000 of its range. Prose crowds between 0.55 and 0.72; the further from it, the rarer, but windows of hardly any entropy carry nothing and never are features."""
    x = np.arange(1001) / 1000
    rank = 1 + np.round(900 * np.exp(-(((x - 0.635) / 0.085) ** 2))).astype(np.int64)
    rank[x < 0.1] = 1000
    return rank


_RANK = _ranks()


def window_entropy(data: np.ndarray) -> np.ndarray:
    """Entropy, in thousandths of the largest, of each window of WINDOW bytes of ``data``."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    # Number of the same byte among the WINDOW-1 positions before, and after, each position: positions sorted by byte, each held against those close before it.
    order = np.argsort(data, kind="stable")
    small = np.int32 if 256 * (n + WINDOW) < 1 << 31 else np.int64
    key = data[order].astype(small) * small(n + WINDOW) + order.astype(small)
    earlier, later = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WINDOW):
        near = key[d:] - key[:-d] < WINDOW
        if not near.any():
            break
        earlier[d:] += near
        later[:-d] += near
    before, after = np.empty(n, np.uint8), np.empty(n, np.uint8)
    before[order] = earlier
    after[order] = later
    # sum of c*log2(c) of the first window, then what each step adds and takes away
    total = np.empty(n - WINDOW + 1, np.int64)
    total[0] = _CLOGC[np.bincount(data[:WINDOW], minlength=256)].sum()
    np.cumsum(_STEP[before[WINDOW:]] - _STEP[after[: n - WINDOW]], out=total[1:])
    total[1:] += total[0]
    most = WINDOW * int(math.log2(WINDOW)) * _SCALE
    return (most - total) * 1000 // most


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the features in ``data``, ascending, and the number of the text each lies in. Texts are the stretches from ``starts`` to ``ends``; no window or run crosses a border."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Entropy steps by differences of neighbouring windows, so windows across borders are computed too, and then left out.
    rank = _RANK[window_entropy(data)]
    windows = len(rank)
    last = np.maximum(starts, ends - WINDOW + 1)
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, last, -1)
    inside = np.cumsum(edge[:-1])[:windows] > 0
    small, shift = (np.int32, 20) if windows < 1 << 20 else (np.int64, 40)
    rank = np.where(inside, rank, 1023).astype(small)
    least = (rank << small(shift)) + np.arange(windows, dtype=small)
    width = 1
    while width < RUN:  # minima over runs, by doubling
        step = min(width, RUN - width)
        least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
        width += step
    if not len(least):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A run counts where it begins and ends in the same text.
    run_edge = np.zeros(n + 1, np.int32)
    np.add.at(run_edge, starts, 1)
    np.add.at(run_edge, np.maximum(starts, ends - WINDOW - RUN + 2), -1)
    runs = np.cumsum(run_edge[:-1])[: len(least)] > 0
    winner = least[runs] & small((1 << shift) - 1)
    points = np.bincount(winner, minlength=windows)
    at = np.flatnonzero((points >= POINTS) & (rank < 1000))
    return at, np.searchsorted(starts, at, side="right") - 1


def _hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows that begin at ``at``."""
    lanes = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[at].view("<u8") if len(at) else np.zeros((0, WINDOW // 8), np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(len(at), np.uint64)
        for k in range(WINDOW // 8):
            h ^= lanes[:, k] * _MIX[k]
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
    return h


class Digest(NamedTuple):
    #: Rows of 256 bytes, and the number of features in each.
    filters: np.ndarray
    features: np.ndarray
    #: Whether the features are grams, as the text has no other.
    grams: bool
    raw: bytes


def _grams(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of GRAM bytes of texts, each text with marks before and behind it, and the number of the text each lies in. An empty text has none."""
    hashes, numbers = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    mark = np.full(GRAM - 1, 256, np.uint64)
    for k, raw in enumerate(raws):
        if raw:
            x = np.concatenate([mark, np.frombuffer(raw, np.uint8).astype(np.uint64), mark])
            h = np.zeros(len(x) - GRAM + 1, np.uint64)
            with np.errstate(over="ignore"):
                for j in range(GRAM):
                    h = h * np.uint64(257) + x[j : j + len(h)]
                for _ in range(2):
                    h = (h ^ (h >> np.uint64(29))) * _MIX[0]
                    h ^= h >> np.uint64(32)
            hashes.append(h)
            numbers.append(np.full(len(h), k))
    return np.concatenate(hashes), np.concatenate(numbers)


def _filled(h: np.ndarray, numbers: np.ndarray, count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Filters, and the number of features in each, of ``count`` texts, of hashes in the order of texts and of places in them."""
    # Equal features of a text count once, where they come first.
    if len(h):
        order = np.lexsort((np.arange(len(h)), h, numbers))
        first = np.ones(len(h), bool)
        first[1:] = (h[order][1:] != h[order][:-1]) | (numbers[order][1:] != numbers[order][:-1])
        keep = np.sort(order[first])
        h, numbers = h[keep], numbers[keep]
    cuts = np.searchsorted(numbers, np.arange(count + 1))
    within = np.arange(len(h)) - cuts[numbers]
    filters_of = -(-np.diff(cuts) // PER_FILTER)
    base = np.cumsum(filters_of) - filters_of
    row = base[numbers] + within // PER_FILTER
    total = int(filters_of.sum())
    bits = np.zeros((total, BITS), bool)
    for k in range(HASHES):
        bits[row, ((h >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1)
    features = np.bincount(row, minlength=total) if total else np.zeros(0, np.int64)
    return [(packed[a : a + m], features[a : a + m]) for a, m in zip(base, filters_of)]


def gram_digest(raw: bytes) -> Digest:
    """By runs of GRAM bytes, whatever other features the text has."""
    return Digest(*_filled(*_grams([raw]), 1)[0], True, raw)


def digests(raws: list[bytes]) -> list[Digest]:
    """Of each text its filters and the number of features in each."""
    sizes = np.array([len(r) for r in raws], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    data = np.frombuffer(b"".join(raws), np.uint8)
    full = sizes > 0
    at, text = _features(data, starts[full], ends[full])
    found = _filled(_hashes(data, at), np.flatnonzero(full)[text] if len(text) else text, len(raws))
    without = [k for k, (f, _) in enumerate(found) if not len(f)]
    grams = dict(zip(without, _filled(*_grams([raws[k] for k in without]), len(without))))
    return [Digest(*grams.get(k, own), k in grams, raws[k]) for k, own in enumerate(found)]


_ONES = np.array([bin(x).count("1") for x in range(256)], np.uint8)


def likeness(a: Digest, b: Digest) -> float:
    """0 to 1; of texts of which one has only grams, by the grams of both. Of two empty texts 1, of an empty and another text 0."""
    if a.grams != b.grams:
        a, b = (x if x.grams else gram_digest(x.raw) for x in (a, b))
    (fa, na), (fb, nb) = a[:2], b[:2]
    if not len(fa) or not len(fb):
        return float(len(fa) == len(fb))
    if a.grams and a.raw == b.raw:
        return 1.0
    if len(fa) > len(fb) or (len(fa) == len(fb) and na.sum() > nb.sum()):
        (fa, na), (fb, nb) = (fb, nb), (fa, na)
    # A filter of few features next to fuller ones says little; it counts by its number of features.
    ones_a, ones_b = _ONES[fa].sum(1, dtype=np.int64), _ONES[fb].sum(1, dtype=np.int64)
    total = weight = 0.0
    for k in range(len(fa)):
        common = _ONES[fa[k] & fb].sum(1, dtype=np.int64)
        possible = np.minimum(ones_a[k], ones_b)
        chance = ones_a[k] * ones_b / BITS
        cut = chance + 0.1 * (possible - chance)
        score = np.where(possible > cut, (common - cut) / np.maximum(possible - cut, 1e-9), common == possible)
        total += float(na[k]) * float(np.clip(score, 0, 1).max())
        weight += float(na[k])
    return total / weight


def listed(d: Digest) -> str:
    """Features of each filter and the filters, in hexadecimal."""
    return ",".join(f"{n:02x}:{f.tobytes().hex()}" for f, n in zip(d.filters, d.features))


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as many characters of the following text, or by all it has."""
    n = len(text) // 2
    return text[: len(text) - n] + following[:n]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_COLUMNS = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _rows(ids: list[int | None], texts: list[str], following: list[str]) -> list[list]:
    """Columns of the result for texts, each with the text that follows it."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    other = [edited(t, f).encode("utf-8", "surrogatepass") for t, f in zip(texts, following)]
    chain = all(f is t for f, t in zip(following, texts[1:]))
    tail = [following[-1]] if chain else following
    found = digests(raws + other + [t.encode("utf-8", "surrogatepass") for t in tail])
    n = len(texts)
    own, changed = found[:n], found[n : 2 * n]
    after = own[1:] + found[2 * n :] if chain else found[2 * n :]
    return [
        ids,
        [len(t) for t in texts],
        [hashlib.sha256(o).hexdigest() for o in other],
        [listed(d) for d in own],
        [listed(d) for d in changed],
        [likeness(a, b) for a, b in zip(own, changed)],
        [likeness(a, b) for a, b in zip(own, after)],
    ]


def _run(ids: list[int | None], texts: list[str], following: list[str]) -> Iterator[pa.RecordBatch]:
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < AT_ONCE):
            size, end = size + len(texts[end]), end + 1
        columns = _rows(ids[at:end], texts[at:end], following[at:end])
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _COLUMNS)], schema=_COLUMNS)
        at = end


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next greater ``doc_id``, ties by a hash of the text and then the text, null ids first; the last one's is the first. A single document follows itself. A null text is
    the empty text. A text without a feature has the fingerprint of its grams, the empty text an empty one. An empty table gives an empty result; other
    columns are ignored. Equal texts have equal fingerprints.

    Texts are moved once, into ranges of ``doc_id``; each task walks its range in order. The last document of a range needs the first of the next one: these
    two of each range, and no others, are set aside and joined afterwards.
    """
    rows = documents(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Ranges are cut by the id and a hash of the text, so that the sample that the driver cuts them by holds no texts.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order, F.col("text").asc())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*_COLUMNS, ("first", pa.string()), ("last", pa.string())])

        def wide(b: pa.RecordBatch) -> pa.RecordBatch:
            none = pa.nulls(b.num_rows, pa.string())
            return pa.RecordBatch.from_arrays([*b.columns, none, none], schema=schema)

        def edge(doc_id: int | None, first: str | None, last: str | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), *[pa.nulls(1, f.type) for f in list(schema)[1:-2]], pa.array([first], pa.string()), pa.array([last], pa.string())], schema=schema)

        held: tuple[int | None, str] | None = None
        for batch in batches:
            for part in slices(batch, 1):
                ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                if held is None:
                    yield edge(ids[0], texts[0], None)
                else:
                    ids, texts = [held[0], *ids], [held[1], *texts]
                held = (ids[-1], texts[-1])
                for b in _run(ids[:-1], texts[:-1], texts[1:]):
                    yield wide(b)
        if held:
            yield edge(held[0], None, held[1])

    walked = written(ranged.mapInArrow(walk, SCHEMA + ", first string, last string").withColumn("range", F.spark_partition_id()), "fingerprints")
    edges = walked.where("first is not null or last is not null")
    # Two rows for each range, whatever the size of the table.
    firsts = edges.where("first is not null").select("range", F.col("first").alias("following"))
    lasts = edges.where("last is not null").select("range", "doc_id", F.col("last").alias("text"))
    numbers = [r.range for r in firsts.select("range").orderBy("range").collect()]
    if not numbers:
        return walked.select(*[f.name for f in _COLUMNS])
    after = dict(zip(numbers, numbers[1:] + numbers[:1]))
    pairs = docs.sparkSession.createDataFrame(list(after.items()), "range int, next int")
    ends = lasts.join(pairs, "range").join(firsts.withColumnRenamed("range", "next"), "next").select("doc_id", "text", "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from _run(*(c.to_pylist() for c in b.columns))

    inner = walked.where("n_chars is not null").select(*[f.name for f in _COLUMNS])
    return inner.unionByName(ends.mapInArrow(finish, SCHEMA))
