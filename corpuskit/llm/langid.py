"""Language identification by averaged hashed subword embeddings with a linear softmax.

The subwords of a text are the runs of 2 to 4 code points within its lower-cased words, a word's border counting as one more code point. Each hashes to one of
``BUCKETS`` embeddings; the mean over all subwords of the whole text goes through a linear layer and a softmax. The model is trained here by stochastic gradient
descent in numpy, on a bounded sample of labelled rows (``SAMPLE_ROWS``); every row is predicted. A part of the sample takes no part in the descent: on it,
whole and thinned out, the softmax's temperature is fitted, and the share of familiar subwords that texts in a learnt language have at least. The score is the softmax's
probability, lowered by a power of the ratio where the share of familiar subwords is less than that. A text is rejected below the score that tells these rows best from texts in
no learnt language: sampled rows whose letters are exchanged, vowels among vowels and the others among themselves, which leaves the look of a language but none of its words.

What the driver holds is the sample's features and the model, both bounded; prediction is one scan with no exchange.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.llm.rows import cuts

#: Labelled rows that a model learns from, spread evenly over the languages.
SAMPLE_ROWS = 2000
BUCKETS, DIMENSIONS, EPOCHS, RATE = 1 << 16, 16, 8, 0.5
#: One labelled row in so many calibrates instead of training.
CALIBRATION_PART = 4
#: One sampled row in so many gives a text in no language.
FOREIGN_PART = 3
#: The most different subwords of a sampled row that are learnt from, drawn at random where it has more.
SAMPLE_SUBWORDS = 1 << 13
#: Share of the rightly predicted calibration rows that may be rejected, of whole ones and of ones thinned out to as few as eight subwords, and the share of foreign texts that is enough to reject.
REJECTED_SHARE, REJECTED_THINNED, FOREIGN_SHARE = 0.002, 0.05, 0.995
#: The most that the rejecting score can be: under a half, so that a text in two learnt languages stays.
MOST_REJECTING = 0.48
#: The power of the ratio by which the score is lowered where familiar subwords are fewer than they should be.
UNFAMILIAR = 3
_VOWELS = frozenset("aeiouyàáâãäåæèéêëìíîïòóôõöøœùúûüýÿ")
#: Languages whose shares may be broadcast; more are joined by a shuffle.
BROADCAST_LANGUAGES = 1 << 14
#: Code points worked on at once.
AT_ONCE = 1 << 18
UNKNOWN = "und"
_ORDERS = (2, 3, 4)
_A = tuple(np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F))


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Of each code point: 2 a letter, 1 a mark, 0 anything else."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        out[c] = 2 if kind == "L" else kind == "M"
    return out


def _codes(text: str) -> tuple[np.ndarray, bool]:
    """Code points of the lower-cased text, 0 outside of words, with a border at either end; and whether it has a letter."""
    x = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kinds()[x]
    return np.where(kinds > 0, x, np.uint32(0)), bool((kinds == 2).any())


def _buckets(x: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """Bucket of the subword of ``n`` code points at each position; ``buckets`` where there is none."""
    size = len(x) - n + 1
    if size <= 0:
        return np.zeros(0, np.int32)
    h = np.full(size, np.uint32(n * 0x51ED27 & 0xFFFFFFFF), np.uint32)
    for k in range(n):
        h += x[k : k + size] * _A[k]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    if n == 2:
        valid = (x[:size] | x[1:]) > 0
    else:
        valid = x[1 : 1 + size] > 0
        for k in range(2, n - 1):
            valid &= x[k : k + size] > 0
    return np.where(valid, h & np.uint32(buckets - 1), np.uint32(buckets)).astype(np.int32)


def _pieces(x: np.ndarray, step: int) -> Iterator[tuple[np.ndarray, int]]:
    """Stretches of a text, each with the number of positions at which its subwords begin."""
    for at in range(0, len(x), step):
        yield x[at : at + step + max(_ORDERS) - 1], min(step, len(x) - at)


def features(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's subwords, ascending, and how often each occurs."""
    x, _ = _codes(text)
    counts = np.zeros(buckets + 1, np.int64)
    for piece, starts in _pieces(x, AT_ONCE):
        for n in _ORDERS:
            counts += np.bincount(_buckets(piece, n, buckets)[:starts], minlength=buckets + 1)
    found = np.flatnonzero(counts[:-1])
    return found.astype(np.int32), counts[found].astype(np.int32)


def foreign(text: str) -> str:
    """The lower-cased text with its letters exchanged, in one of many ways that the text itself decides."""
    text = text.lower()
    rng = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    letters = sorted(c for c in set(text) if c.isalpha())
    table: dict[int, str] = {}
    for own in ([c for c in letters if c in _VOWELS], [c for c in letters if c not in _VOWELS]):
        table |= {ord(a): own[k] for a, k in zip(own, rng.permutation(len(own)))}
    return text.translate(table)


@dataclass
class Model:
    languages: list[str]
    #: (buckets + 1) rows; the last is 0. Logits of each language if ``weights`` is None, else embeddings; then 1 if the bucket was seen in training.
    table: np.ndarray
    weights: np.ndarray | None
    bias: np.ndarray
    temperature: float
    familiar: float
    rejecting: float
    #: On the calibration rows, the mean difference between probability and truth over ten classes of probability.
    unreliable: float = 0.0

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text the logits, the share of familiar subwords, and whether it has a letter."""
        total = np.zeros((len(texts), self.table.shape[1]))
        count = np.zeros(len(texts))
        lettered = np.zeros(len(texts), bool)
        step = max(1 << 12, AT_ONCE * 4 // self.table.shape[1])
        held: list[tuple[int, np.ndarray]] = []
        size = 0
        for k, text in enumerate(texts):
            x, lettered[k] = _codes(text)
            if len(x) > step:
                for piece, starts in _pieces(x, step):
                    self._add([(k, piece)], starts, total, count)
                continue
            held.append((k, x))
            size += len(x)
            if size > step:
                self._add(held, None, total, count)
                held, size = [], 0
        self._add(held, None, total, count)
        mean = total / np.maximum(count, 1)[:, None]
        z, share = mean[:, :-1], mean[:, -1]
        return (z if self.weights is None else z @ self.weights) + self.bias, share, lettered

    def _add(self, held: list[tuple[int, np.ndarray]], starts: int | None, total: np.ndarray, count: np.ndarray) -> None:
        if not held:
            return
        # Texts end and begin with a border, so what spans two of them is no subword, save a pair with one border, which can't span them either.
        x = np.concatenate([x for _, x in held])
        rows = np.array([k for k, _ in held])
        begins = np.cumsum([0] + [len(x) for _, x in held[:-1]])
        buckets = len(self.table) - 1
        for n in _ORDERS:
            b = _buckets(x, n, buckets)
            if starts is not None:
                b = b[:starts]
            b = np.concatenate([b, np.full(len(x) - len(b), buckets, np.int32)]) if starts is None else b
            if len(b):
                total[rows] += np.add.reduceat(self.table[b], begins, axis=0)
                count[rows] += np.add.reduceat((b < buckets).astype(np.int64), begins)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Of each text the language, the score, and whether it is accepted."""
        if not self.languages:
            return [(UNKNOWN, 0.0, False)] * len(texts)
        z, share, lettered = self.logits([t or "" for t in texts])
        p = _softmax(z / self.temperature) * np.minimum(1, share / self.familiar)[:, None] ** UNFAMILIAR
        best = z.argmax(axis=1)
        out = []
        for k in range(len(texts)):
            if lettered[k]:
                score = round(float(p[k, best[k]]), 6)
                out.append((self.languages[best[k]], score, score >= self.rejecting))
            else:
                out.append((UNKNOWN, 0.0, False))
        return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], buckets: int = BUCKETS, seed: int = 7, strangers: Sequence[tuple[np.ndarray, np.ndarray]] = ()) -> Model:
    """A model of (language, buckets, counts) rows; ``strangers`` are (buckets, counts) of texts in no learnt language. Without rows it knows no language and rejects every text."""
    languages = sorted({lang for lang, _, _ in rows})
    wide = len(languages)
    if not wide:
        return Model([], np.zeros((buckets + 1, 1), np.float32), None, np.zeros(1), 1.0, 1.0, 1.0)
    rng = np.random.default_rng(seed)
    number = {lang: k for k, lang in enumerate(languages)}
    data = [(number[lang], b, c) for lang, b, c in rows if len(b)]
    held, own = data[::CALIBRATION_PART], [d for k, d in enumerate(data) if k % CALIBRATION_PART]
    if not own:
        own = held
    e = rng.uniform(-1, 1, (buckets, DIMENSIONS)) / DIMENSIONS
    w, bias = np.zeros((DIMENSIONS, wide)), np.zeros(wide)
    seen = np.zeros(buckets, bool)
    steps, done = EPOCHS * len(own), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(own)):
            y, b, c = own[k]
            rate = RATE * (1 - done / steps)
            done += 1
            if done % 2 and len(b) > 8:  # every other step sees only some of the subwords, as a short text would have
                some = rng.choice(len(b), int(8 * (len(b) / 8) ** rng.random()), replace=False)
                b, c = b[some], c[some]
            weight = c / c.sum()
            mean = weight @ e[b]
            g = _softmax(mean @ w + bias)
            g[y] -= 1
            back = w @ g
            w -= rate * np.outer(mean, g)
            bias -= 0.1 * rate * g
            # A text's gradient is spread over its subwords; the step is widened so that each embedding moves.
            e[b] -= rate * np.outer(weight * np.sqrt(len(b)), back)
            seen[b] = True
    e[~seen] = 0  # what was never seen says nothing
    padded = np.vstack([e, np.zeros((1, DIMENSIONS))])
    known = np.append(seen, False)
    table, weights = (padded @ w, None) if wide <= DIMENSIONS else (padded, w)
    model = Model(languages, np.column_stack([table, known]).astype(np.float32), weights, bias, 1.0, 1.0, 0.0)
    if held:
        thinned = []
        for y, b, c in held:
            some = rng.choice(len(b), max(1, int(min(8, len(b)) * (len(b) / min(8, len(b))) ** rng.random())), replace=False)
            thinned.append((y, b[some], c[some]))
        both = held + thinned
        truth = np.array([y for y, _, _ in both])
        z = np.array([(c / c.sum()) @ (padded[b] @ w) + bias for _, b, c in both])
        share = np.array([c @ known[b] / c.sum() for _, b, c in both])
        # Targets short of certainty, as the rows are finite: else the temperature would go to 0 where every row is right.
        target = np.full((len(both), wide), 1 / (len(both) + wide))
        target[np.arange(len(both)), truth] = 1 - (wide - 1) / (len(both) + wide)
        grid = np.exp(np.linspace(np.log(0.02), np.log(5), 60))
        loss = [-(target * np.log(np.maximum(_softmax(z / t), 1e-300))).sum(axis=1).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        right = z.argmax(axis=1) == truth
        model.familiar = max(_lowest(share[right]), 1e-6)
        p = _softmax(z / model.temperature).max(axis=1)
        model.unreliable = _unreliability(p, right)
        score = p * np.minimum(1, share / model.familiar) ** UNFAMILIAR
        whole = np.arange(len(both)) < len(held)
        model.rejecting = min(MOST_REJECTING, _lowest(score[right & whole]), _lowest(score[right & ~whole], REJECTED_THINNED))
        if strangers := [(b, c) for b, c in strangers if len(b)]:
            z = np.array([(c / c.sum()) @ (padded[b] @ w) + bias for b, c in strangers])
            other = _softmax(z / model.temperature).max(axis=1) * np.minimum(1, np.array([c @ known[b] / c.sum() for b, c in strangers]) / model.familiar) ** UNFAMILIAR
            model.rejecting = min(model.rejecting, float(np.quantile(other, FOREIGN_SHARE)))
    return model


def _unreliability(p: np.ndarray, right: np.ndarray) -> float:
    """The mean difference between probability and share of right ones over ten classes of probability, by their sizes."""
    at = np.minimum((p * 10).astype(int), 9)
    return float(sum(abs(p[at == k].mean() - right[at == k].mean()) * (at == k).mean() for k in np.unique(at)))


def _lowest(values: np.ndarray, part: float = REJECTED_SHARE) -> float:
    """The value that ``part`` of them fall short of; a tenth under the least where they are too few to tell."""
    at = int(part * (len(values) + 1))
    return float(np.sort(values)[at - 1]) if at else 0.9 * float(values.min()) if len(values) else 0.0


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from; a null id is not held out, nor learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS) -> Model:
    """Train on at most ``sample_rows`` of the rows that have a language, a text and an id that isn't held out; the sample is spread evenly over the languages and chosen by a hash of id and text, rows that repeat both counting once.

    The driver gets the sample's features, at most SAMPLE_SUBWORDS of a row, and one row for each language.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and doc_id is not null and text is not null").where(~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return train([], buckets)
    each = max(1, sample_rows // len(counts))
    parts = spark.createDataFrame([(lang, int(min(1.0, 1.5 * (each + 4) / n) * (1 << 30))) for lang, n in counts.items()], "lang string, part long")

    def thinned(b: np.ndarray, c: np.ndarray, h: int) -> tuple[bytes, bytes]:
        if len(b) > SAMPLE_SUBWORDS:
            some = np.sort(np.random.default_rng(h).choice(len(b), SAMPLE_SUBWORDS, replace=False))
            b, c = b[some], c[some]
        return b.tobytes(), c.tobytes()

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [thinned(*features(t, buckets), h) for t, h in zip(batch["text"], batch["h"])]
            other = [thinned(*features(foreign(t), buckets), h) if h % FOREIGN_PART == 0 else (b"", b"") for t, h in zip(batch["text"], batch["h"])]
            yield pd.DataFrame({"lang": batch["lang"], "h": batch["h"], "b": [b for b, _ in own], "c": [c for _, c in own], "fb": [b for b, _ in other], "fc": [c for _, c in other]})

    keyed = rows.withColumn("h", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)))
    few = keyed.join(F.broadcast(parts) if len(counts) <= BROADCAST_LANGUAGES else parts, "lang").where(F.col("h") < F.col("part")).dropDuplicates(["lang", "h"])
    sample = few.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("r") <= each).select("lang", "h", "text")
    kept = sample.mapInPandas(found, "lang string, h long, b binary, c binary, fb binary, fc binary").collect()
    chosen = sorted((r["h"], r["lang"], bytes(r["b"]), bytes(r["c"]), bytes(r["fb"]), bytes(r["fc"])) for r in kept)
    of = lambda b, c: (np.frombuffer(b, np.int32), np.frombuffer(c, np.int32))
    return train([(lang, *of(b, c)) for _, lang, b, c, _, _ in chosen], buckets, strangers=[of(b, c) for *_, b, c in chosen if b])


def predict(model: Model, text: Column, spark) -> Column:
    """Column of structs (lang_pred, score, accepted); the model is broadcast, its size bounded by its buckets."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            parts = [own.predict(list(texts.iloc[a:b])) for a, b in cuts([len(t) if t else 0 for t in texts])]
            yield pd.DataFrame([r for part in parts for r in part], columns=["lang_pred", "score", "accepted"])

    return run(text)


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, accepted.

    A null text, or one without a letter, is ``und`` with score 0 and isn't accepted. Where no row is labelled every text is. Equal texts get equal predictions; a very long text is averaged in stretches, whole;
    neither id, source nor label takes part in them. An empty table gives an empty result; other columns are ignored, whatever their names.
    """
    model = model or fit(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(model, F.col("text"), docs.sparkSession).alias("p")).select("doc_id", "held_out", "p.*")


def accepted(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, with their columns, whose text is accepted."""
    model = model or fit(docs, id_col, text_col, lang_col)
    whole = docs.select(F.struct("*").alias("row"), predict(model, F.col(text_col), docs.sparkSession).alias("p"))
    return whole.where("p.accepted").select("row.*")
