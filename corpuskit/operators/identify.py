"""Language of lines, and by a vote of their bytes of a document. An identification is a struct (label, prob), null where a line isn't identified."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from corpuskit.functions.lines import let, lines, without_nul
from corpuskit.schema import IDENTIFICATION

IDENTIFIED = "struct<label:string,prob:float>"
#: Function words that only one of these languages has.
LEXICON: Mapping[str, Sequence[str]] = {
    "de": ("der", "die", "und", "nicht", "mit", "ist", "das", "auf", "sich", "für"),
    "en": ("the", "and", "of", "to", "with", "that", "was", "for", "this", "is"),
    "es": ("el", "los", "las", "por", "con", "para", "una", "del", "como", "y"),
    "fr": ("les", "des", "une", "est", "dans", "pour", "qui", "avec", "sur", "pas"),
}


class LineIdentifier(Protocol):
    """A model: from an array of lines to an array of identifications, as a Column."""

    def identify(self, rows: Column) -> Column: ...


class LexiconIdentifier:
    """The language with most function words on a line, its share of all of them the probability. A pure Column expression; it stands in where there is no trained model."""

    def __init__(self, lexicon: Mapping[str, Sequence[str]] = LEXICON, threshold: float = 0.8) -> None:
        self.lexicon, self.threshold = {k: list(lexicon[k]) for k in sorted(lexicon)}, threshold

    def _line(self, line: Column) -> Column:
        labels = F.array(*[F.lit(k) for k in self.lexicon])

        def count(words: Column, own: list[str]) -> Column:
            return F.size(F.filter(words, lambda w: w.isin(*own)))

        def named(counts: Column) -> Column:
            share = F.array_max(counts) / F.aggregate(counts, F.lit(0), lambda s, x: s + x)
            at = F.array_position(counts, F.array_max(counts)).cast("int")
            return F.when((F.array_max(counts) > 0) & (share >= self.threshold), F.struct(F.element_at(labels, at).alias("label"), share.cast("float").alias("prob")))

        words = F.split(F.regexp_replace(F.lower(without_nul(line)), r"[^\p{L}]+", " "), " ")
        return let(let(words, lambda w: F.array(*[count(w, own) for own in self.lexicon.values()])), named)

    def identify(self, rows: Column) -> Column:
        return F.transform(rows, self._line)


class FastTextIdentifier:
    """A fastText model, loaded once a worker; the top label at least as probable as the threshold. Needs the ``fasttext`` package."""

    def __init__(self, path: str = "lid.176.bin", k: int = 1, threshold: float = 0.8) -> None:
        self.path, self.k, self.threshold = path, k, threshold

    @classmethod
    def build(cls, path: str | None = None, k: int | None = None, threshold: float | None = None) -> FastTextIdentifier:
        """Every value must be there."""
        missing = [n for n, v in (("path", path), ("k", k), ("threshold", threshold)) if v is None]
        if missing:
            raise ValueError(f"missing: {', '.join(missing)}")
        return cls(path, k, threshold)

    @classmethod
    def build_or_default(cls, path: str | None = None, k: int | None = None, threshold: float | None = None) -> FastTextIdentifier:
        return cls(path or "lid.208a.bin", k or 1, 0.8 if threshold is None else threshold)

    def _raw(self, top: int) -> Column:
        path, threshold = self.path, self.threshold

        @F.pandas_udf(ArrayType(ArrayType(IDENTIFICATION)))
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            import fasttext

            model = fasttext.load_model(path)
            for docs in batches:
                out = []
                for rows in docs:
                    flat = [r.replace("\x00", "").replace("\n", " ") for r in rows] if rows is not None else []
                    labels, probs = model.predict(flat, k=top, threshold=threshold) if flat else ([], [])
                    out.append([[{"label": a, "prob": float(p)} for a, p in zip(x, y)] for x, y in zip(labels, probs)])
                yield pd.Series(out, dtype=object)

        return run

    def identify(self, rows: Column) -> Column:
        return F.transform(self._raw(1)(rows), lambda x: F.get(x, F.lit(0)))

    def identify_top(self, rows: Column) -> Column:
        """The ``k`` best of each line; those whose label is no tag are left out."""
        from corpuskit.functions.tags import parsed

        good = lambda x: F.filter(F.transform(x, lambda i: F.struct(parsed(i["label"]).alias("label"), i["prob"].alias("prob"))), lambda i: i["label"].isNotNull())
        return F.transform(self._raw(self.k)(rows), good)


def tagged(ids: Column) -> Column:
    """Struct (ids, good): identifications with their labels made tags, and whether all labels could be, for one label that is no tag spoils its document."""
    from corpuskit.functions.tags import parsed

    fixed = F.transform(ids, lambda i: F.when(i.isNotNull(), F.struct(parsed(i["label"]).alias("label"), i["prob"].alias("prob"))))
    return let(fixed, lambda f: F.struct(f.alias("ids"), (~F.exists(f, lambda i: i.isNotNull() & i["label"].isNull())).alias("good")))


def line_bytes(rows: Column) -> Column:
    return F.transform(rows, lambda x: F.octet_length(without_nul(x)).cast("long"))


def bins(ids: Column, sizes: Column) -> Column:
    """Array of (label, bytes, conf): a bin for each label and one for the null label; conf is the sum of bytes times probability (1 for null) over all bytes."""
    pairs = F.zip_with(ids, sizes, lambda i, b: F.struct(i["label"].alias("label"), F.coalesce(i["prob"].cast("double"), F.lit(1.0)).alias("prob"), b.alias("bytes")))
    whole = F.aggregate(sizes, F.lit(0).cast("long"), lambda s, x: s + x)

    def every(known: Column) -> Column:
        def one(label: Column) -> Column:
            own = F.filter(known["pairs"], lambda p: p["label"].eqNullSafe(label))
            start = F.struct(F.lit(0).cast("long").alias("bytes"), F.lit(0.0).alias("weighted"))
            total = F.aggregate(own, start, lambda s, p: F.struct((s["bytes"] + p["bytes"]).alias("bytes"), (s["weighted"] + p["bytes"] * p["prob"]).alias("weighted")))
            return let(total, lambda t: F.struct(label.alias("label"), t["bytes"].alias("bytes"), F.when(known["whole"] > 0, t["weighted"] / known["whole"]).otherwise(F.lit(0.0)).alias("conf")))

        return F.transform(F.array_distinct(F.transform(known["pairs"], lambda p: p["label"])), one)

    return let(F.struct(pairs.alias("pairs"), whole.alias("whole")), every)


def vote(found: Column) -> Column:
    """The bin of most bytes; of equal ones a label before null, then the smaller label."""
    best = F.array_min(F.transform(found, lambda b: F.struct((-b["bytes"]).alias("less"), b["label"].isNull().alias("none"), b["label"].alias("label"), b["conf"].alias("conf"))))
    return F.when(best.isNotNull(), F.struct(best["label"].alias("label"), (-best["less"]).alias("bytes"), best["conf"].alias("conf")))


def document_identification(found: Column, multilingual: Column, least: float = 0.6) -> Column:
    """Identification of the document: ``multi`` at 0.5 where it is multilingual, else the vote's label with its confidence if that is ``least`` or more, else null."""
    return let(vote(found), lambda best: _named(best, multilingual, least))


def _named(best: Column, multilingual: Column, least: float) -> Column:
    return F.when(multilingual, F.struct(F.lit("multi").alias("label"), F.lit(0.5).cast("float").alias("prob"))).when(
        best["label"].isNotNull() & (best["conf"] >= least), F.struct(best["label"].alias("label"), best["conf"].cast("float").alias("prob"))
    )


def identified_lines(text: Column, identifier: LineIdentifier | None = None) -> tuple[Column, Column]:
    """(identifications, byte sizes) of a text's lines."""
    rows = lines(text)
    return (identifier or LexiconIdentifier()).identify(rows), line_bytes(rows)
