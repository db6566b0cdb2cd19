"""Which documents are in several languages, from the identifications of their lines. All are predicates on one row's arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskit.functions.lines import let


def _labels(ids: Column) -> Column:
    return F.transform(ids, lambda i: i["label"])


def _count(labels: Column, label: Column) -> Column:
    return F.size(F.filter(labels, lambda x: x.eqNullSafe(label)))


def _gates(ids: Column, least: int, confident: float, share: float, most_langs: int | None) -> Column:
    langs = F.size(F.array_compact(F.array_distinct(_labels(ids))))
    sure = F.size(F.filter(ids, lambda i: F.coalesce(i["prob"] >= F.lit(confident).cast("float"), F.lit(False))))
    return (F.size(ids) >= least) & (sure / F.size(ids) > share) & (langs >= 2) & (langs <= most_langs if most_langs is not None else F.lit(True))


def strict_lines(ids: Column, least: int = 10, confident: float = 0.8, share: float = 0.8, most_langs: int | None = 5) -> Column:
    """Enough lines, enough of them confident, 2 to ``most_langs`` languages, each on at least its even part of the lines, and no more than that unidentified. Null lines are one more part, if there are any."""

    def fair(labels: Column) -> Column:
        kinds = F.array_distinct(labels)
        even = F.floor(F.size(labels) / F.size(kinds))
        return F.forall(kinds, lambda k: F.when(k.isNull(), _count(labels, k) <= even).otherwise(_count(labels, k) >= even))

    return F.coalesce(_gates(ids, least, confident, share, most_langs) & let(_labels(ids), fair), F.lit(False))


def strict_bytes(ids: Column, sizes: Column, least: int = 10, confident: float = 0.8, share: float = 0.8, most_langs: int | None = 5) -> Column:
    """As ``strict_lines``, with even parts of the bytes; unidentified lines are always one of the parts."""
    zero = F.lit(0).cast("long")

    def fair(pairs: Column) -> Column:
        langs = F.array_compact(F.array_distinct(F.transform(pairs, lambda p: p["label"])))
        even = F.floor(F.aggregate(pairs, zero, lambda s, p: s + p["bytes"]) / (F.size(langs) + 1))
        held = lambda k: F.aggregate(F.filter(pairs, lambda p: p["label"].eqNullSafe(k)), zero, lambda s, p: s + p["bytes"])
        return F.forall(langs, lambda k: held(k) >= even) & (held(F.lit(None).cast("string")) <= even)

    both = F.zip_with(ids, sizes, lambda i, b: F.struct(i["label"].alias("label"), b.alias("bytes")))
    return F.coalesce(_gates(ids, least, confident, share, most_langs) & let(both, fair), F.lit(False))


def ratio(ids: Column, least: int = 10, limit: int = 2, q: float = 4.0) -> Column:
    """Enough lines, two languages, no more lines unidentified than in the first language, and of the ``limit`` first languages each on more than a ``q``-th of the lines of the one before it."""

    def falling(labels: Column) -> Column:
        langs = F.array_compact(F.array_distinct(labels))
        none = _count(labels, F.lit(None).cast("string"))

        def even(counts: Column) -> Column:
            falls = F.zip_with(F.slice(counts, 2, limit), counts, lambda after, before: F.when(after.isNull(), True).otherwise(after > before / F.lit(q)))
            return (F.size(langs) >= 2) & (none <= F.element_at(counts, 1)) & F.forall(falls, lambda x: x)

        counts = F.reverse(F.array_sort(F.transform(langs, lambda k: _count(labels, k))))
        return F.when(F.size(langs) >= 2, let(F.slice(counts, 1, limit), even)).otherwise(False)

    return F.coalesce((F.size(ids) >= least) & let(_labels(ids), falling), F.lit(False))
