"""Transforms that take lines off a document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskit.functions.lines import between, kept_range, let, lines
from corpuskit.operators.filters import Length


def trim_short(text: Column, least: int = 100) -> tuple[Column, Column]:
    """(content, range): short lines at both ends go. Without a long line the content is empty and the range null."""
    rows = lines(text)
    bounds = kept_range(rows, Length(least))
    return between(rows, bounds), bounds


def trimmed(text: Column, least: int = 100) -> Column:
    """The same as one struct (content, kept), whose parts are evaluated once."""
    return let(lines(text), lambda rows: let(kept_range(rows, Length(least)), lambda bounds: F.struct(between(rows, bounds).alias("content"), bounds.alias("kept"))))


def trim_by_mean(text: Column, size: int = 5, least: int = 100) -> tuple[Column, Column]:
    """(content, range): lines at both ends go while the mean of ``size`` byte lengths around them is under ``least``; beyond the ends, the first and the last length count on.

    Where no line reaches it, or there is no line, the content stays whole and the range is null. For an even size the window reaches one line less far ahead.
    """
    half = size // 2

    def bounds_of(lengths: Column) -> Column:
        n = F.size(lengths)

        def mean(i: Column) -> Column:
            around = [F.element_at(lengths, F.greatest(F.lit(1), F.least(n, i + (k - half + 1)))) for k in range(size)]
            return sum(around[1:], around[0]) / size

        at = F.filter(F.transform(lengths, lambda x, i: F.when(mean(i) >= least, i)), lambda i: i.isNotNull())
        return let(at, lambda a: F.when(F.size(a) > 0, F.struct(F.array_min(a).cast("long").alias("start"), F.array_max(a).cast("long").alias("end"))))

    rows = lines(text)
    bounds = let(F.transform(rows, lambda x: F.octet_length(x)), bounds_of)
    return F.when(bounds.isNull(), text).otherwise(between(rows, bounds)), bounds


def with_content_length(headers: Column, content: Column) -> Column:
    """The headers with the content's length in bytes."""
    others = F.map_filter(headers, lambda k, v: k != "content-length")
    return F.map_concat(others, F.create_map(F.lit("content-length"), F.octet_length(content).cast("string")))
