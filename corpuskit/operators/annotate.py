"""Annotators: each gives a warning or null; a chain gives the list of its warnings, in its order, or null if there are none."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.functions.lines import let, lines

#: Rows of a blocklist that may be broadcast; a longer one is joined by a shuffle.
BROADCAST_ROWS = 1 << 18


def tiny(text: Column, least: int = 5, rows: Column | None = None) -> list[Column]:
    """Fewer lines than ``least``. ``rows`` is the text's array of lines, where it is at hand."""
    return [F.when(F.size(lines(text) if rows is None else rows) < least, "tiny")]


def short_sentences(text: Column, length: int = 100, share: float = 0.5, rows: Column | None = None) -> list[Column]:
    """More lines of at most ``length`` code points than the whole part of ``share`` of them."""
    rows = lines(text) if rows is None else rows
    return [F.when(F.size(F.filter(rows, lambda x: F.length(x) <= length)) > F.floor(F.size(rows) * F.lit(share)), "short_sentences")]


def header_footer(text: Column, part: float = 0.2, share: float = 0.5, length: int = 100, rows: Column | None = None) -> list[Column]:
    """``header`` where more than ``share`` of the first ``part`` of lines are shorter than ``length`` bytes, ``footer`` for the last."""
    rows = lines(text) if rows is None else rows
    n = F.floor(F.size(rows) * F.lit(part)).cast("int")
    most = F.floor(n * F.lit(share))
    short = lambda r: F.size(F.filter(r, lambda x: F.octet_length(x) < length))
    return [F.when(short(F.slice(rows, 1, n)) > most, "header"), F.when(short(F.slice(rows, F.size(rows) - n + 1, n)) > most, "footer")]


def noisy(text: Column, share: float = 0.5, rows: Column | None = None) -> list[Column]:
    """More code points that are neither letters nor marks than the whole part of ``share`` of all."""
    return [F.when(F.length(F.regexp_replace(text, r"[\p{L}\p{M}]", "")) > F.floor(F.length(text) * F.lit(share)), "noisy")]


#: The usual chain.
CHAIN: tuple[Callable[..., list[Column]], ...] = (tiny, short_sentences, header_footer, noisy)


def warnings(text: Column, chain: Sequence[Callable[..., list[Column]]] = CHAIN, rows: Column | None = None) -> Column:
    """The list of a chain's warnings, or null. The text is split into lines once for all of the chain, or not at all where ``rows`` has them."""

    def chained(r: Column) -> Column:
        return F.filter(F.array(*[c for f in chain for c in f(text, rows=r)]), lambda x: x.isNotNull())

    found = let(lines(text), chained) if rows is None else chained(rows)
    return let(found, lambda x: F.when(F.size(x) > 0, x))


def host(url: Column) -> Column:
    """The URL's host in lower case; null where there is none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def _parents(name: Column) -> Column:
    """The host and the domains above it."""
    parts = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))


def categories(docs: DataFrame, url: str, blocklist: DataFrame, parent_domains: bool = False) -> DataFrame:
    """Column ``categories``: the sorted categories of the blocklist (kind domain or url, value, category) whose domain is the row's host, or whose url is its url without the scheme; null without one.

    The blocklist is broadcast where it has at most BROADCAST_ROWS rows. The row's own columns and number of rows stay as they are.
    """
    keys = blocklist.where("value is not null").groupBy("kind", "value").agg(F.array_sort(F.collect_set("category")).alias("found"))
    small = blocklist.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    side = lambda kind, name: (F.broadcast if small else lambda x: x)(keys.where(F.col("kind") == kind).select(F.col("value").alias(name), F.col("found").alias(f"{name}_found")))
    name = host(F.col(url))
    bare = F.regexp_replace(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rows = docs.withColumns({"__host": name, "__url": bare})
    if parent_domains:
        above = rows.where("__host is not null").select("__host").distinct().select("__host", F.explode(_parents(F.col("__host"))).alias("__domain"))
        hits = above.join(side("domain", "__domain"), "__domain").groupBy("__host").agg(F.flatten(F.collect_set("__domain_found")).alias("__host_found"))
        rows = rows.join(hits, "__host", "left")
    else:
        rows = rows.join(side("domain", "__host"), "__host", "left")
    rows = rows.join(side("url", "__url"), "__url", "left")
    none = F.array().cast("array<string>")
    found = F.array_sort(F.array_union(F.coalesce("__host_found", none), F.coalesce("__url_found", none)))
    return rows.withColumn("categories", F.when(F.size(found) > 0, found)).select(*docs.columns, "categories")


def blocklist_kind(url: Column, domains: Sequence[str], urls: Sequence[str], kind: str) -> Column:
    """The list's kind where the URL's host is one of ``domains`` or the URL one of ``urls``; null else, and for an ill-formed URL."""
    hit = host(url).isin(*[urlsplit("//" + d).hostname or d for d in domains]) if domains else F.lit(False)
    return F.when(F.coalesce(hit, F.lit(False)) | (F.coalesce(url.isin(*urls), F.lit(False)) if urls else F.lit(False)), kind)
