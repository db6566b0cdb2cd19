"""Lines of a text as an array column: split at ``\\n``, one ``\\r`` before it belongs to the break, and a last break ends the last line."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is evaluated once a row, however often, and however deep within lambdas, ``f`` names it."""
    return F.element_at(F.transform(F.array(value), lambda x: f(x)), 1)


def bind(df: DataFrame, name: str, value: Column, keep: Callable[[Column], Column] = lambda x: F.lit(True)) -> DataFrame:
    """Column ``name`` of a value, and only rows for which ``keep`` holds of it.

    It is generated from an array of one or none, for Catalyst copies a projected expression into each filter above it: an expensive one would be evaluated again and again.
    """
    return df.select("*", F.explode(F.filter(F.array(value), lambda x: keep(x))).alias(name))


def lines(text: Column) -> Column:
    t = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    body = F.when(t.endswith("\n"), F.left(t, F.length(t) - 1)).otherwise(t)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n", -1))


def joined(rows: Column) -> Column:
    return F.array_join(rows, "\n")


def kept_range(rows: Column, keep) -> Column:
    """Struct (start, end) of the first and the last line for which ``keep`` holds; null if there is none."""
    at = F.filter(F.transform(rows, lambda x, i: F.when(keep(x), i)), lambda i: i.isNotNull())
    return F.when(F.size(at) > 0, F.struct(F.array_min(at).cast("long").alias("start"), F.array_max(at).cast("long").alias("end")))


def between(rows: Column, bounds: Column) -> Column:
    """The lines of an inclusive range, joined; empty where there is no range."""
    size = (bounds["end"] - bounds["start"] + 1).cast("int")
    return F.coalesce(joined(F.slice(rows, (bounds["start"] + 1).cast("int"), size)), F.lit(""))


def without_nul(text: Column) -> Column:
    return F.replace(text, F.lit("\x00"), F.lit(""))


def flattened(text: Column) -> Column:
    """One line of it, as language models read it."""
    return F.replace(text, F.lit("\n"), F.lit(" "))
