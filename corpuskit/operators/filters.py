"""Filters on lines and documents, as Column predicates; those that are fitted first take their statistics from the whole table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Length:
    """More than ``least`` code points. A null line is not long."""

    least: int = 100

    def __call__(self, line: Column) -> Column:
        return F.length(line) > self.least


@dataclass(frozen=True)
class LongShare:
    """At least ``share`` of a document's code points are in lines of ``least`` code points or more; a document without any passes."""

    share: float = 0.6
    least: int = 100

    def __call__(self, lines: Column) -> Column:
        zero = F.lit(0).cast("long")
        whole = F.aggregate(lines, zero, lambda s, x: s + F.length(x))
        upper = F.aggregate(lines, zero, lambda s, x: s + F.when(F.length(x) >= self.least, F.length(x)).otherwise(0))
        return upper >= whole * F.lit(self.share)


#: Document filters by name; the first is the default.
FILTERS = {"long_share": LongShare}


def mean_length_running(lines: DataFrame, length: Column, by: list[str], order: list[str]) -> DataFrame:
    """Column ``near``: the line's length is less than one standard deviation (of the population) from the mean of all lines up to and with this one. One stream of lines for each ``by``."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = length.cast("double")
    n, s, q = F.count(F.lit(1)).over(w), F.sum(x).over(w), F.sum(x * x).over(w)
    mean = s / n
    return lines.withColumn("near", F.abs(x - mean) < F.sqrt(F.greatest(q / n - mean * mean, F.lit(0.0))))


@dataclass(frozen=True)
class MeanLength:
    """Less than one standard deviation (of the population) from the mean length, both frozen."""

    mean: float
    deviation: float

    @classmethod
    def fit(cls, lengths: DataFrame, column: str) -> MeanLength:
        """Over all rows; one aggregate."""
        r = lengths.agg(F.avg(column).alias("m"), F.stddev_pop(column).alias("d")).first()
        return cls(r["m"] if r["m"] is not None else 0.0, r["d"] or 0.0)

    def __call__(self, length: Column) -> Column:
        return F.abs(length - F.lit(self.mean)) < F.lit(self.deviation)


def readable(records: DataFrame) -> DataFrame:
    """Records that the source could read."""
    return records.where("error is null")


def noisy_and_tiny(warnings: Column) -> Column:
    """Both warnings are there, in whatever order."""
    return F.coalesce(F.array_contains(warnings, "noisy") & F.array_contains(warnings, "tiny"), F.lit(False))


def exactly_noisy_tiny(warnings: Column) -> Column:
    """The list is ``noisy, tiny`` and nothing else: never so where annotators run in their usual order, tiny first."""
    return F.coalesce(warnings == F.array(F.lit("noisy"), F.lit("tiny")), F.lit(False))
