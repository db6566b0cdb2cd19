"""Word counts and how far they follow Zipf's law.

Ranks need no global sort: words of equal count have successive ranks, and there are few distinct counts, so ranks are places among the counts of counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.functions.words import plain_words

#: Ranks that one row of the ranking is expanded to at a time.
RUN = 1 << 16


def word_counts(docs: DataFrame, text: str = "text", words=plain_words, pieces=None) -> DataFrame:
    """(word, count), over all texts; combined in each task before the shuffle.

    ``pieces`` parts a text where no word goes over: equal pieces are counted first, and ``words``, where that is dear, sees each of them once.
    """
    if pieces is not None:
        found = docs.select(F.explode(pieces(F.col(text))).alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
        return found.select("n", F.explode(words(F.col("piece"))).alias("word")).groupBy("word").agg(F.sum("n").alias("count"))
    return docs.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def _runs(counts: DataFrame) -> DataFrame:
    """(count, words, first, total): the words of one count hold the ranks from ``first`` on. A row for each distinct count."""
    by = counts.groupBy("count").agg(F.count(F.lit(1)).alias("words"))
    everything = Window.partitionBy(F.lit(1))
    before = Window.partitionBy(F.lit(1)).orderBy(F.col("count").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return by.select("count", "words", (F.coalesce(F.sum("words").over(before), F.lit(0)) + 1).alias("first"), F.sum(F.col("words") * F.col("count")).over(everything).alias("total"))


def ranking(counts: DataFrame) -> DataFrame:
    """(rank, count, prob, constant), most frequent first, one row for each word; the word itself isn't part of it, so ties don't matter."""
    runs = _runs(counts).withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(words - 1) div {RUN}"))))
    rows = runs.withColumn("rank", F.explode(F.sequence(F.col("first") + F.col("at") * RUN, F.col("first") + F.least(F.col("words"), (F.col("at") + 1) * RUN) - 1)))
    prob: Column = F.col("count") / F.col("total")
    return rows.select("rank", "count", prob.alias("prob"), (prob * F.col("rank")).alias("constant"))


def statistics(counts: DataFrame) -> DataFrame:
    """One row: words, total, mean and (population) deviation of the constants, from sums of ranks and their squares in closed form. Null figures for no words."""
    n, a = F.col("words").cast("double"), F.col("first").cast("double")
    b = a + n - 1
    sums = n * (a + b) / 2
    upto = lambda x: x * (x + 1) * (2 * x + 1) / 6
    squares = upto(b) - upto(a - 1)
    p = F.col("count") / F.col("total")
    r = _runs(counts).agg(F.sum("words").alias("words"), F.max("total").alias("total"), F.sum(p * sums).alias("s"), F.sum(p * p * squares).alias("q"))
    mean = F.col("s") / F.col("words")
    return r.select("words", "total", mean.alias("mean"), F.sqrt(F.greatest(F.col("q") / F.col("words") - mean * mean, F.lit(0.0))).alias("sigma"))
