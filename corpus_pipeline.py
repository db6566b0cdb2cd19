"""A corpus pipeline of five stages: language ID, exact dedup, near duplicates, mixing to target weights, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuskit.llm import exact_dedup, langid, mixing, ngram_join, packing
from corpuskit.llm.rows import rows_of
from corpuskit.storage import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model accepts; it learns from the labelled ones of them that aren't held out."""
    return langid.accepted(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, up to white space, the document with the smallest id."""
    return rows_of(docs, exact_dedup.exact_dedup(docs, keys=True))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id."""
    return rows_of(docs, ngram_join.ngram_join(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which their sources' target weights interleave them."""
    return mixing.mixed_rows(docs, int(spark.conf.get("spark.sql.shuffle.partitions")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their token ids; each piece is a sequence, and ``sequence_id`` follows the mixed order, in which the stage before wrote the files. Of a table that isn't read from files, it follows the schedule."""
    return packing.pack_as_written(docs) if docs.inputFiles() else packing.pack(mixed(spark, docs, sf_dir))


STAGES = [("language_id", language_id), ("exact_dedup", exact_duplicates), ("ngram_join", near_duplicates), ("mixing", mixed), ("packing", packed)]

#: Models, MinHash values and tokenizers are beyond SQL: the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; what each returns is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
