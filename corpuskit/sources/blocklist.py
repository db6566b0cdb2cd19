"""Blocklists laid out as ``<category>/domains`` and ``<category>/urls``, one entry a line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_blocklist(spark: SparkSession, folder: str) -> DataFrame:
    """(kind domain or url, value, category)."""
    rows = spark.read.option("recursiveFileLookup", "true").text(folder).select(F.trim("value").alias("value"), F.split(F.col("_metadata.file_path"), "/").alias("parts"))
    named = rows.select("value", F.element_at("parts", -2).alias("category"), F.element_at("parts", -1).alias("file"))
    kind = F.when(F.col("file") == "domains", "domain").when(F.col("file") == "urls", "url")
    return named.select(kind.alias("kind"), "value", "category").where("kind is not null and value <> '' and not startswith(value, '#')")
