"""Fetching shards: a paths file becomes URLs, and each URL a numbered file."""

from __future__ import annotations

import os
import shutil
import urllib.error
import urllib.request
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = "https://data.commoncrawl.org/"


def path_url(path: Column, base: str = BASE) -> Column:
    """The URL of a path; null where that is none."""
    url = F.concat(F.lit(base), F.trim(path))
    return F.when((F.trim(path) != "") & F.try_parse_url(url, F.lit("PROTOCOL")).isNotNull(), url)


def read_paths(spark: SparkSession, file: str, base: str = BASE) -> DataFrame:
    """(idx, path, url) of the paths file's lines, numbered from 0; lines that give no URL are left out, and numbers are those of the others. The file is read by one task, as it lists files and no data."""
    lines = spark.read.option("wholetext", "true").text(file).select(F.posexplode(F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")).alias("line", "path"))
    urls = lines.select("line", "path", path_url(F.col("path"), base).alias("url")).where("url is not null").coalesce(1).sortWithinPartitions("line")
    return urls.select((F.monotonically_increasing_id()).alias("idx"), "path", "url")


def fetch(url: str, target: str, timeout: float = 60) -> None:
    """Stream a URL to a file; it appears under its name only when it is whole."""
    part = target + ".part"
    with urllib.request.urlopen(url, timeout=timeout) as got, open(part, "wb") as out:  # an HTTP error status raises
        shutil.copyfileobj(got, out, 1 << 20)
    os.replace(part, target)


def download(urls: DataFrame, folder: str, tasks: int = 4, offset: int = 0) -> DataFrame:
    """Fetch (idx, path, url) rows from ``offset`` on to ``<folder>/<idx>.txt.gz``, ``tasks`` at a time. (idx, url, target, error): one row for each, error null where it worked; ``http`` says that the server refused.

    The folder is one that every executor can write. A file that is there already is fetched again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            out = []
            for idx, url in zip(batch["idx"], batch["url"]):
                target = os.path.join(folder, f"{idx}.txt.gz")
                try:
                    fetch(url, target)
                    out.append((idx, url, target, None, False))
                except Exception as e:  # each failure is a row of the result
                    out.append((idx, url, target, f"{type(e).__name__}: {e}", isinstance(e, urllib.error.HTTPError)))
            yield pd.DataFrame(out, columns=["idx", "url", "target", "error", "http"])

    chosen = urls.where(F.col("idx") >= offset).select("idx", "url")
    return chosen.repartition(tasks, "idx").mapInPandas(run, "idx long, url string, target string, error string, http boolean")


def flattened_error(*errors: Column) -> Column:
    """The first of the errors that there is."""
    return F.coalesce(*errors)


def error_log(results: DataFrame) -> DataFrame:
    """Lines ``url<tab>idx`` of what the server refused."""
    return results.where("http").select(F.concat_ws("\t", "url", F.col("idx").cast("string")).alias("value"))


def is_url(text: str) -> bool:
    return bool(urlsplit(text).scheme and urlsplit(text).netloc)
