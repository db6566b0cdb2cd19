"""Packaging of a corpus: checksums, exact duplicates by digest, parts of bounded size."""

from __future__ import annotations

import os
import re
import shutil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.schema import BadInput


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def file_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """(file, sha256) of every file of a folder, each read by one task."""
    return spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), sha256(F.col("content")).alias("sha256"))


def distinct_texts(docs: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """Of rows with one text, by its digest, the first by ``order``, nulls last. A null text is the empty text."""
    whole, place = F.struct("*"), F.struct(F.col(order).isNull(), F.col(order))
    return docs.groupBy(sha256(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("__sha")).agg(F.min_by(whole, place).alias("row")).select("row.*")


def write_parts(docs: DataFrame, folder: str, rows: int, codec: str = "gzip") -> None:
    """JSON lines in compressed files of at most ``rows`` rows."""
    docs.write.option("maxRecordsPerFile", rows).option("compression", codec).json(folder)


def package_language(source: str, lang: str, target: str | None, move: bool = False) -> list[str]:
    """Move or copy a language's files (``lang.txt.gz``, ``lang_meta.jsonl.gz`` or their ``_part_`` files) to its own folder, with their checksums. A language without files gives none."""
    import hashlib

    if target is None and not move:
        raise BadInput("copying needs a target folder")
    name = re.compile(rf"{re.escape(lang)}(?:_part_\d+)?\.txt\.gz|{re.escape(lang)}_meta(?:_part_\d+)?\.jsonl\.gz")
    files = sorted(f for f in os.listdir(source) if name.fullmatch(f))
    if not files:
        return []
    folder = os.path.join(target or source, lang)
    os.makedirs(folder, exist_ok=True)
    sums = []
    for f in files:
        (shutil.move if move else shutil.copy)(os.path.join(source, f), os.path.join(folder, f))
        with open(os.path.join(folder, f), "rb") as opened:
            sums.append(f"{hashlib.file_digest(opened, 'sha256').hexdigest()} {f}")
    with open(os.path.join(folder, f"{lang}_sha256.txt"), "w") as out:
        out.write("\n".join(sums) + "\n")
    return files
