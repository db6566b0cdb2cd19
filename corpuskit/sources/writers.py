"""What the pipeline writes: documents by language as JSON lines, and the rebuild index by language."""

from __future__ import annotations

import itertools
import os
import shutil
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from corpuskit.operators.rebuild import index
from corpuskit.schema import DOCUMENT, SHARD_RESULT, BadInput
from corpuskit.sources import avro

#: Rows of a file, so that one language's files stay of a size however large its part is.
FILE_ROWS = 1_000_000
#: Rows of an Avro file, each one shard's list, that a task holds at once.
AVRO_ROWS = 16


def write_documents(docs: DataFrame, folder: str) -> None:
    """(content, warc_headers, metadata, lang) as ``<folder>/lang=<lang>/*.json``, straight from the tasks that made them: no exchange, so no language is one task's."""
    docs.select("lang", "content", "warc_headers", "metadata").write.partitionBy("lang").option("maxRecordsPerFile", FILE_ROWS).option("ignoreNullFields", "false").json(folder)


def write_index(docs: DataFrame, folder: str) -> None:
    """The rebuild index as Parquet, by language."""
    index(docs).write.partitionBy("lang").parquet(folder)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A written corpus, or one file of it; ``lang`` where the path has it."""
    return spark.read.schema(DOCUMENT).json(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(lang, shard_id, rebuild_info) of a written index; or of one ``<lang>.avro`` file, or a folder of them, each read by one task, row by row."""
    files = [path] if path.endswith(".avro") else sorted(e.path for e in os.scandir(path) if e.name.endswith(".avro")) if os.path.isdir(path) else []
    if files:
        return _avro_rows(spark, files)
    return spark.read.parquet(path).select("lang", "shard_id", "rebuild_info")


def export_jsonl(folder: str, target: str) -> list[str]:
    """One file ``<lang>_meta.jsonl`` for each language of a written corpus, its parts one after the other."""
    os.makedirs(target, exist_ok=True)
    out = []
    for name in sorted(os.listdir(folder)):
        if name.startswith("lang="):
            path = os.path.join(target, f"{name[5:]}_meta.jsonl")
            with open(path, "wb") as whole:
                for part in sorted(os.listdir(os.path.join(folder, name))):
                    if part.endswith(".json"):
                        with open(os.path.join(folder, name, part), "rb") as f:
                            shutil.copyfileobj(f, whole)
            out.append(path)
    return out


def _avro_rows(spark: SparkSession, files: list[str]) -> DataFrame:
    """The driver only knows the files' names."""
    schema = StructType([StructField("lang", StringType()), *SHARD_RESULT.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                lang = os.path.basename(path).removesuffix(".avro")
                for rows in itertools.batched(avro.read(path), AVRO_ROWS):
                    yield pa.RecordBatch.from_pylist([{"lang": lang, **r} for r in rows], arrow)

    for f in files:
        if not os.path.isfile(f):
            raise BadInput(f"{f} is no file")
    return spark.createDataFrame([(f,) for f in files], "path string").repartition(len(files), "path").mapInArrow(run, schema)


def export_avro(spark: SparkSession, folder: str, target: str) -> list[str]:
    """One file ``<lang>.avro`` for each language of a written index, written by the task that has the language's rows, one by one; ``target`` is a folder that every executor can write."""
    os.makedirs(target, exist_ok=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for k in range(b.num_rows) for r in b.slice(k, 1).to_pylist())
        for lang, own in itertools.groupby(rows, lambda r: r["lang"]):
            path = os.path.join(target, f"{lang}.avro")
            avro.write(path, ({"shard_id": r["shard_id"], "rebuild_info": r["rebuild_info"]} for r in own))
            yield pa.RecordBatch.from_pylist([{"path": path}])

    found = spark.read.parquet(folder).select(F.col("lang").cast("string").alias("lang"), "shard_id", "rebuild_info")
    files = found.repartition("lang").sortWithinPartitions("lang", "shard_id").mapInArrow(run, "path string")
    return sorted(r.path for r in files.collect())
