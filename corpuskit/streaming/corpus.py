"""The corpus plan over documents that keep arriving. Every operator of it looks at one row, so a stream needs no state; word counts keep theirs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corpuskit.functions.words import plain_words
from corpuskit.plans.corpus import documents
from corpuskit.schema import RECORD
from corpuskit.sources.writers import write_documents


def record_stream(spark: SparkSession, folder: str, schema: StructType = RECORD, files: int = 100) -> DataFrame:
    """Records out of Parquet files as they arrive in a folder, at most ``files`` a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def document_stream(records: DataFrame, **options) -> DataFrame:
    """The plan's documents of a stream of records. A blocklist is a static table, joined to each batch."""
    return documents(records, **options)


def write_stream(docs: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write what has arrived and end; each batch has its own folder, written over if the batch is repeated, so a restart after a loss writes no row twice."""

    def one(batch: DataFrame, number: int) -> None:
        folder = f"{target}/batch={number}"
        jvm = batch.sparkSession.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(batch.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        write_documents(batch, folder)

    return docs.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def language_counts(docs: DataFrame, time: str, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """(window, lang, documents): windowed counts; rows later than the watermark are no longer counted, and closed windows leave the state."""
    return docs.withWatermark(time, late).groupBy(F.window(time, window), "lang").agg(F.count(F.lit(1)).alias("documents"))


def running_word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, count) over all that has arrived."""
    return docs.select(F.explode(plain_words(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
