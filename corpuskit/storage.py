"""Tables written between steps, in the folder that every executor shares.

Lineage is cut by writing a table there and reading it again, so that a lost executor costs a re-read and never a recomputation
from the source. The folder is the one the cluster names in ``spark.checkpoint.dir``; only a local master gets one of our own.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session; a local master without the setting gets a temporary one."""
    conf = spark.sparkContext.getConf()
    found = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not conf.get("spark.master", "local").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="corpuskit-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and return it as read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/corpuskit/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not _written:
        atexit.register(drop_written)
    _written.append((spark, path))
    return kept_at(spark.read.schema(df.schema).parquet(path), path)


def kept_at(df: DataFrame, path: str) -> DataFrame:
    """``df``, marked as what is read from ``path``, for ``discard``."""
    df._written_path = path
    return df


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete written tables at once. For those that only tables already written themselves were made of: nothing that is still to run may read them."""
    for df in tables:
        spark, path = df.sparkSession, df._written_path
        _written.remove((spark, path))
        _delete(spark, path)


def drop_written() -> None:
    """Delete every table written so far; their readers stop working."""
    while _written:
        spark, path = _written.pop()
        try:
            _delete(spark, path)
        except Exception:  # the session has ended: whoever owns the folder cleans it
            continue
