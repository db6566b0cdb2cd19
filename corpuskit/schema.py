"""Schemas of the engine's tables, and its errors."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, FloatType, LongType, MapType, StringType, StructField, StructType

IDENTIFICATION = StructType([StructField("label", StringType()), StructField("prob", FloatType())])
METADATA = StructType(
    [
        StructField("identification", IDENTIFICATION),
        StructField("harmful_pp", FloatType()),
        StructField("tlsh", StringType()),
        StructField("quality_warnings", ArrayType(StringType())),
        StructField("categories", ArrayType(StringType())),
        StructField("sentence_identifications", ArrayType(IDENTIFICATION)),
    ]
)
RECORD = StructType(
    [
        StructField("shard_id", LongType()),
        StructField("loc_in_shard", LongType()),
        StructField("record_id", StringType()),
        StructField("warc_headers", MapType(StringType(), StringType())),
        StructField("body", StringType()),
        StructField("error", StringType()),
    ]
)
LOCATION = StructType([StructField("shard_id", LongType()), StructField("record_id", StringType()), StructField("line_start", LongType()), StructField("line_end", LongType()), StructField("loc_in_shard", LongType())])
REBUILD_INFORMATION = StructType([*LOCATION.fields, StructField("metadata", METADATA)])
SHARD_RESULT = StructType([StructField("shard_id", LongType()), StructField("rebuild_info", ArrayType(REBUILD_INFORMATION))])
DOCUMENT = StructType([StructField("content", StringType()), StructField("warc_headers", MapType(StringType(), StringType())), StructField("metadata", METADATA)])


class CorpusError(Exception):
    """Anything that this engine itself raises."""


class UnknownLanguage(CorpusError):
    """A label that is no well-formed language tag."""


class IncompleteLocation(CorpusError):
    """A location without one of its fields."""


class BadInput(CorpusError):
    """A path of the wrong kind, or a file that can't be read."""
