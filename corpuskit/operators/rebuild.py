"""The rebuild index: where each document lies in the shards, and the corpus made from the shards again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.functions.lines import between, lines
from corpuskit.operators.transforms import with_content_length
from corpuskit.schema import IncompleteLocation

FIELDS = ("shard_id", "record_id", "line_start", "line_end", "loc_in_shard")


def checked_location(**fields) -> dict:
    """The five fields of a location; an error names the first that is missing."""
    for name in FIELDS:
        if fields.get(name) is None:
            raise IncompleteLocation(f"{name} is missing")
    return {name: fields[name] for name in FIELDS}


def complete(rows: DataFrame) -> DataFrame:
    """Rows whose location has all fields."""
    return rows.dropna(subset=list(FIELDS))


def index(docs: DataFrame, lang: str = "lang") -> DataFrame:
    """(lang, shard_id, rebuild_info): of each language and shard the locations and metadata, in the order of the shard. A shard is one file, which bounds a row's size."""
    info = F.struct("loc_in_shard", "shard_id", "record_id", "line_start", "line_end", "metadata")
    ordered = F.transform(F.array_sort(F.collect_list(info), lambda a, b: F.when(a["loc_in_shard"] < b["loc_in_shard"], -1).when(a["loc_in_shard"] > b["loc_in_shard"], 1).otherwise(0)), lambda x: F.struct(*[x[n].alias(n) for n in (*FIELDS, "metadata")]))
    return complete(docs).groupBy(F.col(lang).alias("lang"), "shard_id").agg(ordered.alias("rebuild_info"))


def entries(found: DataFrame) -> DataFrame:
    """The index's rows, one by one, each with its place within its shard's list, and whether it lies before the entry ahead of it (``unordered``)."""
    marked = F.transform("rebuild_info", lambda x, i: F.struct(x.alias("x"), F.coalesce((i > 0) & (F.get(F.col("rebuild_info"), i - 1)["loc_in_shard"] >= x["loc_in_shard"]), F.lit(False)).alias("unordered")))
    return found.select(*[c for c in found.columns if c not in ("shard_id", "rebuild_info")], F.posexplode(marked).alias("place", "m")).select("*", "m.x.*", "m.unordered").drop("m")


def rebuilt(found: DataFrame, records: DataFrame) -> DataFrame:
    """Documents of the index (lang, shard_id, rebuild_info) out of the shards' records: shard_id, loc_in_shard, record_id, content, warc_headers, metadata.

    As a reader that goes through a shard would, it ends a shard's list before the first entry that is out of order, lies beyond the shard or has another record's id
    there. A record that can't be read keeps its row, with ``error``.

    Where each list ends is found by the records' ids alone, with a combined aggregate; bodies and metadata move only for the join that makes the content.
    """
    keep = [c for c in found.columns if c not in ("shard_id", "rebuild_info")]
    own = ["shard_id", *keep]
    rows = entries(found)
    ids = records.select("shard_id", "loc_in_shard", F.col("record_id").alias("there"), F.col("error").alias("fault"), F.lit(True).alias("known"))
    wrong = F.col("known").isNull() | F.col("unordered") | (F.col("fault").isNull() & ~F.col("record_id").eqNullSafe(F.col("there")))
    held = rows.select(*own, "place", "loc_in_shard", "record_id", "unordered").join(ids, ["shard_id", "loc_in_shard"], "left").where(wrong)
    ends = held.groupBy(*own).agg(F.min("place").alias("end")).toDF(*[f"of_{c}" for c in own], "end")
    same = [F.col(f"of_{c}").eqNullSafe(F.col(c)) for c in own]
    good = rows.join(ends, same, "left").where("end is null or place < end").select(*rows.columns)
    there = good.alias("e").join(records.alias("r"), (F.col("e.shard_id") == F.col("r.shard_id")) & (F.col("e.loc_in_shard") == F.col("r.loc_in_shard")))
    content = between(lines(F.col("r.body")), F.struct(F.col("e.line_start").alias("start"), F.col("e.line_end").alias("end")))
    flat = there.select(*[F.col(f"e.{c}").alias(c) for c in own], F.col("e.loc_in_shard").alias("loc_in_shard"), F.col("e.record_id").alias("record_id"), content.alias("content"), F.col("r.warc_headers").alias("h"), F.col("e.metadata").alias("metadata"), F.col("r.error").alias("error"))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return flat.select("shard_id", *keep, "loc_in_shard", "record_id", "content", with_content_length(F.coalesce("h", none), F.col("content")).alias("warc_headers"), "metadata", "error")
