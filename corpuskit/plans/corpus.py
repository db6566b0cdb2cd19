"""The corpus plan: records to documents, in the order trim, share of long lines, identification, annotation; then output and index, and back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpuskit.functions.arpa import perplexity
from corpuskit.functions.lines import bind, lines
from corpuskit.functions.tlsh import tlsh_hash
from corpuskit.operators import annotate, identify, multilingual
from corpuskit.operators.filters import FILTERS, exactly_noisy_tiny, noisy_and_tiny, readable
from corpuskit.operators.rebuild import rebuilt
from corpuskit.operators.transforms import trimmed
from corpuskit.schema import BadInput
from corpuskit.sources.wet import numbered, read_wet, shards
from corpuskit.sources.writers import read_index, write_documents, write_index
from corpuskit.storage import written


def documents(
    records: DataFrame,
    identifier: identify.LineIdentifier | None = None,
    blocklist: DataFrame | None = None,
    models: Mapping[str, str] | None = None,
    least_confidence: float = 0.6,
    document_filter: str = "long_share",
    drop_noisy_tiny: bool = False,
    with_tlsh: bool = True,
) -> DataFrame:
    """Documents (lang, content, warc_headers, metadata and location) of readable records.

    All but hashing, a trained model's identification and perplexity is Column expressions on one row, in one stage with the source; nothing is shuffled. ``drop_noisy_tiny`` drops documents with both warnings; by
    default only the list that is exactly noisy and tiny would be, which the annotators' order never gives.
    """
    rows = bind(readable(records), "doc", trimmed(F.col("body")), lambda d: d["kept"].isNotNull()).drop("body").select("*", "doc.*").drop("doc")
    rows = bind(rows, "rows", lines(F.col("content")), FILTERS[document_filter]())
    rows = rows.withColumn("raw", (identifier or identify.LexiconIdentifier()).identify(F.col("rows")))
    rows = bind(rows, "found", identify.tagged(F.col("raw")), lambda x: x["good"]).select("*", F.col("found.ids").alias("ids")).drop("raw", "found")
    named = identify.document_identification(identify.bins(F.col("ids"), identify.line_bytes(F.col("rows"))), multilingual.strict_lines(F.col("ids")), least_confidence)
    rows = bind(rows, "identification", named, lambda x: x.isNotNull())
    dropped = noisy_and_tiny if drop_noisy_tiny else exactly_noisy_tiny
    rows = bind(rows, "quality_warnings", annotate.warnings(F.col("content"), rows=F.col("rows")), lambda x: ~dropped(x))
    rows = rows.withColumn("tlsh", tlsh_hash(F.col("content")) if with_tlsh else F.lit(None).cast("string"))
    rows = rows.withColumn("uri", F.element_at("warc_headers", "warc-target-uri"))
    rows = annotate.categories(rows, "uri", blocklist) if blocklist is not None else rows.withColumn("categories", F.lit(None).cast("array<string>"))
    label = F.col("identification.label")
    rows = rows.withColumn("harmful_pp", perplexity(F.col("content"), label, models) if models else F.lit(None).cast("float"))
    metadata = F.struct("identification", "harmful_pp", "tlsh", "quality_warnings", "categories", F.col("ids").alias("sentence_identifications"))
    return rows.select(label.alias("lang"), "content", "warc_headers", metadata.alias("metadata"), "shard_id", "record_id", F.col("kept.start").alias("line_start"), F.col("kept.end").alias("line_end"), "loc_in_shard")


def run(spark: SparkSession, source: str, target: str, **options) -> dict[str, int]:
    """Shards in ``source`` to ``<target>/documents``, ``<target>/rebuild`` and ``<target>/counts`` (documents of each shard). The documents are made once and written from that table.

    What it gives back is counted on the way, without a further job: records read, those that couldn't be, and documents.
    """
    seen, kept = Observation("records"), Observation("documents")
    records = read_wet(spark, source).observe(seen, F.count(F.lit(1)).alias("records"), F.count("error").alias("unreadable"))
    docs = written(documents(records, **options).observe(kept, F.count(F.lit(1)).alias("documents")), "documents")
    write_documents(docs, f"{target}/documents")
    write_index(docs, f"{target}/rebuild")
    docs.groupBy("shard_id").agg(F.count(F.lit(1)).alias("documents")).write.parquet(f"{target}/counts")
    return {**seen.get, **kept.get}


def run_rebuild(spark: SparkSession, index: str, source: str, target: str, lang: str | None = None) -> DataFrame:
    """The documents of an index (of one language of it) out of the shards again, to ``target``. Only shards that the index names are opened; one that isn't there is an error.

    Returned is what went wrong: (shard_id, lang, wanted, documents, unreadable) of each list of the index from which fewer documents came than it names.
    """
    found = read_index(spark, index)
    found = found.where(F.col("lang") == lang) if lang else found
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    named = [r["shard_id"] for r in found.select("shard_id").distinct().collect()]  # one number for each file
    if missing := sorted(set(named) - {n for n in map(numbered, shards(source)) if n is not None}):
        raise BadInput(f"{source}: {len(missing)} of the {len(named)} shards that the index names aren't there, the first {', '.join(map(str, missing[:10]))}")
    docs = written(rebuilt(found, read_wet(spark, source).where(F.col("shard_id").isin(named))), "rebuilt")
    write_documents(docs.where("error is null"), target)
    wanted = found.groupBy("shard_id", "lang").agg(F.sum(F.size("rebuild_info")).alias("wanted"))
    came = docs.groupBy("shard_id", "lang").agg(F.count(F.when(F.col("error").isNull(), 1)).alias("documents"), F.count("error").alias("unreadable"))
    none = F.lit(0).cast("long")
    return wanted.join(came, ["shard_id", "lang"], "left").select("shard_id", "lang", "wanted", F.coalesce("documents", none).alias("documents"), F.coalesce("unreadable", none).alias("unreadable")).where("documents < wanted")
