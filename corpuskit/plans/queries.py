"""The engine's queries by name, and DuckDB SQL for the same rows (``oracle.py``). Each runs over whole tables; where an operator needs places in shards, document i lies in shard i div 100."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.functions import arpa, tags
from corpuskit.functions.lines import bind, lines
from corpuskit.functions.tlsh import tlsh_hash
from corpuskit.functions.words import spaced_pieces, unicode_words
from corpuskit.operators import annotate, filters, identify, multilingual, package, rebuild, transforms, zipf
from corpuskit.plans import corpus
from corpuskit.plans.oracle import BLOCKED_DOMAINS, BLOCKED_URLS, BLOCKLIST, LABELS, oracle_sql
from corpuskit.sources.download import path_url
from corpuskit.sources.wet import shard_number_of

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def _docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", *(columns or ("text",)))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.posexplode(lines(F.col("text"))).alias("pos", "line"))


def _joined(warnings: list[Column]) -> Column:
    return F.concat_ws(",", *warnings)


@_query
def src_shard_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id").cast("string")
    name = F.when(F.col("doc_id") % 7 == 0, F.concat("source", F.lit(".txt.gz"))).when(F.col("doc_id") % 7 == 1, i).otherwise(F.concat(i, F.lit(".txt.gz")))
    return _docs(spark, sf_dir, "source").select("doc_id", shard_number_of(name).alias("shard_id"))


@_query
def src_paths_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.when(F.col("doc_id") % 11 == 0, " ").otherwise(F.format_string("crawl-data/%s/%d.warc.wet.gz", "source", "doc_id"))
    return _docs(spark, sf_dir, "source").select("doc_id", path_url(path).alias("url"))


@_query
def flt_length_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).where(filters.Length()(F.col("line"))).select("doc_id", F.col("pos").cast("long").alias("pos"), F.length("line").cast("long").alias("n_chars"))


@_query
def flt_mean_length_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select("doc_id", F.col("pos").cast("long").alias("pos"), F.length("line").alias("n"))
    return filters.mean_length_running(rows, F.col("n"), ["doc_id"], ["pos"]).select("doc_id", "pos", "near")


@_query
def flt_mean_length_frozen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select("doc_id", F.col("pos").cast("long").alias("pos"), F.length("line").alias("n"))
    return rows.select("doc_id", "pos", filters.MeanLength.fit(rows, "n")(F.col("n")).alias("near"))


@_query
def flt_pfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", filters.LongShare()(rows).alias("kept"), filters.LongShare(0.95, 150)(rows).alias("kept_strictly"))


@_query
def flt_noisy_tiny_intent(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = (annotate.tiny, lambda t, rows: annotate.noisy(t, 0.22))
    found = annotate.warnings(F.col("text"), chain)
    return _docs(spark, sf_dir).select("doc_id", filters.noisy_and_tiny(found).alias("both"), filters.exactly_noisy_tiny(found).alias("exactly"))


@_query
def trf_trim_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    content, bounds = transforms.trim_short(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", bounds["start"].alias("line_start"), bounds["end"].alias("line_end"), F.md5(content.cast("binary")).alias("content_md5"))


@_query
def trf_conv_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    content, bounds = transforms.trim_by_mean(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", bounds["start"].alias("line_start"), bounds["end"].alias("line_end"), F.md5(content.cast("binary")).alias("content_md5"))


@_query
def ann_tiny(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", _joined(annotate.tiny(F.col("text"))).alias("warnings"))


@_query
def ann_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", _joined(annotate.short_sentences(F.col("text"))).alias("warnings"))


@_query
def ann_header_footer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", _joined(annotate.header_footer(F.col("text"))).alias("warnings"))


@_query
def ann_noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", _joined(annotate.noisy(F.col("text"))).alias("warnings"), _joined(annotate.noisy(F.col("text"), 0.22)).alias("warnings_strictly"))


@_query
def ann_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bind(_docs(spark, sf_dir), "doc", transforms.trimmed(F.col("text")), lambda d: d["kept"].isNotNull()).select("doc_id", "doc.*")
    rows = bind(docs, "rows", lines(F.col("content")), filters.LongShare())
    return rows.select("doc_id", F.col("kept.start").alias("line_start"), F.col("kept.end").alias("line_end"), F.octet_length("content").cast("long").alias("n_bytes"), F.array_join(annotate.warnings(F.col("content"), rows=F.col("rows")), ",").alias("warnings"))


@_query
def ann_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    blocklist = spark.createDataFrame(BLOCKLIST, "kind string, value string, category string")
    return annotate.categories(pages, "url", blocklist).select("page_id", F.array_join("categories", ",").alias("categories"))


@_query
def ann_blocklist_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return pages.select("page_id", annotate.blocklist_kind(F.col("url"), BLOCKED_DOMAINS, BLOCKED_URLS, "adult").alias("kind"))


@_query
def ann_tlsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", tlsh_hash(F.col("text")).alias("tlsh"))


@_query
def ann_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under small models of function words, one for each language."""
    models = {k: arpa.LanguageModel.parse(arpa.estimate([" ".join(w), " ".join(reversed(w))])) for k, w in identify.LEXICON.items()}
    return _docs(spark, sf_dir, "text", "lang").select("doc_id", arpa.perplexity(F.col("text"), F.col("lang"), models).alias("perplexity"))


@_query
def lid_tag_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.array(*[F.lit(x) for x in LABELS], F.concat(F.lit("__label__"), "lang"))
    rows = _docs(spark, sf_dir, "lang").select("doc_id", F.element_at(labels, (F.col("doc_id") % (len(LABELS) + 1) + 1).cast("int")).alias("label"))
    return rows.select("doc_id", "label", tags.fixed(F.col("label")).alias("tag"), tags.well_formed(tags.fixed(F.col("label"))).alias("well_formed"))


def _bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids, sizes = identify.identified_lines(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", ids.alias("ids"), sizes.alias("sizes")).select("doc_id", "ids", "sizes", identify.bins(F.col("ids"), F.col("sizes")).alias("bins"))


@_query
def lid_weighted_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bins(spark, sf_dir).select("doc_id", F.explode("bins").alias("b")).select("doc_id", "b.label", "b.bytes", F.round("b.conf", 6).alias("conf"))


def _voted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bins(spark, sf_dir).select("doc_id", identify.vote(F.col("bins")).alias("v")).where("v is not null").select("doc_id", "v.label", "v.bytes", "v.conf")


@_query
def lid_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _voted(spark, sf_dir).select("doc_id", "label", "bytes", F.round("conf", 6).alias("conf"), (F.col("label").isNotNull() & (F.col("conf") >= 0.6)).alias("accepted"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document and the next one, if there is one, together, as documents in up to two languages."""
    ids, sizes = identify.identified_lines(F.col("text"))
    rows = _docs(spark, sf_dir).select("doc_id", ids.alias("ids"), sizes.alias("sizes"))
    after = rows.select((F.col("doc_id") - 1).alias("doc_id"), F.col("ids").alias("ids_b"), F.col("sizes").alias("sizes_b"))
    both = lambda a, b: F.when(F.col(b).isNull(), F.col(a)).otherwise(F.concat(a, b)).alias(a)
    return rows.join(after, "doc_id", "left").select("doc_id", both("ids", "ids_b"), both("sizes", "sizes_b"))


@_query
def ml_strict_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.col("ids")
    return _pairs(spark, sf_dir).select("doc_id", multilingual.strict_lines(ids).alias("multi"), multilingual.strict_lines(ids, 4, 0.8, 0.5).alias("multi_loosely"))


@_query
def ml_strict_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids, sizes = F.col("ids"), F.col("sizes")
    return _pairs(spark, sf_dir).select("doc_id", multilingual.strict_bytes(ids, sizes).alias("multi"), multilingual.strict_bytes(ids, sizes, 4, 0.8, 0.5).alias("multi_loosely"))


@_query
def ml_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("doc_id", multilingual.ratio(F.col("ids")).alias("multi"), multilingual.ratio(F.col("ids"), 4, 3, 8.0).alias("multi_loosely"))


@_query
def agg_docs_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _voted(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("documents"), F.sum("bytes").alias("bytes"))


@_query
def zipf_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zipf.word_counts(_docs(spark, sf_dir))


@_query
def zipf_unicode_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zipf.word_counts(_docs(spark, sf_dir), words=unicode_words, pieces=spaced_pieces)


@_query
def zipf_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zipf.ranking(zipf.word_counts(_docs(spark, sf_dir))).select("rank", "count", F.round("prob", 9).alias("prob"), F.round("constant", 6).alias("constant"))


@_query
def zipf_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zipf.statistics(zipf.word_counts(_docs(spark, sf_dir))).select("words", "total", F.round("mean", 6).alias("mean"), F.round("sigma", 6).alias("sigma"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = F.create_map(F.lit("content-length"), F.lit("0"), F.lit("warc-type"), F.lit("conversion"))
    return _docs(spark, sf_dir, "text", "lang").select(
        F.expr("doc_id div 100").alias("shard_id"),
        (F.col("doc_id") % 100).alias("loc_in_shard"),
        F.col("doc_id").cast("string").alias("record_id"),
        headers.alias("warc_headers"),
        F.col("text").alias("body"),
        F.lit(None).cast("string").alias("error"),
        "lang",
    )


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bounds = transforms.trim_short(F.col("body"))
    rows = _records(spark, sf_dir).select("lang", "shard_id", "record_id", "loc_in_shard", bounds.alias("kept")).where("kept is not null")
    return rows.select("lang", "shard_id", "record_id", "loc_in_shard", F.col("kept.start").alias("line_start"), F.col("kept.end").alias("line_end"), F.struct(F.lit(None).cast("string").alias("tlsh")).alias("metadata"))


@_query
def rb_shard_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rebuild.index(_located(spark, sf_dir))
    listed = F.transform("rebuild_info", lambda x: F.concat_ws(":", x["loc_in_shard"].cast("string"), x["line_start"].cast("string"), x["line_end"].cast("string")))
    return found.select("lang", "shard_id", F.size("rebuild_info").cast("long").alias("entries"), F.array_join(listed, ",").alias("places"))


@_query
def rb_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rebuild.rebuilt(rebuild.index(_located(spark, sf_dir)), _records(spark, sf_dir).drop("lang"))
    return docs.select(F.col("record_id").cast("long").alias("doc_id"), "lang", F.md5(F.col("content").cast("binary")).alias("content_md5"), F.element_at("warc_headers", "content-length").cast("long").alias("content_length"))


@_query
def rb_mismatch_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = _located(spark, sf_dir).withColumn("record_id", F.when(F.col("record_id").cast("long") % 37 == 5, "other").otherwise(F.col("record_id")))
    docs = rebuild.rebuilt(rebuild.index(wrong), _records(spark, sf_dir).drop("lang"))
    return docs.groupBy("lang", "shard_id").agg(F.count(F.lit(1)).alias("documents"), F.max("loc_in_shard").alias("last"))


@_query
def pkg_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", package.sha256(F.col("text").cast("binary")).alias("sha256"))


@_query
def pkg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return package.distinct_texts(_docs(spark, sf_dir)).select("doc_id", F.length("text").cast("long").alias("n_chars"))


@_query
def corpus_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole plan but for hashes and perplexity, which SQL can't express."""
    docs = corpus.documents(_records(spark, sf_dir).drop("lang"), with_tlsh=False)
    return docs.select(
        F.col("record_id").cast("long").alias("doc_id"),
        "lang",
        F.round(F.col("metadata.identification.prob").cast("double"), 4).alias("prob"),
        "line_start",
        "line_end",
        F.octet_length("content").cast("long").alias("n_bytes"),
        F.array_join("metadata.quality_warnings", ",").alias("warnings"),
        F.size("metadata.sentence_identifications").cast("long").alias("n_lines"),
    )


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


__all__ = ["oracle_sql", "queries"]
