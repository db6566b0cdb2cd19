"""Nulls in any column, empty and very long texts, ties and repeated rows, empty tables, and extra columns whose names clash with those used inside."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpuskit.llm import exact_dedup, fingerprint, html_text, langid, mixing, ngram_join, packing, pii, secrets, url_filter
from corpuskit.llm.rows import rows_of

CLASHING = "uid gid digit ended rest sha bytes n first row row_key set_key sig bands key leader comp slot at block phase h tie size chunk place start length ids kept found p score following range last t url rule verdict salt".split()
LONG = "word and the other " * 20000
ROWS = [(1, "the cat and the dog", "en", "a"), (1, "the cat and the dog", "en", "a"), (2, None, None, None), (3, "", "en", "a"), (None, "text without id", None, "b"), (None, None, None, None), (4, LONG, "en", "b"), (5, "12345 !?", "de", "b"), (6, "\ud7ff\U0001f600 é", "fr", None), (7, "the cat and the dog", "en", "b")]
SCHEMA = "doc_id long, text string, lang string, source string"
OPERATORS = {
    "exact_dedup": exact_dedup.exact_dedup,
    "secrets": secrets.find_secrets,
    "mixing": mixing.mix,
    "ngram_join": ngram_join.ngram_join,
    "pii": pii.find_pii,
    "langid": langid.identify,
    "fingerprint": fingerprint.fingerprint,
    "url_filter": lambda d: url_filter.filter_urls(d, "doc_id", "text"),
    "html_text": lambda d: html_text.extract_text(d, "doc_id", "lang", "text"),
}


def clashing(docs):
    return docs.withColumns({c: F.lit(c) for c in CLASHING})


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_a_row_for_each_row(spark, name):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = OPERATORS[name](clashing(docs)).collect()
    ids = [r["page_id"] if "page_id" in r else r["doc_id"] for r in got]
    assert sorted(ids, key=str) == sorted((r[0] for r in ROWS), key=str)
    again = OPERATORS[name](docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))  # other columns and partitions don't matter


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_nothing_in_nothing_out(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


def test_packing(spark):
    docs = clashing(spark.createDataFrame(ROWS, SCHEMA))
    got = packing.pack(docs).collect()
    assert sum(r.start == 0 for r in got) == len(ROWS) and packing.pack(docs.limit(0)).count() == 0


def test_every_column_null(spark):
    docs = spark.createDataFrame([(None, None, None, None)] * 3, SCHEMA)
    for f in OPERATORS.values():
        assert f(docs).count() == 3
    assert packing.pack(docs).count() == 3


def test_defined_results(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    lang = [(r.doc_id, r.lang_pred, r.accepted) for r in langid.identify(docs).collect() if r.doc_id in (2, 3, 5)]
    assert sorted(lang) == [(2, "und", False), (3, "und", False), (5, "und", False)]
    none = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score, r.accepted) for r in none} == {("und", 0.0, False)}
    near = {(r.doc_id, r.class_id, r.class_size) for r in ngram_join.ngram_join(docs).collect()}
    assert {(1, 1, 3), (7, 1, 3), (2, 2, 3), (3, 2, 3), (None, 2, 3)} <= near
    assert sum(r.kept for r in ngram_join.ngram_join(docs).collect()) == len({c for _, c, _ in near})
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 0})


def test_rows_of_keeps_columns(spark):
    docs = clashing(spark.createDataFrame(ROWS, SCHEMA))
    kept = rows_of(docs, exact_dedup.exact_dedup(docs, keys=True))
    assert kept.columns == docs.columns and sorted((r.doc_id, (r.text or "")[:5]) for r in kept.collect() if r.doc_id) == [(1, "the c"), (2, ""), (4, "word "), (5, "12345"), (6, "\ud7ff\U0001f600 é")]


def test_stages_on_odd_tables(spark):
    docs = clashing(spark.createDataFrame(ROWS, SCHEMA))
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, "")
            out.collect()
            assert name == "packing" or out.columns == docs.columns
