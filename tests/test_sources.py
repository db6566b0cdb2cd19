"""Shards, downloads, Avro files, and the round trip of a corpus through its index."""

from __future__ import annotations

import gzip
import io

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpuskit.functions.lines import lines
from corpuskit.plans import corpus
from corpuskit.schema import SHARD_RESULT, BadInput
from corpuskit.sources import avro, download, wet, writers
from corpuskit.sources.blocklist import read_blocklist
from corpuskit.streaming import corpus as streaming


def record(rid: str, body: str, url: str = "http://a.example.org/") -> bytes:
    raw = body.encode()
    return f"WARC/1.0\r\nWARC-Type: conversion\r\nWARC-Record-ID: {rid}\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(raw)}\r\n\r\n".encode() + raw + b"\r\n\r\n"


def prose(k: int) -> str:
    en = f"the cat and the dog of number {k} went to the house with that bird, for this is what was said of the day by the river"
    de = f"der Hund und die Katze von Nummer {k} sind nicht mit dem Vogel auf das Haus, und das ist was sich der Fluss nicht denkt, und die Leute"
    return "\n".join(["menu", *([en, de][k % 2] for _ in range(6)), "bye"])


@pytest.fixture
def shard_dir(tmp_path):
    folder = tmp_path / "shards"
    folder.mkdir()
    for s in range(3):
        with open(folder / f"{s}.txt.gz", "wb") as f:  # a gzip member for each record
            f.write(gzip.compress(b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: info\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"))
            for k in range(4):
                f.write(gzip.compress(record(f"<{s}-{k}>", prose(s + k))))
    (folder / "notes.txt").write_text("no shard")
    (folder / "more").mkdir()
    return str(folder)


def test_records():
    raw = record("a", "körper\r\n\r\n") + b"rubbish\nmore\n" + record("b", "") + b"WARC/1.0\r\nno length: 1\r\n\r\nxx\n" + record("c", "z")
    got = [(h.get("warc-record-id"), b.decode(), e) for h, b, e in wet.records(io.BytesIO(raw))]
    assert [g[0] for g in got] == ["a", None, "b", None, "c"]
    assert got[0][1:] == ("körper\r\n\r\n", None) and got[1][2] and got[2][1:] == ("", None) and got[3][2] == "no content length"
    (last,) = wet.records(io.BytesIO(record("a", "cut")[:-5]))
    assert last[2] == "the body ends early"


def test_shard_numbers(spark):
    assert wet.shard_number("/x/12.txt.gz") == 12 and wet.shard_number("7") == 7
    with pytest.raises(BadInput):
        wet.shard_number("/x/a1.txt.gz")
    rows = spark.createDataFrame([("12.txt.gz",), ("7",), ("a1.gz",), ("1a.gz",), (None,)], "n string")
    assert [r[0] for r in rows.select(wet.shard_number_of(F.col("n"))).collect()] == [12, 7, None, None, None]


def test_wet(spark, shard_dir):
    rows = wet.read_wet(spark, shard_dir)
    got = rows.orderBy("shard_id", "loc_in_shard").collect()
    assert len(got) == 15 and [r.loc_in_shard for r in got[:5]] == [0, 1, 2, 3, 4]
    assert got[1].record_id == "<0-0>" and got[1].body == prose(0) and got[1].warc_headers["warc-target-uri"] == "http://a.example.org/"
    only = rows.where("shard_id = 2")
    assert only.count() == 5 and only.rdd.getNumPartitions() == 1  # the filter reaches the reader
    with pytest.raises(PySparkException):
        wet.read_wet(spark, shard_dir, mode="FAILFAST").count()


@pytest.mark.parametrize("length", ["\u00b2", "9" * 17, "9" * 40, "-1", ""])
def test_wet_odd_lengths(spark, tmp_path, length):
    bad = f"WARC/1.0\r\nContent-Length: {length}\r\n\r\n".encode()
    for n, raw in ((1, record("a", "x") + bad), (2, bad)):
        (tmp_path / f"{n}.txt").write_bytes(raw)
    got = wet.read_wet(spark, str(tmp_path), compression="none").collect()
    assert len(got) == 3 and [bool(r.error) for r in sorted(got, key=lambda r: (r.shard_id, r.loc_in_shard))] == [False, True, True]


def test_wet_broken_archive(spark, tmp_path):
    whole = gzip.compress(record("a", "x" * 1000)) + gzip.compress(record("b", "y" * 1000))
    (tmp_path / "1.txt.gz").write_bytes(whole[:-12])
    (tmp_path / "2.txt.gz").write_bytes(gzip.compress(record("c", "z")))
    got = wet.read_wet(spark, str(tmp_path)).collect()
    assert {r.record_id for r in got if r.error is None} >= {"a", "c"} and any(r.error for r in got)
    assert all(r.error is None for r in wet.read_wet(spark, str(tmp_path), mode="DROPMALFORMED").collect())
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain/3.txt").write_bytes(record("d", "w"))
    assert [r.record_id for r in wet.read_wet(spark, str(tmp_path / "plain"), compression="none").collect()] == ["d"]


def test_round_trip(spark, shard_dir, tmp_path):
    listed = tmp_path / "lists/adult"
    listed.mkdir(parents=True)
    (listed / "domains").write_text("a.example.org\n\n")
    (listed / "urls").write_text("b.example.org/x\n")
    blocklist = read_blocklist(spark, str(tmp_path / "lists"))
    assert sorted(tuple(r) for r in blocklist.collect()) == [("domain", "a.example.org", "adult"), ("url", "b.example.org/x", "adult")]
    target = str(tmp_path / "corpus")
    counts = corpus.run(spark, shard_dir, target, blocklist=blocklist)
    assert counts == {"records": 15, "unreadable": wet.read_wet(spark, shard_dir).where("error is not null").count(), "documents": 12}
    assert sum(r.documents for r in spark.read.parquet(f"{target}/counts").collect()) == 12
    docs = writers.read_documents(spark, f"{target}/documents")
    rows = docs.select("lang", "content", "metadata.*").collect()
    assert len(rows) == 12 and {r.lang for r in rows} == {"de", "en"}
    assert all(r.content == "\n".join(prose(0 if r.lang == "en" else 1).split("\n")[1:-1]).replace("number 0", r.content[r.content.find("number") :].split(" went")[0]).replace("Nummer 1", r.content[r.content.find("Nummer") :].split(" sind")[0]) for r in rows)
    assert all(r.categories == ["adult"] and r.tlsh.startswith("tlsh:") and len(r.sentence_identifications) == 6 for r in rows)
    assert corpus.run_rebuild(spark, f"{target}/rebuild", shard_dir, f"{target}/again").count() == 0
    key = lambda d: sorted((r.lang, r.content, r.metadata.tlsh) for r in d.collect())
    assert key(writers.read_documents(spark, f"{target}/again")) == key(docs)
    # the same through files of one language each
    files = writers.export_jsonl(f"{target}/documents", str(tmp_path / "jsonl"))
    assert [f.rsplit("/", 1)[1] for f in files] == ["de_meta.jsonl", "en_meta.jsonl"]
    assert writers.read_documents(spark, files[1]).count() == 6
    exported = writers.export_avro(spark, f"{target}/rebuild", str(tmp_path / "avro"))
    assert [f.rsplit("/", 1)[1] for f in exported] == ["de.avro", "en.avro"]
    corpus.run_rebuild(spark, exported[1], shard_dir, f"{target}/english")
    assert key(writers.read_documents(spark, f"{target}/english")) == [k for k in key(docs) if k[0] == "en"]
    assert sum(len(r.rebuild_info) for r in writers.read_index(spark, exported[0]).collect()) == 6
    assert sorted((r.lang, r.shard_id) for r in writers.read_index(spark, str(tmp_path / "avro")).collect()) == sorted((r.lang, r.shard_id) for r in writers.read_index(spark, f"{target}/rebuild").collect())
    # a shard that isn't there is an error, one that ends early is reported
    part = tmp_path / "part"
    part.mkdir()
    shards = wet.shards(shard_dir)
    for p in shards[1:]:
        (part / p.rsplit("/", 1)[1]).write_bytes(open(p, "rb").read())
    with pytest.raises(BadInput, match="aren't there"):
        corpus.run_rebuild(spark, f"{target}/rebuild", str(part), f"{target}/none")
    (part / shards[0].rsplit("/", 1)[1]).write_bytes(gzip.compress(gzip.open(shards[0]).read()[:400]))
    wrong = corpus.run_rebuild(spark, f"{target}/rebuild", str(part), f"{target}/early").collect()
    assert {r.shard_id for r in wrong} == {wet.shard_number(shards[0])} and all(r.documents < r.wanted for r in wrong)


def test_plan_ignores_partitions(spark, shard_dir):
    rows = wet.read_wet(spark, shard_dir)
    once = sorted((r.record_id, r.content, r.line_start, r.line_end) for r in corpus.documents(rows, with_tlsh=False).collect())
    again = sorted((r.record_id, r.content, r.line_start, r.line_end) for r in corpus.documents(rows.repartition(7), with_tlsh=False).collect())
    assert once == again and len(once) == 12
    assert corpus.documents(rows.where("false")).count() == 0


def test_plan_drops(spark):
    en = "the cat and the dog of the house went to the river with that bird for this is the day " * 2
    bodies = {"short": "a\nb", "none": "zzz " * 60, "ok": "\n".join([en] * 6), "mixed": "\n".join([en] * 6 + [prose(1).split("\n")[1]] * 6), "failed": en}
    rows = spark.createDataFrame([(1, k, n, {}, b, "bad" if n == "failed" else None) for k, (n, b) in enumerate(bodies.items())], wet.RECORD)
    got = {r.record_id: r.lang for r in corpus.documents(rows).collect()}
    assert got == {"ok": "en", "mixed": "multi"}


@pytest.mark.parametrize("codec", ["null", "deflate", "snappy"])
def test_avro(tmp_path, codec):
    metadata = {"identification": {"label": "en", "prob": 0.5}, "harmful_pp": None, "tlsh": "tlsh:T1", "quality_warnings": ["tiny"], "categories": None, "sentence_identifications": [None, {"label": "fr", "prob": 1.0}]}
    rows = [{"shard_id": s, "rebuild_info": [{"shard_id": s, "record_id": f"ü{k}", "line_start": 0, "line_end": 1 << 40, "loc_in_shard": -k, "metadata": metadata} for k in range(s)]} for s in range(150)]
    path = str(tmp_path / "en.avro")
    assert avro.write(path, rows, codec=codec) == 150 and list(avro.read(path)) == rows
    with pytest.raises(BadInput):
        list(avro.read(str(tmp_path)))
    assert [f.name for f in SHARD_RESULT.fields] == [f["name"] for f in avro.SCHEMA["fields"]]


def test_download(spark, tmp_path):
    (tmp_path / "src").mkdir()
    for k in range(3):
        (tmp_path / f"src/{k}.gz").write_bytes(b"%d" % k)
    (tmp_path / "paths").write_text("src/0.gz\n\nsrc/1.gz\r\nsrc/none.gz\nsrc/2.gz\n")
    urls = download.read_paths(spark, str(tmp_path / "paths"), f"file://{tmp_path}/")
    assert [(r.idx, r.path) for r in urls.orderBy("idx").collect()] == [(0, "src/0.gz"), (1, "src/1.gz"), (2, "src/none.gz"), (3, "src/2.gz")]
    out = tmp_path / "out"
    got = {r.idx: r.error for r in download.download(urls, str(out), 2, offset=1).collect()}
    assert got[1] is None and got[3] is None and got[2] and 0 not in got
    assert sorted(p.name for p in out.iterdir()) == ["1.txt.gz", "3.txt.gz"] and (out / "3.txt.gz").read_bytes() == b"2"
    rows = spark.createDataFrame([(1, "u", True), (2, "v", False)], "idx long, url string, http boolean")
    assert [r.value for r in download.error_log(rows).collect()] == ["u\t1"]


def test_stream(spark, shard_dir, tmp_path):
    wet.read_wet(spark, shard_dir).write.parquet(str(tmp_path / "in"))
    docs = streaming.document_stream(streaming.record_stream(spark, str(tmp_path / "in"), files=1), with_tlsh=False)
    for _ in range(2):  # a second start finds nothing new
        streaming.write_stream(docs, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.json(str(tmp_path / "out/*/*")).count() == 12
    stream = spark.readStream.schema(wet.RECORD).parquet(str(tmp_path / "in"))
    q = streaming.running_word_counts(stream, "body").writeStream.format("memory").queryName("words").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    static = wet.read_wet(spark, shard_dir).select(F.explode(lines(F.col("body"))).alias("l")).where("l = 'menu'").count()
    assert spark.table("words").where("word = 'menu'").first()["count"] == static
