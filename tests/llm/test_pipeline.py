"""run() against the stages in plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from corpuskit.llm import langid, mixing, packing
from tests.llm.test_brute_force import brute_classes, prose


def test_run(spark, tmp_path):
    rng = random.Random(15)
    rows = []
    for k in range(120):
        text = prose(rng, rng.randint(5, 90))
        rows.append((text, "xx", rng.choice("abc")))
        if k % 6 == 0:
            rows.append((text.replace(" ", "\n"), "xx", "a"))
        if k % 7 == 0:
            words = text.split(" ")
            words[len(words) // 2] = "changed"
            rows.append((" ".join(words), "xx", "b"))
    rows += [("1234 5678", "xx", "c"), (None, None, "a"), ("Это совсем другой язык, и его никто не учил", None, "b")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(k, *r, len(r[0] or "")) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    table = {k: r for k, r in enumerate(rows)}
    model = langid.fit(docs)
    table = {k: r for k, r in table.items() if model.predict([r[0]])[0][2]}
    assert len(rows) - 8 <= len(table) <= len(rows) - 3
    seen: dict[str, int] = {}
    for k in sorted(table):
        seen.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", table[k][0]), k)
    table = {k: table[k] for k in sorted(seen.values())}
    keys = list(table)
    classes, _ = brute_classes([(k, table[k][0]) for k in keys], 3, 0.5)
    table = {keys[c]: table[keys[c]] for c in sorted(set(classes))}
    words = packing.WordTokenizer()
    want = sorted((k, words.ids(r[0]) + b"\1\0\0\0") for k, r in table.items())
    pieces: dict[int, list] = {}
    for r in sorted(got, key=lambda r: r.start):
        pieces.setdefault(r.doc_id, []).append(bytes(r.ids))
    assert sorted((k, b"".join(p)) for k, p in pieces.items()) == want
    # what mixing orders is that order
    order = [r.doc_id for r in mixing.mixed_rows(docs.where(F.col("doc_id").isin(*table)), 4).collect()]
    placed = {r.doc_id: (r.slot, r.at) for r in mixing.mix(docs.where(F.col("doc_id").isin(*table))).collect()}
    assert order == sorted(table, key=placed.get)
    assert np.array([r.length & (r.length - 1) == 0 for r in got]).all()
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_join", "mixing", "packing"]


def test_sequences_follow_the_mixed_order(spark, tmp_path, monkeypatch):
    """sequence_id of run()'s own rows follows the schedule, through what is written between the stages."""
    monkeypatch.setattr(mixing.mix, "__defaults__", tuple(300 if x == mixing.BLOCK_CHARS else x for x in mixing.mix.__defaults__))
    monkeypatch.setattr(mixing, "BLOCK_CHARS", 300)
    rng = random.Random(16)
    rows = [(prose(rng, 1 << rng.randint(3, 7)), "xx", "src0" if k % 2 else "src3") for k in range(400)]
    rows.sort(key=lambda r: len(r[0]))  # partitions of unequal size
    docs = spark.createDataFrame([(k, *r, len(r[0])) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept: dict[str, list] = {}
    stages = [(n, lambda s, d, p, f=f, n=n: kept.setdefault(n, []).append(d) or f(s, d, p)) for n, f in corpus_pipeline.STAGES]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    got = sorted(corpus_pipeline.run(spark, str(tmp_path)).select("sequence_id", "doc_id", "start").collect(), key=lambda r: r.sequence_id)
    place = {r.doc_id: (r.slot, r.at) for r in mixing.mix(kept["mixing"][0]).collect()}
    assert [(r.doc_id, r.start) for r in got] == sorted(((r.doc_id, r.start) for r in got), key=lambda x: (place[x[0]], x[1]))
    order = list(dict.fromkeys(r.doc_id for r in got))
    chars = {"src0": 0, "src3": 0}
    longest = max(len(r[0]) for r in rows)
    for k in order:
        chars[rows[k][2]] += len(rows[k][0])
        if chars["src0"] > 0.9 * sum(len(r[0]) for r in (rows[i] for i in order) if r[2] == "src0"):
            break
        # 6 to 2, to within a block and a document of each source
        assert abs(chars["src0"] - 3 * chars["src3"]) <= 4 * (300 + longest)
