"""Vectors for each operator: the shape of a document, and what must come of it."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpuskit.functions import arpa, tags
from corpuskit.functions import tlsh as hashing
from corpuskit.functions.lines import lines
from corpuskit.functions.tlsh import tlsh, tlsh_hash
from corpuskit.functions.words import break_words, spaced_pieces, unicode_words
from corpuskit.operators import annotate, filters, identify, multilingual, package, rebuild, transforms, zipf
from corpuskit.plans.queries import queries
from corpuskit.schema import BadInput, IncompleteLocation

LONG, SHORT = "x" * 150, "y" * 20


def of(spark, texts, *columns):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, text string")
    return [tuple(r)[1:] for r in rows.select("k", *columns).orderBy("k").collect()]


def test_lines(spark):
    texts = ["", "a", "a\n", "a\n\n", "\n", "a\r\nb", "a\r\r\nb\r"]
    assert [r[0] for r in of(spark, texts, lines(F.col("text")))] == [[], ["a"], ["a"], ["a", ""], [""], ["a", "b"], ["a\r", "b\r"]]


def test_length(spark):
    assert of(spark, ["a" * n for n in (99, 100, 101)], filters.Length()(F.col("text"))) == [(False,), (False,), (True,)]


def test_mean_length_frozen(spark):
    rng = random.Random(3)
    rows = spark.createDataFrame([(max(0, round(rng.gauss(100, 10))),) for _ in range(5000)], "n long")
    f = filters.MeanLength.fit(rows, "n")
    assert [r[0] for r in spark.createDataFrame([(105,), (130,), (80,)], "n long").select(f(F.col("n"))).collect()] == [True, False, False]


def test_mean_length_of_nothing(spark):
    assert filters.MeanLength.fit(spark.createDataFrame([], "n long"), "n") == filters.MeanLength(0.0, 0.0)


def test_mean_length_running_is_the_fold(spark):
    lengths = [10, 12, 50, 11, 0, 10, 90, 12]
    rows = spark.createDataFrame([(1, k, n) for k, n in enumerate(lengths)], "d long, p long, n long")
    got = [r["near"] for r in filters.mean_length_running(rows, F.col("n"), ["d"], ["p"]).orderBy("p").collect()]
    want, n, s, q = [], 0, 0.0, 0.0
    for x in lengths:
        n, s, q = n + 1, s + x, q + x * x
        want.append(abs(x - s / n) < max(0.0, q / n - (s / n) ** 2) ** 0.5)
    assert got == want


def test_long_share(spark):
    texts = ["\n".join([SHORT] * 20 + [LONG]), "\n".join([SHORT] * 2 + [LONG * 3] * 2), "", "z" * 100]
    assert of(spark, texts, filters.LongShare()(lines(F.col("text")))) == [(False,), (True,), (True,), (True,)]


def test_trim(spark):
    texts = ["\n".join([SHORT] * 4 + [LONG, SHORT, LONG, LONG] + [SHORT] * 3), "\n".join([SHORT] * 5), "", LONG + "\r\n" + LONG + "\r\n"]
    content, bounds = transforms.trim_short(F.col("text"))
    got = of(spark, texts, content, bounds["start"], bounds["end"])
    assert got == [("\n".join([LONG, SHORT, LONG, LONG]), 4, 7), ("", None, None), ("", None, None), (LONG + "\n" + LONG, 0, 1)]
    both = of(spark, texts, transforms.trimmed(F.col("text")).alias("x"))
    assert [(x.content, x.kept and x.kept.start, x.kept and x.kept.end) for (x,) in both] == got


@pytest.mark.parametrize("size", [1, 4, 5])
def test_trim_by_mean(spark, size):
    rng = random.Random(5)
    docs = [[rng.choice([1, 30, 100, 140, 400]) for _ in range(rng.randint(1, 14))] for _ in range(30)]
    texts = ["\n".join("a" * n for n in d) for d in docs] + [""]
    content, bounds = transforms.trim_by_mean(F.col("text"), size)
    got = of(spark, texts, content, bounds["start"], bounds["end"])
    for d, text, (c, a, b) in zip(docs, texts, got):
        padded = [d[0]] * (size // 2) + d + [d[-1]] * (size // 2)
        good = [i for i in range(len(d)) if sum(padded[i : i + size]) / size >= 100]
        assert (a, b) == ((good[0], good[-1]) if good else (None, None))
        assert c == ("\n".join(text.split("\n")[a : b + 1]) if good else text)
    assert got[-1] == ("", None, None)


def test_tiny_short_noisy(spark):
    texts = ["a\nb", "\n".join("abcde"), "\n".join([SHORT] * 3 + [LONG] * 5), "\n".join([SHORT] * 5 + [LONG] * 3), "////", "a word of prose and another", "മലയാളം മലയാളം", ""]
    t = F.col("text")
    got = of(spark, texts, *annotate.tiny(t), *annotate.short_sentences(t), *annotate.noisy(t))
    assert [g[0] for g in got] == ["tiny", None, None, None, "tiny", "tiny", "tiny", "tiny"]
    assert got[2][1] is None and got[3][1] == "short_sentences"
    assert [g[2] for g in got[4:]] == ["noisy", None, None, None]


@pytest.mark.parametrize(("shape", "want"), [("lssssssssllllllllll", "header"), ("lllllllllllllllssss", "footer"), ("sssslllllllllllssss", "header,footer"), ("s", ""), ("l", ""), ("llllll", "")])
def test_header_footer(spark, shape, want):
    text = "\n".join(LONG if c == "l" else SHORT for c in shape)
    assert of(spark, [text], F.concat_ws(",", *annotate.header_footer(F.col("text")))) == [(want,)]


def test_warnings_keep_their_order_and_are_null_without_any(spark):
    assert of(spark, ["/\n/", "\n".join(["prose " * 30] * 9)], annotate.warnings(F.col("text"))) == [(["tiny", "short_sentences", "noisy"],), (None,)]


def test_noisy_and_tiny(spark):
    rows = spark.createDataFrame([(["tiny", "short_sentences", "noisy"],), (["noisy", "tiny"],), (["tiny"],), (None,)], "w array<string>")
    assert [tuple(r) for r in rows.select(filters.noisy_and_tiny(F.col("w")), filters.exactly_noisy_tiny(F.col("w"))).collect()] == [(True, False), (True, True), (False, False), (False, False)]


def test_categories(spark):
    rows = spark.createDataFrame([(1, "http://a.example.org/x"), (2, "https://b.example.org/y?z=1"), (3, "http://c.d.example.com/"), (4, None), (5, "no url"), (1, "http://a.example.org/x")], "id long, url string")
    listed = spark.createDataFrame([("domain", "a.example.org", "adult"), ("domain", "a.example.org", "games"), ("url", "b.example.org/y?z=1", "press"), ("domain", "example.com", "shop"), ("domain", None, "none")], "kind string, value string, category string")
    got = sorted((r.id, r.categories) for r in annotate.categories(rows, "url", listed).collect())
    assert got == [(1, ["adult", "games"]), (1, ["adult", "games"]), (2, ["press"]), (3, None), (4, None), (5, None)]
    deep = {r.id: r.categories for r in annotate.categories(rows, "url", listed, parent_domains=True).collect()}
    assert deep == {1: ["adult", "games"], 2: ["press"], 3: ["shop"], 4: None, 5: None}


def test_blocklist_kind(spark):
    got = of(spark, ["http://a.example.org/x", "http://b.example.org/y", "http://c.example.org/", None, "::"], annotate.blocklist_kind(F.col("text"), ["a.example.org"], ["http://b.example.org/y"], "adult"))
    assert got == [("adult",), ("adult",), (None,), (None,), (None,)]


def test_tlsh(spark):
    mixed = "".join(chr(33 + k * 7 % 90) for k in range(70))
    a, b, c, d = (r[0] for r in of(spark, [mixed, mixed, "o" * 50, "a"], tlsh_hash(F.col("text"))))
    assert a == b and a.startswith("tlsh:T1") and len(a) == len("tlsh:T1") + 138 and c is None and d is None
    assert of(spark, [None, ""], tlsh_hash(F.col("text"))) == [(None,), (None,)]


def test_tlsh_tells_near_from_far():
    rng = random.Random(1)
    text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta"]) for _ in range(400))
    near, far = tlsh((text + " omega").encode()), tlsh(bytes(rng.randrange(256) for _ in range(2400)))
    differ = lambda x, y: sum(p != q for p, q in zip(x, y))
    own = tlsh(text.encode())
    assert differ(own, near) < differ(own, far) / 2


def test_tags(spark):
    labels = ["__label__en", "__label__eng", "__label__fra_Latn", "__label__eml", "__label__als", "en", "__label__zho_Hans", "__label__", "__label__ no"]
    t = F.col("text")
    got = of(spark, labels, tags.fixed(t), tags.parsed(t), tags.normalised(t))
    assert [g[0] for g in got] == ["en", "en", "fra-Latn", "x-eml", "gsw", "en", "zh-Hans", "", " no"]
    assert [g[1] for g in got][-2:] == [None, None]
    assert got[2][2] == "fra-Latn" and got[6][2] == "zho-Hans"
    assert of(spark, ["__label__ZH_hANS_cn"], tags.normalised(t)) == [("zh-Hans-CN",)]


def test_words():
    assert break_words("foo/bar.\nFoo baz") == ["foo", "bar", "foo", "baz"]
    assert sorted(break_words("第一條 人人")) == sorted("第一條人人")


def ids(spark, spec):
    """Rows of 'en*6 fr*4 -*2 de~1' as identifications; ~ is improbable."""
    out = []
    for s in spec:
        row = []
        for part in s.split():
            label, n = part.replace("~", "*").split("*")
            row += [None if label == "-" else (label, 0.5 if "~" in part else 0.9)] * int(n)
        out.append((len(out), row, [10] * len(row)))
    return spark.createDataFrame(out, "k long, ids array<struct<label:string,prob:float>>, sizes array<long>")


def test_strict_multilingual(spark):
    spec = ["en*6 fr*6", "en*10 fr*2", "en*1 fr*1", "en~6 fr~6", "en*6 fr*6 -*2", "en*5 fr*5 -*5", "en*12", "a*2 b*2 c*2 d*2 e*2 f*2", "en*5 fr*5 -*2"]
    rows = ids(spark, spec).orderBy("k")
    got = [tuple(r) for r in rows.select(multilingual.strict_lines(F.col("ids")), multilingual.strict_bytes(F.col("ids"), F.col("sizes"))).collect()]
    assert [g[0] for g in got] == [True, False, False, False, True, False, False, False, True]
    # the unidentified part always counts, so the even share of bytes is lower
    assert [g[1] for g in got] == [True, False, False, False, True, False, False, False, True]


def test_ratio_multilingual(spark):
    spec = ["en*10", "en*10 fr*10", "en*8 fr*2", "en*8 fr*3", "-*9 en*2 fr*2", "en*5"]
    assert [r[0] for r in ids(spark, spec).orderBy("k").select(multilingual.ratio(F.col("ids"))).collect()] == [False, True, False, True, False, False]


def test_vote(spark):
    rows = spark.createDataFrame([(1, [("en", 0.9), None, ("fr", 0.8)], [50, 50, 10]), (2, [None], [5]), (3, [], []), (4, [("fr", 1.0), ("en", 1.0)], [4, 4])], "k long, ids array<struct<label:string,prob:float>>, sizes array<long>")
    found = identify.bins(F.col("ids"), F.col("sizes"))
    got = {r.k: (r.v and (r.v.label, r.v.bytes, round(r.v.conf, 4)), r.d and r.d.label) for r in rows.select("k", identify.vote(found).alias("v"), identify.document_identification(found, F.lit(False)).alias("d")).collect()}
    assert got == {1: (("en", 50, 0.4091), None), 2: ((None, 5, 1.0), None), 3: (None, None), 4: (("en", 4, 0.5), None)}


def test_lexicon(spark):
    got = of(spark, ["the cat and the dog\nder Hund und die Katze\nzzz\nthe und", None], identify.LexiconIdentifier().identify(lines(F.col("text"))))
    assert [x and x.label for x in got[0][0]] == ["en", "de", None, None]


def test_fasttext_builder():
    with pytest.raises(ValueError, match="path"):
        identify.FastTextIdentifier.build(k=1, threshold=0.8)
    assert identify.FastTextIdentifier.build_or_default().path == "lid.208a.bin"


def test_zipf(spark):
    rows = spark.createDataFrame([("foo/bar. baz\nbar baz baz",), ("quux quux quux quux hello",), (None,), ("",)], "text string")
    counts = zipf.word_counts(rows)
    assert {r.word: r["count"] for r in counts.collect()} == {"foo": 1, "bar": 2, "baz": 3, "quux": 4, "hello": 1}
    ranked = zipf.ranking(counts).orderBy("rank").collect()
    assert [(r["rank"], r["count"]) for r in ranked] == [(1, 4), (2, 3), (3, 2), (4, 1), (5, 1)]
    constants = [r["constant"] for r in ranked]
    stats = zipf.statistics(counts).first()
    mean = sum(constants) / 5
    assert stats.words == 5 and stats.total == 11
    assert stats["mean"] == pytest.approx(mean) and stats.sigma == pytest.approx((sum((c - mean) ** 2 for c in constants) / 5) ** 0.5)
    assert zipf.ranking(counts.where("false")).count() == 0


def test_words_without_a_look_at_each_place(spark):
    """The quick ways give the pieces between boundaries, also of the texts parted at spaces."""
    import regex

    slow = lambda t: [w.lower() for w in regex.split(r"(?V1w)\b", t) if w and regex.search(r"[\p{L}\p{N}]", w)]
    rng = random.Random(7)
    kinds = ["abcXYZ", "éÀßñ", "0123", "__", ":.'’‘·", ",;.'", " \n\r\t", '-"“!@', "\u0301\u00ad\u200d", "אב", "カナー", "字ひ", "²½", "\U0001f1e6\U0001f1e7", "👍\U0001f3fb", "ﾞ", "İΣς", "\u2028\u2009"]
    texts = ["".join(rng.choice(rng.choice(kinds[: rng.choice((1, 4, 8, 18))])) for _ in range(rng.randrange(1, 16))) for _ in range(3000)]
    texts += ["l'avion d'été, can't 'a 3.14 1,000 a_b ___ x:y", "a  \u0308b", " ﾞa", "🇴b 🇴 b", "Ὀδυσσεύς ΣΟΦΟΣ", "", " ", "\n"]
    want = [slow(t) for t in texts]
    assert [break_words(t) for t in texts] == want
    assert [[w for p in r[0] for w in break_words(p)] for r in of(spark, texts, spaced_pieces(F.col("text")))] == want
    attached = regex.findall(r"[\p{WB=Extend}\p{WB=Format}\p{WB=ZWJ}]", "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000))
    ((whole,),) = of(spark, ["".join(f" {c}" for c in attached)], spaced_pieces(F.col("text")))
    assert len(whole) == 1


def test_unicode_counts_break_each_piece_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "foo's 3.14,\nbar FOO'S " * 2000), (2, None), (3, ""), (4, "bar\r\n\u0301x")], "doc_id long, text string")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    counts = queries()["zipf_unicode_counts"](spark, str(tmp_path))
    assert {r.word: r["count"] for r in counts.collect()} == {"foo's": 4000, "3.14": 2000, "bar": 2001, "x": 1}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("EvalPython") < plan.index("Aggregate [piece")  # what Python sees are distinct pieces
    assert counts.collect() and sorted(counts.collect()) == sorted(zipf.word_counts(rows, words=unicode_words).collect())


def test_locations():
    whole = {"shard_id": 1, "record_id": "a", "line_start": 0, "line_end": 3, "loc_in_shard": 4}
    assert rebuild.checked_location(**whole) == whole
    with pytest.raises(IncompleteLocation, match="line_end"):
        rebuild.checked_location(**(whole | {"line_end": None}))


def test_index_sorts_by_place(spark):
    rows = spark.createDataFrame([("en", 1, str(k), 0, 1, k, ("t",)) for k in (3, 0, 4)], "lang string, shard_id long, record_id string, line_start long, line_end long, loc_in_shard long, metadata struct<tlsh:string>")
    (r,) = rebuild.index(rows).collect()
    assert [x.loc_in_shard for x in r.rebuild_info] == [0, 3, 4]


def test_rebuild_ends_before_the_first_mismatch(spark):
    records = spark.createDataFrame([(1, k, f"r{k}", {"content-length": "0"}, f"a{k}\nb{k}\nc{k}", None) for k in range(5)], "shard_id long, loc_in_shard long, record_id string, warc_headers map<string,string>, body string, error string")
    entry = lambda k, rid=None: (1, rid or f"r{k}", 1, 2, k, ("t",))
    schema = "lang string, shard_id long, rebuild_info array<struct<shard_id:long,record_id:string,line_start:long,line_end:long,loc_in_shard:long,metadata:struct<tlsh:string>>>"
    cases = {"good": [entry(0), entry(3)], "wrong": [entry(0), entry(1, "x"), entry(2)], "unordered": [entry(2), entry(1)], "beyond": [entry(4), entry(9)]}
    docs = rebuild.rebuilt(spark.createDataFrame([(k, 1, v) for k, v in cases.items()], schema), records).collect()
    assert sorted((d.lang, d.loc_in_shard) for d in docs) == [("beyond", 4), ("good", 0), ("good", 3), ("unordered", 2), ("wrong", 0)]
    assert all(d.content == f"b{d.loc_in_shard}\nc{d.loc_in_shard}" and d.warc_headers["content-length"] == "5" for d in docs)


def test_perplexity(spark):
    model = arpa.LanguageModel.parse(arpa.estimate(["the cat sat on the mat", "the dog sat"]))
    assert model.perplexity("the cat sat") < model.perplexity("mat the the dog") < 1e3
    # by hand: a unigram model with back-off
    text = "\\data\\\nngram 1=4\nngram 2=1\n\n\\1-grams:\n-1.0\ta\t-0.5\n-2.0\t<unk>\n-99\t<s>\t-0.25\n-0.5\t</s>\n\n\\2-grams:\n-0.1\ta a\n\n\\end\\\n"
    m = arpa.LanguageModel.parse(text)
    assert m.perplexity("a a b") == pytest.approx(10 ** ((0.25 + 1.0 + 0.1 + 0.5 + 2.0 + 0.5) / 4))
    assert of(spark, ["a a\nb", None], arpa.perplexity(F.col("text"), F.lit("en"), {"en": m})) == [(pytest.approx(m.perplexity("a a b"), rel=1e-5),), (None,)]
    assert of(spark, ["a"], arpa.perplexity(F.col("text"), F.lit("xx"), {"en": m})) == [(None,)]


def test_models_in(tmp_path):
    for n in ("en.arpa", "fr.arpa", "fr.binary", "de.binary", "not a tag.arpa", "readme.txt"):
        (tmp_path / n).write_text("")
    assert {k: v.rsplit("/", 1)[1] for k, v in arpa.models_in(str(tmp_path)).items()} == {"en": "en.arpa", "fr": "fr.arpa", "de": "de.binary"}


def test_a_readable_model_beside_a_compiled_one(spark, tmp_path, monkeypatch):
    texts = {"en": "the cat", "fr": "le chat", "de": "der hund"}
    for lang, t in texts.items():
        (tmp_path / f"{lang}.arpa").write_text(arpa.estimate([t]))
        (tmp_path / f"{lang}.binary").write_bytes(b"\0")
    models = arpa.models_in(str(tmp_path))
    rows = spark.createDataFrame([(lang, texts[lang]) for lang in list(texts) * 4] + [("xx", "a"), ("en", None)], "lang string, text string")
    got = [r[0] for r in rows.coalesce(1).select(arpa.perplexity(F.col("text"), F.col("lang"), models)).collect()]
    assert got[:3] * 4 == got[:12] and all(got[:12]) and got[12:] == [None, None]
    monkeypatch.setattr(arpa, "KEPT_GRAMS", 0)  # one at a time
    assert [len(arpa._loaded) for m in models.values() if arpa.load(m)] == [1, 1, 1]
    with pytest.raises(BadInput):
        arpa.load(str(tmp_path / "en.binary"))


def test_hashes_in_step_are_those_of_each_text(monkeypatch):
    rng = random.Random(5)
    datas = [bytes(rng.choices(range(32, 127), k=rng.choice((0, 49, 50, 70, 400, 3000)))) for _ in range(90)]
    want = [tlsh(d) for d in datas]
    assert sum(w is None for w in want) < 60 and hashing.hashes(datas) == want
    for name, value in (("MOST_CELLS", 5000), ("AT_ONCE", 100), ("FEW", 2)):
        monkeypatch.setattr(hashing, name, value)
        assert hashing.hashes(datas) == want


def test_a_batch_of_texts_is_hashed_where_it_lies(monkeypatch):
    """What is held beside the Arrow batch is a fraction of it."""
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(6)
    texts = ["".join(rng.choices("abcdefghij éß字", k=2000)) for _ in range(400)]
    want = hashing.hashes([t.encode() for t in texts[:20]])
    odd = pa.array(["", None, *texts[:20], None, "a" * 60])
    given = [None, None, *[f"tlsh:{h}" for h in want], None, None]
    assert next(hashing.tlsh_hash.func(iter([odd]))).to_pylist() == given
    assert next(hashing.tlsh_hash.func(iter([odd.slice(1, 5)]))).to_pylist() == given[1:6]
    assert next(hashing.tlsh_hash.func(iter([pa.array(["", None], pa.large_string())]))).to_pylist() == [None, None]
    assert next(hashing.tlsh_hash.func(iter([pa.array([], pa.string())]))).to_pylist() == []
    monkeypatch.setattr(hashing, "MOST_CELLS", 1 << 17)
    batch = pa.array(texts)
    tracemalloc.start()
    got = next(hashing.tlsh_hash.func(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pylist()[:20] == given[2:22] and most < batch.nbytes * 3 / 4


def test_fasttext_with_a_double(spark, tmp_path):
    """A stand-in package: the label is a line's first word, the probability falls with its length."""
    (tmp_path / "fasttext.py").write_text(
        "class M:\n"
        "    def predict(self, rows, k, threshold):\n"
        "        every = [[(f'__label__{w}', 1 / (1 + j)) for j, w in enumerate(r.split()) if 1 / (1 + j) >= threshold][:k] for r in rows]\n"
        "        return [[a for a, _ in e] for e in every], [[p for _, p in e] for e in every]\n"
        "def load_model(path):\n"
        "    assert path == 'model.bin'\n"
        "    return M()\n"
    )
    spark.sparkContext.addPyFile(str(tmp_path / "fasttext.py"))
    rows = F.array(F.lit("eng x"), F.lit(""), F.lit("\0no-such-tag- b"))
    one = identify.FastTextIdentifier.build("model.bin", 1, 0.8)
    (r,) = spark.range(1).select(one.identify(rows).alias("raw"), identify.tagged(one.identify(rows)).alias("t")).collect()
    assert [(i.label, i.prob) if i else None for i in r.raw] == [("__label__eng", 1.0), None, ("__label__no-such-tag-", 1.0)] and not r.t.good
    top = identify.FastTextIdentifier("model.bin", 2, 0.3).identify_top(F.array(F.lit("eng fra deu"), F.lit("bad!tag spa")))
    (r,) = spark.range(1).select(top.alias("top")).collect()
    assert [[(i.label, i.prob) for i in x] for x in r.top] == [[("en", 1.0), ("fr", 0.5)], [("es", 0.5)]]
    with pytest.raises(ValueError):
        identify.FastTextIdentifier.build("model.bin")


def test_package(spark, tmp_path):
    import hashlib

    for n in ("en.txt.gz", "en_meta_part_1.jsonl.gz", "fr.txt.gz"):
        (tmp_path / n).write_bytes(n.encode())
    target = str(tmp_path / "out")
    assert package.package_language(str(tmp_path), "en", target) == ["en.txt.gz", "en_meta_part_1.jsonl.gz"]
    assert package.package_language(str(tmp_path), "de", target) == []
    sums = (tmp_path / "out/en/en_sha256.txt").read_text().splitlines()
    assert sums[0] == f"{hashlib.sha256(b'en.txt.gz').hexdigest()} en.txt.gz"
    assert {r.file: r.sha256 for r in package.file_checksums(spark, f"{target}/en").collect()}["en.txt.gz"] == sums[0].split()[0]
    rows = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (4, "")], "doc_id long, text string")
    assert sorted(r.doc_id for r in package.distinct_texts(rows).collect()) == [1, 2]
    rows = spark.createDataFrame([(None, "a"), (None, "a"), (None, "b"), (5, "b")], "doc_id long, text string")
    assert sorted(((r.doc_id, r.text) for r in package.distinct_texts(rows).collect()), key=str) == [(5, "b"), (None, "a")]
