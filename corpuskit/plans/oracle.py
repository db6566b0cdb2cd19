"""DuckDB SQL that gives the rows of the engine's queries, written on lines as rows rather than on arrays."""

from __future__ import annotations

from corpuskit.functions.tags import REPLACED, WELL_FORMED
from corpuskit.operators.identify import LEXICON

BLOCKLIST = [
    ("domain", "thther.example.org", "education"),
    ("domain", "blog.tionsh.example.net", "blog"),
    ("domain", "blog.tionsh.example.net", "adult"),
    ("domain", "m.ththth.example.net", "mobile"),
    ("url", "therin.example.net/en/770#top", "games"),
    ("url", "thther.example.org/en/685", "press"),
]
BLOCKED_DOMAINS, BLOCKED_URLS = ("blog.tionsh.example.net", "www.cheap-pills.example.com"), ("http://therha.example.com/en/676",)
LABELS = ("__label__eng", "__label__fra_Latn", "en", "__label__als", "__label__zho_Hans", "__label__", "__label__no tag", "__label__prs", "__label__eml", "__label__srp_Cyrl", "__label__tgl", "__label__ace_Arab")


def _array(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _lines(text: str) -> str:
    t = f"replace({text}, chr(13) || chr(10), chr(10))"
    return f"CASE WHEN {t} = '' THEN []::VARCHAR[] ELSE string_split(CASE WHEN ends_with({t}, chr(10)) THEN left({t}, length({t}) - 1) ELSE {t} END, chr(10)) END"


_D = f"d AS (SELECT *, {_lines('text')} AS ls FROM documents)"
_L = f"{_D}, l AS (SELECT doc_id, text, len(ls) AS n, generate_subscripts(ls, 1) - 1 AS pos, unnest(ls) AS line FROM d WHERE len(ls) > 0)"
_TRIMMED = f"""{_D},
b AS (SELECT doc_id, text, lang, ls, list_filter(range(len(ls)), lambda i: length(ls[i + 1]) > 100) AS long FROM d),
t AS (SELECT doc_id, text, lang, list_min(long) AS line_start, list_max(long) AS line_end,
      CASE WHEN len(long) > 0 THEN array_to_string(ls[list_min(long) + 1 : list_max(long) + 1], chr(10)) ELSE '' END AS content FROM b)"""


def _tiny(ls: str) -> str:
    return f"CASE WHEN len({ls}) < 5 THEN 'tiny' END"


def _short(ls: str) -> str:
    return f"CASE WHEN len(list_filter({ls}, lambda x: length(x) <= 100)) > floor(len({ls}) * 0.5::DOUBLE) THEN 'short_sentences' END"


def _ends(ls: str) -> tuple[str, str]:
    h = f"CAST(floor(len({ls}) * 0.2::DOUBLE) AS INT)"
    test = "CASE WHEN len(list_filter({part}, lambda x: strlen(x) < 100)) > floor({h} * 0.5::DOUBLE) THEN '{name}' END"
    return (
        test.format(part=f"{ls}[1 : {h}]", h=h, name="header"),
        test.format(part=f"CASE WHEN {h} > 0 THEN {ls}[len({ls}) - {h} + 1 : len({ls})] ELSE []::VARCHAR[] END", h=h, name="footer"),
    )


def _noisy(text: str, share: float = 0.5) -> str:
    return f"CASE WHEN length(regexp_replace({text}, '[\\p{{L}}\\p{{M}}]', '', 'g')) > floor(length({text}) * {share}::DOUBLE) THEN 'noisy' END"


def _identified(source: str) -> str:
    """Rows i (doc_id, b, label, prob) of the lines of ``source`` (doc_id, ls)."""
    counts = ", ".join(f"len(list_filter(ws, lambda x: list_contains({_array(words)}, x))) AS c_{k}" for k, words in sorted(LEXICON.items()))
    names = [f"c_{k}" for k in sorted(LEXICON)]
    label = " ".join(f"WHEN c_{k} THEN '{k}'" for k in sorted(LEXICON))
    return f"""
lw AS (SELECT doc_id, strlen(replace(line, chr(0), '')) AS b, string_split(regexp_replace(lower(replace(line, chr(0), '')), '[^\\p{{L}}]+', ' ', 'g'), ' ') AS ws FROM (SELECT doc_id, unnest(ls) AS line FROM {source})),
lc AS (SELECT doc_id, b, {counts} FROM lw),
lt AS (SELECT *, {' + '.join(names)} AS total, greatest({', '.join(names)}) AS top FROM lc),
i AS (SELECT doc_id, b, CASE WHEN total > 0 AND top::DOUBLE / total >= 0.8::DOUBLE THEN CASE top {label} END END AS label,
      CASE WHEN total > 0 AND top::DOUBLE / total >= 0.8::DOUBLE THEN (top::DOUBLE / total)::FLOAT END AS prob FROM lt)"""


_BINS = """bins AS (SELECT doc_id, label, sum(b)::BIGINT AS bytes, sum(b * coalesce(prob::DOUBLE, 1.0::DOUBLE)) / sum(sum(b)) OVER (PARTITION BY doc_id) AS conf FROM i GROUP BY doc_id, label),
v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY bytes DESC, label IS NULL, label) AS r FROM bins) WHERE r = 1)"""


def _pairs() -> str:
    return f"""WITH {_D}, {_identified('d')},
p AS (SELECT doc_id, label, prob, b FROM i
      UNION ALL SELECT doc_id - 1, label, prob, b FROM i WHERE doc_id - 1 IN (SELECT doc_id FROM documents)),
k AS (SELECT doc_id, label, count(*) AS c, sum(b)::BIGINT AS bytes FROM p GROUP BY doc_id, label),
g AS (SELECT doc_id, count(*) AS n, sum(b)::BIGINT AS total, count(*) FILTER (prob >= 0.8::FLOAT) AS sure, count(DISTINCT label) AS langs,
      count(DISTINCT label) + max(CASE WHEN label IS NULL THEN 1 ELSE 0 END) AS keys FROM p GROUP BY doc_id)"""


def _strict(column: str, even: str) -> str:
    gates = lambda least, share: f"n >= {least} AND sure::DOUBLE / n > {share}::DOUBLE AND langs BETWEEN 2 AND 5"
    return f"""{_pairs()},
f AS (SELECT doc_id, bool_and(CASE WHEN label IS NULL THEN {column} <= {even} ELSE {column} >= {even} END) AS fair FROM k JOIN g USING (doc_id) GROUP BY doc_id)
SELECT doc_id, ({gates(10, 0.8)}) AND fair AS multi, ({gates(4, 0.5)}) AND fair AS multi_loosely FROM g JOIN f USING (doc_id)"""


def _ratio() -> str:
    test = lambda limit, q: f"(SELECT coalesce(bool_and(after > c / {q}::DOUBLE), true) FROM o WHERE o.doc_id = g.doc_id AND r < {limit} AND after IS NOT NULL)"
    gates = lambda least: f"n >= {least} AND langs >= 2 AND coalesce((SELECT max(c) FROM k WHERE k.doc_id = g.doc_id AND label IS NULL), 0) <= (SELECT max(c) FROM o WHERE o.doc_id = g.doc_id)"
    return f"""{_pairs()},
o AS (SELECT doc_id, c, row_number() OVER w AS r, lead(c) OVER w AS after FROM k WHERE label IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY c DESC, label))
SELECT doc_id, coalesce(({gates(10)}) AND {test(2, 4)}, false) AS multi, coalesce(({gates(4)}) AND {test(3, 8)}, false) AS multi_loosely FROM g"""


_WORDS = r"""w AS (SELECT word, count(*) AS count FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+')) AS word FROM documents) GROUP BY word),
r AS (SELECT row_number() OVER (ORDER BY count DESC) AS rank, count, sum(count) OVER ()::DOUBLE AS total FROM w)"""
_LOCATED = f"{_TRIMMED}, loc AS (SELECT doc_id, doc_id // 100 AS shard_id, doc_id % 100 AS loc_in_shard, lang, line_start, line_end, content FROM t WHERE line_start IS NOT NULL)"
_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"


def oracle_sql() -> dict[str, str]:
    header, footer = _ends("ls")
    rows = ", ".join(f"('{k}', '{v}', '{c}')" for k, v, c in BLOCKLIST)
    table = ", ".join(f"('{k}', '{v}')" for k, v in sorted(REPLACED.items()))
    chain = lambda ls, text: ", ".join([_tiny(ls), _short(ls), *_ends(ls), _noisy(text)])
    share = lambda s, n: f"coalesce(list_sum(list_transform(list_filter(ls, lambda x: length(x) >= {n}), lambda x: length(x))), 0) >= coalesce(list_sum(list_transform(ls, lambda x: length(x))), 0) * {s}::DOUBLE"
    kept = f"{_TRIMMED}, c AS (SELECT *, {_lines('content')} AS ls FROM t WHERE line_start IS NOT NULL), f AS (SELECT * FROM c WHERE {share(0.6, 100)})"
    return {
        "src_shard_number": r"""SELECT doc_id, TRY_CAST(nullif(regexp_extract(CASE doc_id % 7 WHEN 0 THEN source || '.txt.gz' WHEN 1 THEN doc_id::VARCHAR ELSE doc_id || '.txt.gz' END, '^([0-9]+)(\.|$)', 1), '') AS BIGINT) AS shard_id FROM documents""",
        "src_paths_urls": "SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN 'https://data.commoncrawl.org/crawl-data/' || source || '/' || doc_id || '.warc.wet.gz' END AS url FROM documents",
        "flt_length_lines": f"WITH {_L} SELECT doc_id, pos, length(line) AS n_chars FROM l WHERE length(line) > 100",
        "flt_mean_length_running": f"""WITH {_L}, s AS (SELECT doc_id, pos, length(line)::DOUBLE AS x, count(*) OVER w AS n, sum(length(line)::DOUBLE) OVER w AS s, sum(length(line)::DOUBLE * length(line)) OVER w AS q FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
SELECT doc_id, pos, abs(x - s / n) < sqrt(greatest(q / n - (s / n) * (s / n), 0.0::DOUBLE)) AS near FROM s""",
        "flt_mean_length_frozen": f"WITH {_L}, m AS (SELECT avg(length(line)) AS mean, stddev_pop(length(line)) AS dev FROM l) SELECT doc_id, pos, abs(length(line) - mean) < dev AS near FROM l, m",
        "flt_pfilter": f"WITH {_D} SELECT doc_id, {share(0.6, 100)} AS kept, {share(0.95, 150)} AS kept_strictly FROM d",
        "flt_noisy_tiny_intent": f"WITH {_D} SELECT doc_id, len(ls) < 5 AND {_noisy('text', 0.22)} IS NOT NULL AS both, false AS exactly FROM d",
        "trf_trim_short": f"WITH {_TRIMMED} SELECT doc_id, line_start, line_end, md5(content) AS content_md5 FROM t",
        "trf_conv_trim": f"""WITH {_L}, m AS (SELECT a.doc_id, a.pos FROM l a, (SELECT unnest(range(-2, 3)) AS k) o JOIN l b ON b.doc_id = a.doc_id AND b.pos = greatest(0, least(a.n - 1, a.pos + o.k)) GROUP BY a.doc_id, a.pos HAVING sum(strlen(b.line)) / 5.0::DOUBLE >= 100),
e AS (SELECT doc_id, min(pos) AS line_start, max(pos) AS line_end FROM m GROUP BY doc_id)
SELECT doc_id, line_start, line_end, md5(CASE WHEN line_start IS NULL THEN text ELSE array_to_string(ls[line_start + 1 : line_end + 1], chr(10)) END) AS content_md5 FROM d LEFT JOIN e USING (doc_id)""",
        "ann_tiny": f"WITH {_D} SELECT doc_id, coalesce({_tiny('ls')}, '') AS warnings FROM d",
        "ann_short": f"WITH {_D} SELECT doc_id, coalesce({_short('ls')}, '') AS warnings FROM d",
        "ann_header_footer": f"WITH {_D} SELECT doc_id, concat_ws(',', {header}, {footer}) AS warnings FROM d",
        "ann_noisy": f"SELECT doc_id, coalesce({_noisy('text')}, '') AS warnings, coalesce({_noisy('text', 0.22)}, '') AS warnings_strictly FROM documents",
        "ann_all": f"WITH {kept} SELECT doc_id, line_start, line_end, strlen(content) AS n_bytes, nullif(concat_ws(',', {chain('ls', 'content')}), '') AS warnings FROM f",
        "ann_categories": f"""WITH b(kind, value, category) AS (VALUES {rows}), p AS (SELECT page_id, {_HOST} AS host, regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages)
SELECT page_id, string_agg(DISTINCT category, ',' ORDER BY category) AS categories FROM p LEFT JOIN b ON (kind = 'domain' AND value = host) OR (kind = 'url' AND value = bare) GROUP BY page_id""",
        "ann_blocklist_kind": f"SELECT page_id, CASE WHEN list_contains({_array(BLOCKED_DOMAINS)}, {_HOST}) OR list_contains({_array(BLOCKED_URLS)}, url) THEN 'adult' END AS kind FROM pages",
        "lid_tag_fix": f"""WITH m(code, tag) AS (VALUES {table}), x AS (SELECT doc_id, list_append({_array(LABELS)}, '__label__' || lang)[doc_id % {len(LABELS) + 1} + 1] AS label FROM documents),
y AS (SELECT doc_id, label, CASE WHEN length(label) >= 9 THEN substr(label, 10) ELSE label END AS bare FROM x), z AS (SELECT doc_id, label, replace(coalesce(tag, bare), '_', '-') AS tag FROM y LEFT JOIN m ON code = bare)
SELECT doc_id, label, tag, regexp_matches(tag, '{WELL_FORMED}') AS well_formed FROM z""",
        "lid_weighted_bins": f"WITH {_D}, {_identified('d')}, {_BINS} SELECT doc_id, label, bytes, round(conf, 6) AS conf FROM bins",
        "lid_vote": f"WITH {_D}, {_identified('d')}, {_BINS} SELECT doc_id, label, bytes, round(conf, 6) AS conf, label IS NOT NULL AND conf >= 0.6::DOUBLE AS accepted FROM v",
        "ml_strict_lines": _strict("c", "floor(n::DOUBLE / keys)"),
        "ml_strict_bytes": _strict("bytes", "floor(total::DOUBLE / (langs + 1))"),
        "ml_ratio": _ratio(),
        "agg_docs_by_lang": f"WITH {_D}, {_identified('d')}, {_BINS} SELECT label, count(*) AS documents, sum(bytes)::BIGINT AS bytes FROM v GROUP BY label",
        "zipf_counts": f"WITH {_WORDS} SELECT word, count FROM w",
        "zipf_rank": f"WITH {_WORDS} SELECT rank, count, round(count / total, 9) AS prob, round(rank * (count / total), 6) AS constant FROM r",
        "zipf_stats": f"WITH {_WORDS} SELECT count(*) AS words, max(total)::BIGINT AS total, round(avg(rank * (count / total)), 6) AS mean, round(stddev_pop(rank * (count / total)), 6) AS sigma FROM r",
        "rb_shard_result": f"WITH {_LOCATED} SELECT lang, shard_id, count(*) AS entries, string_agg(loc_in_shard || ':' || line_start || ':' || line_end, ',' ORDER BY loc_in_shard) AS places FROM loc GROUP BY lang, shard_id",
        "rb_roundtrip": f"WITH {_LOCATED} SELECT doc_id, lang, md5(content) AS content_md5, strlen(content) AS content_length FROM loc",
        "rb_mismatch_prefix": f"""WITH {_LOCATED}, m AS (SELECT *, min(CASE WHEN doc_id % 37 = 5 THEN loc_in_shard END) OVER (PARTITION BY lang, shard_id) AS bad FROM loc)
SELECT lang, shard_id, count(*) AS documents, max(loc_in_shard) AS last FROM m WHERE bad IS NULL OR loc_in_shard < bad GROUP BY lang, shard_id""",
        "pkg_sha256": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
        "pkg_distinct": "SELECT min(doc_id) AS doc_id, length(text) AS n_chars FROM documents GROUP BY text",
        "corpus_documents": f"""WITH {kept}, {_identified('f')}, {_BINS},
k AS (SELECT doc_id, label, count(*) AS c FROM i GROUP BY doc_id, label),
g AS (SELECT doc_id, count(*) AS n, count(*) FILTER (prob >= 0.8::FLOAT) AS sure, count(DISTINCT label) AS langs, count(DISTINCT label) + max(CASE WHEN label IS NULL THEN 1 ELSE 0 END) AS keys FROM i GROUP BY doc_id),
x AS (SELECT doc_id, any_value(n >= 10 AND sure::DOUBLE / n > 0.8::DOUBLE AND langs BETWEEN 2 AND 5) AND bool_and(CASE WHEN label IS NULL THEN c <= floor(n::DOUBLE / keys) ELSE c >= floor(n::DOUBLE / keys) END) AS multi, any_value(n) AS n FROM k JOIN g USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CASE WHEN multi THEN 'multi' ELSE label END AS lang, round(CASE WHEN multi THEN 0.5::FLOAT ELSE conf::FLOAT END::DOUBLE, 4) AS prob, line_start, line_end, strlen(content) AS n_bytes,
       nullif(concat_ws(',', {chain('ls', 'content')}), '') AS warnings, n AS n_lines
FROM f JOIN v USING (doc_id) JOIN x USING (doc_id) WHERE multi OR (label IS NOT NULL AND conf >= 0.6::DOUBLE)""",
    }
