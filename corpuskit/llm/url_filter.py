"""URL filter: host and path rules first, then a weighted vocabulary of URL terms found by an Aho-Corasick automaton.

A term counts only between boundaries (its neighbours are no ASCII letters or digits). One strict term rejects a URL, and so do
``SOFT_LIMIT`` distinct soft terms. Everything is local to a row: no exchange, and the automaton is built once for each Python worker
from the fixed vocabulary below.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path): a rule holds for its host and all subdomains where the path starts with the rule's.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Words that hardly stand in the URL of a page of prose: adult, gambling, medicines sold by mail, pirated copies, fraud.
STRICT = tuple(
    """
    porn porno pornos xxx casino casinos viagra cialis levitra hentai camgirls camgirl escort escorts
    sexcam sexcams torrentz warez slots jackpot spam spammer phishing malware xvideos xnxx redtube youporn
    pornhub milf milfs blowjob bdsm hardcoreporn sexshop livesex camsex nsfw onlyfans cryptowin linkfarm doorway
    bookmaker bookmakers sportsbook roulette blackjack baccarat slotmachine tramadol xanax valium ambien modafinil crackz keygens
    serialz
    """.split()
)
#: Words that do, but seldom two of them: the same matters in general terms, and what sells, tracks or farms links.
SOFT = tuple(
    """
    adult adults sex sexy sexo bet bets betting poker bonus bonuses win wins winner
    free gratis nude nudes naked dating hookup pills pill loan loans payday credit crack
    cracked keygen serial gambling cheap cheapest discount deals replica farm pharmacy meds drugs steroids
    weightloss diet forex crypto bitcoin lottery lotto prize prizes giveaway casual babes hot girls
    teen teens erotic erotik fetish x stream torrent download downloads hack hacked cheats proxy
    seo backlinks clicks traffic earn money rich quick ads track tracker popunder click
    """.split()
)
SOFT_LIMIT = 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The parts after the first ``://``: up to ``/``, ``?``, ``#`` or the end, in lower case; then up to ``?``, ``#`` or the end."""
    there = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = ascii_lower(F.regexp_extract(after, r"^[^/?#]*", 0))
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.when(there, host).otherwise(F.lit("")), F.when(there, path).otherwise(F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null. Of rules as long as each other, the one with the longer host wins, then a block."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _automaton(strict: Sequence[str], soft: Sequence[str]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for words, is_strict in ((soft, False), (strict, True)):
        for w in words:
            a.add_word(w, (w, is_strict))
    a.make_automaton()
    return a


def count_terms(text: str, automaton: ahocorasick.Automaton) -> tuple[int, int]:
    """Distinct strict and soft terms of a lower-cased text that stand between boundaries."""
    strict, soft = set(), set()
    for end, (word, is_strict) in automaton.iter(text):
        start = end - len(word)
        if (start < 0 or not (text[start].isascii() and text[start].isalnum())) and (end + 1 == len(text) or not (text[end + 1].isascii() and text[end + 1].isalnum())):
            (strict if is_strict else soft).add(word)
    return len(strict), len(soft)


def terms_udf(strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT):
    @F.pandas_udf("n_strict long, n_soft long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(strict, soft)
        for urls in batches:
            yield pd.DataFrame([count_terms(u or "", automaton) for u in urls], columns=["n_strict", "n_soft"])

    return count


def filter_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, n_strict, n_soft.

    A null URL, or one without ``://``, has an empty host and path and fits no rule; its terms are still counted (none for
    null). A URL of any length is judged whole. Repeated rows are judged alike and each is returned; an empty table gives an empty result; columns beside the two
    named are ignored, whatever their names.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"), terms_udf(strict, soft)(ascii_lower(F.coalesce("url", F.lit("")))).alias("t"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    own = F.when((F.col("t.n_strict") > 0) | (F.col("t.n_soft") >= soft_limit), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "t.n_strict", "t.n_soft")


def oracle() -> str:
    """The same verdicts in DuckDB SQL; a term between boundaries is a regular expression there."""

    def hits(words: Sequence[str]) -> str:
        return " + ".join(f"CAST(regexp_matches(u, '(^|[^a-z0-9]){w}($|[^a-z0-9])') AS BIGINT)" for w in words)

    cases_name, cases_verdict = "", ""
    for kind, h, p in sorted(RULES, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block"), reverse=True):
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        cases_name += f" WHEN {fits} THEN '{h + p}'"
        cases_verdict += f" WHEN {fits} THEN '{kind}'"
    return f"""
WITH cut AS (
  SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS u,
         CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
counted AS (SELECT *, {hits(STRICT)} AS n_strict, {hits(SOFT)} AS n_soft FROM parts)
SELECT page_id, host, path, CASE{cases_name} END AS rule,
       CASE{cases_verdict} WHEN n_strict > 0 OR n_soft >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict, n_strict, n_soft
FROM counted"""
