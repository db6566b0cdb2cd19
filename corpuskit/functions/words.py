"""Words of a text. ``plain_words`` is a Column of runs of letters, marks and digits; ``unicode_words`` breaks at Unicode word boundaries (UAX 29) in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def plain_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{M}\p{N}]+)"), 1)


_APART = r"[\p{L}\p{N}\p{P}\p{S}&&[^ﾞﾟ\x{1F3FB}-\x{1F3FF}\x{1F1E6}-\x{1F1FF}]]"
#: Spaces and line breaks between characters that attach to nothing beside them: of letters, numbers, punctuation and symbols, all but these few.
GAPS = rf"[ \r\n](?<={_APART}[ \r\n])[ \r\n]*+(?={_APART})"


def spaced_pieces(text: Column) -> Column:
    """The text parted at GAPS. There is a word boundary on either side of each, and no rule looks over it, so the words of the pieces are those of the text."""
    return F.split(text, GAPS, -1)


def _words(letter: str, digit: str, joiner: str, within: str, between: str, vowel: str, kana: str = "", alone: str = "") -> str:
    """An expression of the pieces between word boundaries that have a letter, digit or kana, for texts without characters that attach to others: rules WB5 to WB13b, and no boundary between an apostrophe and a vowel, as ``regex`` has it.

    Classes without their brackets: ``within`` may be between two letters, ``between`` between two digits; ``alone`` are words by themselves.
    """
    run = rf"[{letter}{digit}]++(?:(?:(?<=[{letter}])[{within}](?=[{letter}])|(?<=[{digit}])[{between}](?=[{digit}]))[{letter}{digit}]++)*+"
    part = rf"(?:{run}|[{kana}]++)" if kana else rf"(?:{run})"
    return rf"(?:['’](?=[{vowel}])|[{joiner}]*+){part}(?:[{joiner}]++{part})*+[{joiner}]*+" + (f"|{alone}" if alone else "")


_ASCII = re.compile(_words("A-Za-z", "0-9", "_", ":.'", ",;.'", "AEIOUaeiou"))


@cache
def _expressions() -> tuple:
    """Of the boundaries; of a letter or digit; of characters that attach to others, and those with rules of their own; of the words of texts without those."""
    import regex

    of = lambda *names: "".join(rf"\p{{WB={n}}}" for n in names)
    letter, digit, kana, quotes = of("ALetter"), of("Numeric"), of("Katakana"), ("MidNumLet", "Single_Quote")
    words = _words(letter, digit, of("ExtendNumLet"), of("MidLetter", *quotes), of("MidNum", *quotes), "AEIOUaeiouÀ-ÂÈ-ÊÌ-ÎÒ-ÔÙ-Ûà-âè-êì-îò-ôù-ûİ", kana, rf"[[\p{{L}}\p{{N}}]--[{letter}{digit}{kana}]]")
    return regex.compile(r"(?V1w)\b"), regex.compile(r"[\p{L}\p{N}]"), regex.compile(f"[{of('Extend', 'Format', 'ZWJ', 'Hebrew_Letter', 'Regional_Indicator')}]"), regex.compile(f"(?V1){words}")


def break_words(text: str) -> list[str]:
    """Lower-cased pieces between word boundaries that have a letter or a digit. Ideographs and kana are words by themselves where the boundaries part them.

    Looking for boundaries at each place is slow, so it is left to texts that need all of the rules.
    """
    if text.isascii():
        return [w.lower() for w in _ASCII.findall(text)]
    boundary, telling, attached, words = _expressions()
    if attached.search(text):
        return [w.lower() for w in boundary.split(text) if w and telling.search(w)]
    return [w.lower() for w in words.findall(text) if telling.search(w)]


@F.pandas_udf(ArrayType(StringType()))
def unicode_words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([break_words(t) if t else [] for t in texts], dtype=object)
