"""Packing by power-of-two decomposition.

A document of n tokens is cut into as many pieces of 2048 tokens as it holds and then one piece for each binary digit of the rest, longest
first. Every piece is a sequence of its own: its length is a power of two, so nothing is padded, no sequence crosses documents, and batches are
drawn from buckets of equal lengths. Rows are independent: the operator is one scan with no exchange.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.rows import documents, map_documents, slices

MAX_LENGTH, END_ID = 2048, 1
#: Bits of a sequence's number, by the place of its document in written files.
FILE_BITS, ROW_BITS, PIECE_BITS = 18, 25, 20
#: Words whose ids a worker keeps, and the longest of them.
KNOWN_WORDS, KNOWN_LENGTH = 1 << 19, 48


def _byte_letters() -> dict[int, str]:
    """Of each Latin-1 character, the letters by which a byte-level vocabulary writes its UTF-8 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {b: chr(b) for b in plain}
    letter |= {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


_LETTERS = _byte_letters()
_SPACE = "\\t-\\r \x85\xa0"
_ALPHA, _DIGIT = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
#: The vocabulary's own splitting of a word, for lower-cased Latin-1.
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_ALPHA}]+|[{_DIGIT}]|[^{_SPACE}{_ALPHA}{_DIGIT}]+")


class WordTokenizer:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes.

    The vocabulary never joins characters across a space, so a text's ids are those of its words in turn. Ids of words seen before come
    from bounded tables; a new Latin-1 word is split here and merged by the vocabulary's model; any other word goes through the
    tokenizer whole. All ways give the ids that the tokenizer gives for the whole text.
    """

    def __init__(self, path: str | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            got = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(part.translate(_LETTERS))])
            if len(part) <= KNOWN_LENGTH:
                if len(self.parts) >= KNOWN_WORDS:
                    self.parts.clear()
                self.parts[part] = got
        return got

    def _word(self, word: str) -> bytes:
        if (word.isascii() or max(word) <= "\xff") and "<|" not in word:
            return b"".join(map(self._part, _SPLIT.findall(word.lower())))
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            if len(self.words) >= KNOWN_WORDS:
                self.words = {"": b""}
            missing = set(words).difference(self.words)
            found = {w: self._word(w) for w in missing}
            self.words.update((w, t) for w, t in found.items() if len(w) <= KNOWN_LENGTH)
            known = self.words
            return b"".join([found[w] if w in found else known[w] for w in words])


@lru_cache(maxsize=2)
def word_tokenizer(path: str | None = None) -> WordTokenizer:
    """One for each worker process, kept from task to task."""
    return WordTokenizer(path)


def piece_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Full pieces, then the binary digits of the rest, longest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = MAX_LENGTH, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset, bucket (the binary logarithm of length).

    ``longest`` is a power of two. A null or empty text is the one piece that holds the end id. Repeated rows are packed each on its own; an
    empty table gives an empty result; other columns are ignored. ``sequence_id`` is unique for each piece; ``offset`` is 0, as
    a piece fills its sequence.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def start():
        words = word_tokenizer(tokenizer)

        def pieces(ids: list[int | None], texts: list[str | None]) -> list[list]:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(ids, texts):
                tokens = words.ids(text or "") + END_ID.to_bytes(4, "little")
                n = len(tokens) // 4
                at = 0
                for length in piece_lengths(n, longest):
                    for column, value in zip(out, (doc_id, at, length, tokens[4 * at : 4 * (at + length)], n)):
                        column.append(value)
                    at += length
            return out

        return pieces

    found = map_documents(documents(docs, id_col, text_col), "doc_id long, start long, length long, ids binary, doc_tokens long", start)
    return found.select("*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.log2("length").cast("int").alias("bucket"))


def pack_as_written(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = MAX_LENGTH, tokenizer: str | None = None) -> DataFrame:
    """``pack`` of a table just read from Parquet files, with ``sequence_id`` in the order in which it was written: by the files' numbers, the rows' places in them, and the pieces' in their documents.

    A table that is read again is cut into tasks in another order, but Spark names its files by the partitions and tells each row's place; so no row is moved. There may be 2 ** FILE_BITS files of
    2 ** ROW_BITS rows, and 2 ** PIECE_BITS pieces of a document; beyond that it fails.
    """
    at = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    fits = (at < 1 << FILE_BITS) & (F.col("_metadata.row_index") < 1 << ROW_BITS)
    place = F.when(fits, F.shiftleft(at, ROW_BITS) + F.col("_metadata.row_index")).otherwise(F.raise_error(F.lit("too many files or rows")))
    # The place goes along as the id, and the id comes back with the pieces of each row.
    rows = docs.select(F.struct(F.col(id_col).cast("long").alias("doc_id"), place.alias("place")).alias("key"), F.col(text_col).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer)
        for batch in batches:
            for part in slices(batch, 1):
                out: list[list] = [[] for _ in schema]
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    tokens = words.ids(text or "") + END_ID.to_bytes(4, "little")
                    lengths = piece_lengths(len(tokens) // 4, longest)
                    if len(lengths) >= 1 << PIECE_BITS:
                        raise ValueError("too many pieces of one document")
                    start = 0
                    for k, length in enumerate(lengths):
                        for column, value in zip(out, (key["doc_id"], start, length, tokens[4 * start : 4 * (start + length)], len(tokens) // 4, (key["place"] << PIECE_BITS) + k)):
                            column.append(value)
                        start += length
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    found = rows.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long")
    return found.select("*", F.lit(0).cast("long").alias("offset"), F.log2("length").cast("int").alias("bucket"))
