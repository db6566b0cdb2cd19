"""Arrow helpers for operators that look at one document at a time: whole texts in, rows out, no exchange."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.storage import written

#: Rows, and bytes of their texts, handled at once within an Arrow batch; a longer text is handled alone. What a worker holds is bounded by these and the longest text, not by the batch.
SLICE, SLICE_BYTES = 256, 1 << 22


def cuts(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    """Stretches (from, to) of rows with texts of these sizes, none of more than SLICE rows, nor, unless it is one row, of more than SLICE_BYTES."""
    at = held = 0
    for k, n in enumerate(sizes):
        if k > at and (k - at >= SLICE or held + n > SLICE_BYTES):
            yield at, k
            at, held = k, 0
        held += n
    if at < len(sizes):
        yield at, len(sizes)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in stretches that ``cuts`` gives for the texts of a column."""
    for a, b in cuts(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        yield batch.slice(a, b - a)


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """The named columns only, under the names used inside; other columns can't clash with what is added."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more)


def map_documents(docs: DataFrame, schema: str, start: Callable[[], Callable[[list[int | None], list[str | None]], list[list]]]) -> DataFrame:
    """``mapInArrow`` over (doc_id, text). ``start`` runs once a task and gives a function from ids and texts to the columns of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = start()
        for batch in batches:
            for part in slices(batch, 1):
                columns = f(part.column(0).to_pylist(), part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(columns, target)], schema=target)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def row_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that name a row by its id and its text; rows which repeat both share it. A null text is the empty text."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit("")))))


#: Keys that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 19


def rows_of(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their columns, that ``decided`` (``row_key``, ``kept``; a row for each of ``docs``) keeps; of rows that share their key, and of which one is kept, one.

    What is moved are the keys; rows only where the keys that aren't simply kept are too many to be broadcast, and those that repeat each other.
    """
    odd = written(decided.groupBy("row_key").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept")).where("n > 1 or not kept"), "odd-keys")
    side = (F.broadcast(odd) if odd.count() <= BROADCAST_ROWS else odd).select("row_key", F.col("kept").alias("repeated"))
    whole = docs.select(F.struct("*").alias("row"), row_key(F.col(id_col), F.col(text_col)).alias("row_key")).join(side, "row_key", "left")
    plain = whole.where("repeated is null").select("row.*")
    if odd.where("kept").isEmpty():
        return plain
    return plain.unionByName(whole.where("repeated").dropDuplicates(["row_key"]).select("row.*"))
