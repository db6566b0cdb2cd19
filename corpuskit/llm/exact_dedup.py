"""Exact deduplication by distributed most-significant-digit radix partitioning.

A text is a string of bytes; a digit is a run of successive bytes. Round ``r`` splits every open group by its next digit (256 bytes,
then 16 times as many each round). A group that has become a singleton, or whose texts have ended, is settled; only the
others go on, with what is left of their bytes. Two texts end in one group exactly when all their bytes agree: no digest takes part.

Cost: the bytes of a text are moved once in the first round; after that only texts which still share all their bytes so far with
another text move. Counting is a map-side combined aggregate, so a group of any size reaches a reducer as one row for each map
task. Where rows learn their group's number, groups of more than 1/256 of the open rows (so 255 at most) are salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.rows import row_key
from corpuskit.storage import discard, written

#: Bytes of the first digit, and how many times wider each later digit is.
FIRST_DIGIT, WIDENING = 256, 16
#: A group is salted when it has more than this part of the open rows.
HOT_PART = 256


def normalised(text: Column) -> Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _digit(rest: Column, width: int) -> list[Column]:
    ended = F.octet_length(rest) <= width
    return [
        F.substring(rest, 1, width).alias("digit"),
        ended.alias("ended"),
        F.when(~ended, F.substring(rest, width + 1, 2**31 - 1)).alias("rest"),
    ]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first_digit: int = FIRST_DIGIT, widening: int = WIDENING, keys: bool = False) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256; with ``keys`` also row_key (``rows.row_key``).

    Of equal normalised texts the smallest ``doc_id`` is kept (null ids sort last). A null text is the empty text, and all
    empty texts form one group. Rows repeated with the same id and text form a group of which exactly one row has
    ``kept``. An empty table gives an empty result; other columns of the input are ignored, whatever their names.
    """
    raw = F.col(text_col)
    carried = ["row_key"] if keys else []
    base = docs.select(*([row_key(F.col(id_col), raw).alias("row_key")] if keys else []), F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), normalised(raw).cast("binary").alias("bytes"))
    # The row numbers hold from here on: every later step reads this table.
    opened = written(
        base.select("uid", *carried, "doc_id", F.unhex(F.sha2("bytes", 256)).alias("sha"), F.lit(0).cast("long").alias("gid"), *_digit(F.col("bytes"), first_digit)),
        "radix",
    )
    first = opened
    key = ["gid", "digit", "ended"]
    parts: list[DataFrame] = []
    width = first_digit
    while True:
        order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")
        groups = written(
            opened.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).where("n > 1").select(*key, "n", "first", F.monotonically_increasing_id().alias("next_gid")),
            "groups",
        )
        hot, salts = _hot(opened, groups, key)
        salt = F.pmod("uid", F.lit(salts)) if salts > 1 else F.lit(0).cast("long")
        h = F.xxhash64(*key)
        rows = opened.withColumn("salt", F.when(h.isin(hot), salt).otherwise(F.lit(0).cast("long")) if hot else F.lit(0).cast("long"))
        every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
        spread = groups.withColumn("salt", F.explode(F.when(h.isin(hot), every).otherwise(F.array(F.lit(0).cast("long")))) if hot else F.lit(0).cast("long"))
        width *= widening
        goes_on = F.col("n").isNotNull() & ~F.col("ended")
        joined = rows.join(spread, [*key, "salt"], "left").select(
            "uid",
            *carried,
            "doc_id",
            "sha",
            F.when(~goes_on, F.coalesce("n", F.lit(1).cast("long"))).alias("group_size"),
            F.when(~goes_on, F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))).alias("keep_id"),
            F.when(~goes_on, F.coalesce("first.uid", "uid")).alias("keep_uid"),
            F.when(goes_on, F.col("next_gid")).alias("gid"),
            *[F.when(goes_on, c).alias(n) for c, n in zip(_digit(F.col("rest"), width), ("digit", "ended", "rest"))],
        )
        last = groups.where(~F.col("ended")).isEmpty()
        if not last:
            joined = written(joined, "radix")
            discard(groups, *([first] if opened is first else []))
        parts.append(joined.where("gid is null"))
        if last:
            break
        opened = joined.where("gid is not null").select("uid", *carried, "doc_id", "sha", *key, "rest")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select("doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), *carried)


def _hot(opened: DataFrame, groups: DataFrame, key: list[str]) -> tuple[list[int], int]:
    """Hashes of the groups to be salted, fewer than HOT_PART, and the number of salts. The hash only spreads rows; a collision salts a group in vain."""
    total, largest = opened.count(), groups.agg(F.max("n")).first()[0] or 0
    least = max(total // HOT_PART, 1024)
    if largest <= least:
        return [], 1
    hot = groups.where(F.col("n") > least).select(F.xxhash64(*key).alias("h"))
    return [r.h for r in hot.collect()], min(HOT_PART, -(-largest // least))
