"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in an order given by a hash of their ids and texts, are cut into blocks of ``block_chars`` code points. With weight a of A in all, the source's k-th block (from 0) is
released at slot floor(k A / a) and has its deadline at slot ceil((k + 1) A / a). In each slot the released block of the earliest deadline goes next, so at any
time each source is less than one block away from its share. Weights are whole numbers, so the schedule repeats after A slots: one period is simulated on the driver and
a block's slot is then arithmetic. When a source has run out, the others go on by their weights from the next slot: a phase each. Of more than EXACT_SOURCES sources,
several may run out within a phase, as long as they have at most one part in ENDED_PART of its weight together: their slots are then skipped until it ends.

No row is dropped or repeated. Places within a source are sums over chunks of CHUNK_ROWS rows, so no task sees a whole source, however large its part of the rows; rows that repeat
each other are placed as one.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.storage import written

BLOCK_CHARS = 1 << 16
#: Target weights of the query's sources; a source that isn't named has DEFAULT_WEIGHT.
WEIGHTS: Mapping[str, int] = {"src0": 6, "src1": 4, "src2": 3, "src3": 2}
DEFAULT_WEIGHT = 1
#: Rows of a chunk within which places are summed up, as expected.
CHUNK_ROWS = 8192
#: Up to so many sources, each source's end begins a new phase; of more, those that end within one have at most one part in ENDED_PART of its weight.
EXACT_SOURCES, ENDED_PART = 64, 8
#: The most slots of a period.
MOST_SLOTS = 1 << 22
#: Rows of driver-made tables that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 16


def period_slots(weights: list[int]) -> list[list[int]]:
    """Of each source the slots of its blocks in one period, which has as many slots as the weights' sum."""
    whole = sum(weights)
    waiting = [(0, -(-whole // a), -a, i, 0) for i, a in enumerate(weights)]
    heapq.heapify(waiting)  # by release
    ready: list[tuple[int, int, int, int]] = []  # by deadline, then the heavier, then the first
    out: list[list[int]] = [[] for _ in weights]
    for slot in range(whole):
        while waiting and waiting[0][0] <= slot:
            _, deadline, heavy, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, heavy, i, k))
        _, heavy, i, k = heapq.heappop(ready)
        out[i].append(slot)
        k, a = k + 1, weights[i]
        if k < a:
            heapq.heappush(waiting, (k * whole // a, -(-(k + 1) * whole // a), heavy, i, k))
    return out


def phases(blocks: list[int], weights: list[int]) -> list[dict]:
    """Rows (source, phase, first, until, base, period, weight, slots): blocks ``first`` to ``until`` of the source lie in the phase that begins at slot ``base``. Weights are divided by what divides them all.

    With each phase at least one part in ENDED_PART of the weight goes, or there are at most EXACT_SOURCES sources: the rows, and the slots that are simulated, are a multiple of the sources and of their weights' sum.
    """
    done = [0] * len(blocks)
    base, out, phase = 0, [], 0
    active = [i for i, n in enumerate(blocks) if n]
    while active:
        divisor = math.gcd(*[weights[i] for i in active])
        own = [weights[i] // divisor for i in active]
        whole = sum(own)
        if whole > MOST_SLOTS:
            raise ValueError(f"the weights' sum, after division by what divides them all, is {whole}: at most {MOST_SLOTS} slots are simulated")
        slots = period_slots(own)
        ends = []
        for a, s, i in zip(own, slots, active):
            last = blocks[i] - done[i] - 1
            ends.append((last // a * whole + s[last % a] + 1, a))
        ends.sort()
        end, gone = 0, 0
        for end, a in ends:
            gone += a
            if len(active) <= EXACT_SOURCES or gone * ENDED_PART > whole:
                break
        for a, s, i in zip(own, slots, active):
            until = min(blocks[i], done[i] + end // whole * a + bisect_left(s, end % whole))
            if until > done[i]:
                out.append({"source": i, "phase": phase, "first": done[i], "until": until, "base": base, "period": whole, "weight": a, "slots": s})
            done[i] = until
        base, phase = base + end, phase + 1
        active = [i for i in active if done[i] < blocks[i]]
    return out


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def mix(
    docs: DataFrame,
    weights: Mapping[str, int] = WEIGHTS,
    default_weight: int = DEFAULT_WEIGHT,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    rows: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, source, n_chars, block, phase, release, deadline, slot, at; with ``rows`` also the input row, as the struct ``row``.

    A document lies in the block of its source in which it begins; ``at`` is where, in code points. The mixed order is that of (slot, at); a document longer than
    what is left of its block runs on into its source's next slots. A null source is the source of the empty name. An empty or null text counts as
    one code point. Rows with one id and text follow each other; with ``rows``, which of their places each has is by chance, and two may have the same. Ties are ordered by length
    and hash of the text. A very long text takes as many slots as it fills. An empty table gives an empty result; other columns of the input are ignored, whatever their names.
    The driver holds a row for each source and phase.
    """
    if default_weight < 1 or any(w < 1 or w != int(w) for w in weights.values()):
        raise ValueError("weights are whole numbers from 1 on")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.length(text).cast("long").alias("n_chars"),
        F.xxhash64(text).alias("tie"),
        *([F.struct("*").alias("row")] if rows else []),
    )
    own = ["source", "doc_id", "n_chars", "tie"]
    # One row for those that repeat each other; only these narrow rows go through windows.
    narrow = base.groupBy(*own).agg(F.count(F.lit(1)).alias("n")).withColumn("size", F.greatest("n_chars", F.lit(1)))
    narrow = written(narrow.withColumn("h", F.shiftrightunsigned(F.xxhash64("doc_id", "tie"), 1)), "sizes")
    found = narrow.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("n") * F.col("size")).alias("size")).orderBy("source").collect()  # a row for each source
    names = [r["source"] for r in found]
    chunk_counts = spark.createDataFrame([(r["source"], max(1, -(-r["n"] // CHUNK_ROWS))) for r in found], "source string, chunks long")
    chunk = F.least(F.floor(F.col("h") / F.lit(2.0**63) * F.col("chunks")), F.col("chunks") - 1).alias("chunk")
    chunked = narrow.join(_small(chunk_counts, len(names)), "source").select(*narrow.columns, chunk)
    whole = F.sum(F.col("n") * F.col("size"))
    sums = chunked.groupBy("source", "chunk").agg(whole.alias("size"))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "chunk", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    inner = Window.partitionBy("source", "chunk").orderBy("h", "doc_id", "n_chars", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = chunked.join(starts, ["source", "chunk"]).select(*own, "n", "size", (F.col("start") + F.coalesce(whole.over(inner), F.lit(0))).alias("first"))
    if rows:
        p = placed.alias("p")
        same = (F.col("b.source") == F.col("p.source")) & F.col("b.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("b.n_chars") == F.col("p.n_chars")) & (F.col("b.tie") == F.col("p.tie"))
        nth = F.when(F.col("p.n") > 1, F.floor(F.rand(1) * F.col("p.n"))).otherwise(F.lit(0))
        placed = base.alias("b").join(p, same).select(*[f"b.{c}" for c in own], "b.row", (F.col("p.first") + nth * F.col("p.size")).alias("place"))
    else:
        nth = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("nth")
        placed = placed.select("*", nth).select(*own, (F.col("first") + F.col("nth") * F.col("size")).alias("place"))
    plan = phases([-(-r["size"] // block_chars) for r in found], [weights.get(s, default_weight) for s in names])
    table = spark.createDataFrame([(names[p["source"]], p["phase"], p["first"], p["until"], p["base"], p["period"], p["weight"], p["slots"]) for p in plan], "source string, phase long, first long, until long, base long, period long, weight long, slots array<long>")
    blocks = placed.withColumn("block", F.expr(f"place div {block_chars}L")).withColumn("at", F.col("place") % block_chars)
    b, t = blocks.alias("b"), _small(table, len(plan)).alias("t")
    k = "(b.block - t.first)"
    return b.join(t, (F.col("b.source") == F.col("t.source")) & (F.col("b.block") >= F.col("t.first")) & (F.col("b.block") < F.col("t.until"))).select(
        "b.doc_id",
        "b.source",
        "b.n_chars",
        "b.block",
        "t.phase",
        F.expr(f"t.base + ({k} * t.period) div t.weight").alias("release"),
        F.expr(f"t.base + (({k} + 1) * t.period + t.weight - 1) div t.weight").alias("deadline"),
        F.expr(f"t.base + ({k} div t.weight) * t.period + element_at(t.slots, cast({k} % t.weight as int) + 1)").alias("slot"),
        "b.at",
        *(["b.row"] if rows else []),
    )


def mixed_rows(docs: DataFrame, partitions: int, **options) -> DataFrame:
    """The rows of ``docs``, with their columns, in the mixed order: that of the partitions and of the rows within them. Slots hold equally much text, so a partition has equally many."""
    whole = mix(docs, rows=True, **options)
    text = options.get("text_col", "text")
    block_chars = options.get("block_chars", BLOCK_CHARS)
    sizes = docs.groupBy(F.coalesce(F.col(options.get("source_col", "source")).cast("string"), F.lit("")).alias("s")).agg(F.sum(F.greatest(F.length(F.coalesce(F.col(text), F.lit(""))), F.lit(1))).cast("long").alias("n"))
    slots = sizes.agg(F.sum(F.expr(f"(n + {block_chars - 1}) div {block_chars}L"))).first()[0] or 1
    part = F.expr(f"cast(slot * {partitions}L div {slots}L as int)")
    return whole.repartitionById(partitions, part).sortWithinPartitions("slot", "at").select("row.*")
