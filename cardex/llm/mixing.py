"""Operator 7: sources interleaved to target weights by Pfair scheduling.

Every source's documents form blocks of equal size.  Block ``i`` of a source of weight
``w`` (its share of a slot) is released at slot ``floor(i / w)`` and due by slot
``ceil((i + 1) / w)``; in each slot the released block with the earliest deadline runs.
With weights that add up to one all deadlines hold, so a source is never a whole block
ahead of or behind its target.

Weights are integer parts, so the schedule repeats after as many slots as there are
parts: one period is computed, and every block's slot follows from it by arithmetic.
When a source has run out, the others go on with their parts of a shorter period.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

BLOCK_CHARS = 65_536
# Parts of all weights together if the caller gives none; more for very many sources.
PARTS = 1000
PARTS_PER_SOURCE = 4
# Default weights are the sources' sizes to this power: large sources are damped.
DAMPING = 0.5
# Rows of a window of running sizes.
CHUNK_ROWS = 5_000


def default_parts(sizes: Mapping[str | None, int]) -> dict[str | None, int]:
    """Integer parts in proportion to damped sizes, one at least, by largest remainder."""
    total = sum(size**DAMPING for size in sizes.values())
    wanted = max(PARTS, PARTS_PER_SOURCE * len(sizes)) - len(sizes)
    exact = {s: wanted * size**DAMPING / total for s, size in sizes.items()}
    parts = {s: 1 + math.floor(x) for s, x in exact.items()}
    spare = wanted + len(sizes) - sum(parts.values())
    by_remainder = sorted(exact, key=lambda s: (math.floor(exact[s]) - exact[s], s or "", s is None))
    for s in by_remainder[:spare]:
        parts[s] += 1
    return parts


def period(parts: Mapping[str | None, int]) -> dict[str | None, list[int]]:
    """For each source the slots, within one period, of its blocks."""
    length = sum(parts.values())
    order = {s: k for k, s in enumerate(sorted(parts, key=lambda s: (s is not None, s or "")))}
    slots: dict[str | None, list[int]] = {s: [] for s in parts}
    ready: list[tuple[int, int, str | None]] = []
    waiting = [(0, order[s], s) for s in parts]
    heapq.heapify(waiting)
    for slot in range(length):
        while waiting and waiting[0][0] <= slot:
            _, _, s = heapq.heappop(waiting)
            due = -(-(len(slots[s]) + 1) * length // parts[s])
            heapq.heappush(ready, (due, order[s], s))
        _, _, s = heapq.heappop(ready)
        slots[s].append(slot)
        if len(slots[s]) < parts[s]:
            heapq.heappush(waiting, (len(slots[s]) * length // parts[s], order[s], s))
    return slots


def phases(blocks: Mapping[str | None, int], parts: Mapping[str | None, int]) -> list[tuple]:
    """``(source, phase, first, last, parts, period, offset, slots)`` of every phase.

    A source's blocks ``first`` to ``last`` (exclusive) fall into the phase; a phase ends
    with the last block of a source.  One row for each source and phase: independent of
    the number of documents, but it grows with the square of the number of sources.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    rows, offset, phase = [], 0, 0
    while left:
        own = {s: parts[s] for s in left}
        length, slots = sum(own.values()), period(own)
        ends = min(
            (left[s] - 1) // own[s] * length + slots[s][(left[s] - 1) % own[s]] + 1 for s in left
        )
        for s in list(left):
            ran = ends // length * own[s] + sum(slot < ends % length for slot in slots[s])
            rows.append((s, phase, done[s], done[s] + ran, own[s], length, offset, slots[s]))
            done[s] += ran
            left[s] -= ran
            if not left[s]:
                del left[s]
        offset, phase = offset + ends, phase + 1
    return rows


_PHASES = StructType(
    [
        StructField("_phase_source", StringType()),
        *(StructField(name, LongType()) for name in ("_phase", "_first", "_last", "_parts", "_period", "_offset")),
        StructField("_slots", ArrayType(LongType())),
    ]
)


def _placed(documents: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``_row, _id, _source, _size, _place``: characters before a document in its source.

    A source's order is by a hash of id and text.  Running sums are taken within pieces
    of that order, so a source with a third of all rows is many windows, not one.
    """
    pieces = max(1, documents.count() // CHUNK_ROWS)
    bits = pieces.bit_length()
    rows = documents.select(
        F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_row"),
        F.col(id_col).alias("_id"),
        F.col(source_col).cast("string").alias("_source"),
        F.greatest(F.coalesce(F.length(text_col), F.lit(0)), F.lit(1)).cast("bigint").alias("_size"),
        F.xxhash64(F.col(id_col), F.xxhash64(text_col)).alias("_order"),
    ).withColumn("_piece", F.shiftright("_order", 64 - bits))
    key = ["_source", "_piece"]
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("_own", F.coalesce(F.sum("_size").over(before.partitionBy(*key).orderBy("_order", "_id")), F.lit(0)))
    sums = rows.groupBy(*key).agg(F.sum("_size").alias("_sum"))
    ahead = sums.select(
        F.col("_source").alias("_ahead_source"),
        F.col("_piece").alias("_ahead_piece"),
        F.coalesce(F.sum("_sum").over(before.partitionBy("_source").orderBy("_piece")), F.lit(0)).alias("_ahead"),
    )
    met = own["_source"].eqNullSafe(ahead["_ahead_source"]) & (own["_piece"] == ahead["_ahead_piece"])
    return own.join(ahead, met).select("_row", "_id", "_source", "_size", (F.col("_own") + F.col("_ahead")).alias("_place"))


def mixed(
    documents: DataFrame,
    parts: Mapping[str | None, int] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``_row, _id, _source, _block, _phase, _slot, _place`` of every document.

    Sorted by ``_slot`` and ``_place`` the documents are mixed.  A document belongs to the
    block in which it begins; one longer than a block uses up the slots of the blocks
    that it fills.  ``parts`` names an integer weight for each source (1 where it names
    none); without it weights follow the damped sizes.  NULL is a source like any
    other; NULL and empty texts count as one character; repeated rows stay; an empty
    table gives an empty result.  One row per source reaches the driver.
    """
    spark = documents.sparkSession
    size = F.greatest(F.coalesce(F.length(text_col), F.lit(0)), F.lit(1)).cast("bigint")
    totals = documents.groupBy(F.col(source_col).cast("string").alias("_source")).agg(F.sum(size).alias("_size"))
    sizes = {row["_source"]: row["_size"] for row in totals.collect()}
    chosen = default_parts(sizes) if parts is None else {s: parts.get(s, 1) for s in sizes}
    blocks = {s: -(-n // block_chars) for s, n in sizes.items()}
    table = spark.createDataFrame(phases(blocks, chosen), _PHASES)
    placed = _placed(documents, id_col, text_col, source_col).withColumn("_block", F.expr(f"_place div {block_chars}"))
    own = F.col("_source").eqNullSafe(F.col("_phase_source"))
    within = (F.col("_first") <= F.col("_block")) & (F.col("_block") < F.col("_last"))
    slot = "_offset + (_block - _first) div _parts * _period + _slots[cast((_block - _first) % _parts as int)]"
    # sources times phases: known to be small, as is what came to the driver for it
    return placed.join(F.broadcast(table), own & within).select(
        "_row", "_id", "_source", "_size", "_block", "_phase", F.expr(f"{slot} as _slot"), "_place"
    )


def in_mixed_order(documents: DataFrame, **options) -> DataFrame:
    """The documents with their columns, sorted as mixed: part files follow each other."""
    keys = ["_slot", "_place", "_id"]
    return mixed(documents, **options).repartitionByRange(*keys).sortWithinPartitions(*keys).select("_row.*")


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule of ``documents``: block, phase, slot and place of every document."""
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        F.col("_id").alias("doc_id"),
        F.col("_source").alias("source"),
        F.col("_size").alias("size"),
        F.col("_block").alias("block"),
        F.col("_phase").alias("phase"),
        F.col("_slot").alias("slot"),
        F.col("_place").alias("place"),
    )
