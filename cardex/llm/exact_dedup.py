"""Operator 13: exact duplicates, frequent digests handled apart.

Every text becomes a digest.  Misra-Gries counters in each task name the digests that
may be frequent; their true sizes and winners are then counted exactly, and those found
frequent are broadcast, so the copies of a large group are decided where they lie and
never meet in one task.  All other digests use an ordinary shuffle, in which no group
holds more than a small share of a partition.

Counters of a task that saw ``n`` rows fall short of the truth by at most
``2 n / (k + 1)``, so with ``k + 1 = 4 c`` every digest of at least ``rows / c`` rows
sums up to at least ``rows / (2 c)``; at most ``2 c`` digests do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardex.llm.common import ascii_lower, discard, store

# A digest is frequent if it has more than this share of an even shuffle partition's rows.
PARTITION_SHARE = 8
# Frequent digests there may be, and so rows of about 100 bytes that are broadcast.
MOST_FREQUENT = 10_000


def reduced(digests: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``k`` of the distinct digests: all counts less the largest one left out.

    This merges Misra-Gries counters: each unit subtracted is taken from ``k + 1``
    digests at once, so all subtractions together are at most rows / (k + 1).
    """
    if len(counts) <= k:
        return digests, counts
    least = np.partition(counts, len(counts) - k - 1)[len(counts) - k - 1]
    left = counts > least
    return digests[left], counts[left] - least


def _counters(k: int):
    """An Arrow function: a task's digests to its ``digest, seen`` counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, "S32"), np.zeros(0, np.int64)
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            column = np.frombuffer(b"".join(batch.column(0).to_pylist()), "V32")
            # void values compare as bytes, and unlike strings keep trailing zeros
            new, counts = np.unique(column, return_counts=True)
            if len(held[0]):
                both = np.concatenate([held[0], new])
                new, at = np.unique(both, return_inverse=True)
                counts = np.bincount(at, np.concatenate([held[1], counts])).astype(np.int64)
            held = reduced(new, counts, k)
        digests, counts = held
        worth = counts > rows // (k + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([d.tobytes() for d in digests[worth]], pa.binary()), pa.array(counts[worth], pa.int64())],
            ["_digest", "_seen"],
        )

    return run


def digest(text_col: str):
    """Column: SHA-256 of the text with A-Z lower-cased; NULL counts as empty."""
    return F.unhex(F.sha2(F.expr(ascii_lower(f"coalesce({text_col}, '')")), 256))


def _rank(id_col: str, text_col: str) -> list:
    """Columns whose larger struct stays: the id (NULL least), then the text as written."""
    return [
        F.col(id_col).isNotNull().alias("known"),
        F.col(id_col).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("written"),
    ]


def frequent(ranked: DataFrame, most: int = MOST_FREQUENT) -> DataFrame:
    """``_digest, _size, _winner`` of every frequent digest of ``_digest, _rank`` rows.

    Frequent are those with at least ``rows / c`` rows, ``c`` being the number of
    shuffle partitions times ``PARTITION_SHARE``, ``most`` at most: no more than ``c``.
    """
    spark = ranked.sparkSession
    rows = ranked.count()
    c = min(most, PARTITION_SHARE * int(spark.conf.get("spark.sql.shuffle.partitions")))
    named = (
        ranked.select("_digest")
        .mapInArrow(_counters(4 * c - 1), "_digest binary, _seen bigint")
        .groupBy("_digest")
        .agg(F.sum("_seen").alias("_seen"))
        .where(F.col("_seen") >= max(2, rows // (2 * c)))
        .select("_digest")
    )
    return (
        ranked.join(F.broadcast(named), "_digest", "left_semi")
        .groupBy("_digest")
        .agg(F.count(F.lit(1)).alias("_size"), F.max("_rank").alias("_winner"))
        .where(F.col("_size") >= max(2, rows // c))
    )


def exact_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, keep_id, group_size, kept, text_sha256`` for every row.

    Texts are equal if identical with A-Z lower-cased; NULL counts as empty, so NULL and
    empty texts are one group.  Of a group one row stays: the largest id, NULL being
    less than any; among rows of one id the text as written decides by its hash, and
    of rows equal in both any single one stays.  A group of NULL ids has ``keep_id``
    NULL.  Other columns are ignored; an empty table gives no rows.  Digests and ids are
    stored once, texts are read once and never shuffled.
    """
    spark = documents.sparkSession
    rank = F.struct(*_rank(id_col, text_col), F.monotonically_increasing_id().alias("row"))
    ranked = store(
        spark,
        documents.select(digest(text_col).alias("_digest"), rank.alias("_rank")),
        "digests",
    )
    large = store(spark, frequent(ranked), "frequent")
    decided = ranked.join(F.broadcast(large), "_digest")
    group = Window.partitionBy("_digest")
    others = ranked.join(F.broadcast(large.select("_digest")), "_digest", "left_anti").select(
        "_digest",
        "_rank",
        F.count(F.lit(1)).over(group).alias("_size"),
        F.max("_rank").over(group).alias("_winner"),
    )
    return decided.unionByName(others).select(
        F.col("_rank.id").alias(id_col),
        F.col("_winner.id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_rank.row") == F.col("_winner.row")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def without_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, one of every group of equal texts, all columns kept.

    Groups, winners and odd rows as in ``exact_duplicates``.  Copies in frequent groups
    are dropped where they are read; what is left is shuffled whole, once.
    """
    spark = documents.sparkSession
    names = [f"_c{k}" for k in range(len(documents.columns))]
    id_name, text_name = (names[documents.columns.index(c)] for c in (id_col, text_col))
    rows = documents.toDF(*names).select(
        "*", digest(text_name).alias("_digest"), F.struct(*_rank(id_name, text_name)).alias("_rank")
    )
    ranked = store(spark, rows.select("_digest", "_rank"), "digests")
    large = store(spark, frequent(ranked), "frequent")
    discard(ranked)
    first = Window.partitionBy("_digest").orderBy(F.desc("_rank"))
    others = (
        rows.join(F.broadcast(large.select("_digest")), "_digest", "left_anti")
        .withColumn("_place", F.row_number().over(first))
        .where("_place = 1")
    )
    # rows equal in id and text may win together: one of them, combined before the shuffle
    winners = (
        rows.join(F.broadcast(large.select("_digest", "_winner")), "_digest")
        .where("_rank = _winner")
        .dropDuplicates(["_digest"])
    )
    return others.select(*names).unionByName(winners.select(*names)).toDF(*documents.columns)


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns of ``exact_duplicates`` over ``documents``."""
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = """
WITH texts AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM texts WINDOW same AS (PARTITION BY text_sha256)
"""
