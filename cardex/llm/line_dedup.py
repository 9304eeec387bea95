"""Operator 3: lines that many documents share are dropped from all of them.

Lines are exploded and hashed, documents counted per hash, and the kept lines of each
document joined again by position.  Only hashes and positions go through the shuffles
of the counting; a document's text moves once, to meet the positions that it loses.
The shared lines are stored: up to a size they are broadcast, beyond it both sides of
the join are shuffled, so that Spark can split the rows of a very common line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardex.llm.common import KEY, ascii_lower, row_key, store, stripped

MIN_CHARS = 1
MIN_DOCUMENTS = 10
# Rows of 16 bytes that may be broadcast; more of them join by a shuffle.
BROADCAST_ROWS = 500_000


def lines_sql(text: str) -> str:
    return f"split(coalesce({text}, ''), '\\n', -1)"


def _hashed(keys: str) -> list:
    """A line's key as 128 bits of hash."""
    return [
        F.expr(f"xxhash64({keys})").alias("_hash"),
        F.expr(f"xxhash64('second', {keys})").alias("_check"),
    ]


def shared_lines(
    documents: DataFrame,
    text_col: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``_hash, _check, documents`` of the keys found in at least ``min_documents`` rows.

    A document is a row; a key counts once in each.  Counts are partially aggregated
    before the shuffle, so a line of every document costs no more than any other.
    """
    keys = f"transform({lines_sql(ascii_lower(text_col))}, l -> {stripped('l')})"
    return (
        documents.select(F.expr(f"explode_outer(array_distinct({keys})) as _key"))
        .where(F.length("_key") >= min_chars)
        .select(*_hashed("_key"))
        .groupBy("_hash", "_check")
        .agg(F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") >= min_documents)
    )


def line_dedup(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``id_col, n_lines, n_dropped, text``: every document without its shared lines.

    A line's key is the line stripped of ASCII white space with A-Z lower-cased.
    NULL and empty texts are one empty line, whose key is too short to be dropped;
    a document that loses all lines has the text ''.  Repeated rows count as documents
    of their own and each get their row; an id may be NULL.  Other columns are ignored.
    """
    shared = store(
        documents.sparkSession,
        shared_lines(documents, text_col, min_documents, min_chars).select("_hash", "_check"),
        "shared-lines",
    )
    if shared.count() <= BROADCAST_ROWS:
        shared = F.broadcast(shared)
    own = documents.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    ).withColumn(KEY, row_key("_id", "_text"))
    places = (
        own.select(KEY, F.expr(f"posexplode_outer({lines_sql(ascii_lower('_text'))}) as (_pos, _line)"))
        .select(KEY, "_pos", F.expr(stripped("_line")).alias("_line"))
        .where(F.length("_line") >= min_chars)
        .select(KEY, "_pos", *_hashed("_line"))
    )
    lost = (
        places.join(shared, ["_hash", "_check"], "left_semi")
        .groupBy(KEY)
        .agg(F.collect_set("_pos").alias("_lost"))
        .withColumnRenamed(KEY, "_lost_key")
    )
    lines = lines_sql("_text")
    kept = (
        f"transform(array_except(sequence(0, size(_lines) - 1), _lost), i -> _lines[i])"
    )
    return (
        own.join(lost, own[KEY].eqNullSafe(lost["_lost_key"]), "left")
        .select("_id", "_text", "_lost", F.expr(f"{lines} as _lines"))
        .select(
            F.col("_id").alias(id_col),
            F.expr("cast(size(_lines) as bigint) as n_lines"),
            F.expr("cast(coalesce(size(_lost), 0) as bigint) as n_dropped"),
            F.expr(f"if(_lost is null, _text, array_join({kept}, '\\n')) as {text_col}"),
        )
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of ``line_dedup`` over ``documents``."""
    done = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


OP3_SQL = r"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
lines AS (
  SELECT r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM rows),
keyed AS (
  SELECT r, doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key FROM keyed WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT r) >= 10),
marked AS (
  SELECT k.*, s.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
