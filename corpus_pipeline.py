"""A training corpus from ``documents``: filtered, deduplicated, cleared, mixed, encoded.

Each stage calls one operator; what it returns is written as Parquet and read again as
the next one's documents.  All but the last return the columns of documents, extra ones
included, and an empty table for an empty one.  Texts that are NULL, empty or without
words fail the quality rules; the later stages keep them, as they are neither linked
nor contaminated.  Repeated rows with words are a group, of which one stays; NULL ids and
sources are kept.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardex.llm import decontaminate, mixing, ngram_join, quality, tokens
from cardex.session import scratch_dir

# Word shingles and least similarity of near duplicates.
NEAR_SHINGLE = 5
NEAR_SIMILARITY = (80, 100)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the isolation forest keep."""
    forest = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.kept_documents(docs, forest)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the one with the smallest id, as one row."""
    return ngram_join.without_near_duplicates(docs, n=NEAR_SHINGLE, similarity=NEAR_SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, stored in the order of the mix."""
    return mixing.in_mixed_order(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written in the stored order of the documents, and what the files hold.

    Documents that are not read from files are written in ascending order of their ids.
    """
    path = scratch_dir(spark, "corpus")
    order = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    try:
        docs.select(*order)
    except AnalysisException:
        order = None
    tokens.write_tokens(docs, path, tokens.tokenizer_path(), order=order)
    return tokens.token_digest(spark, path)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing_sources),
    ("token-ID / binary output", token_output),
]

# A forest and a tokenizer cannot be put into SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"stage-{name.split()[0]}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
