"""Ordinary tables as archive records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_records(
    table: DataFrame, url: Column, origin: str, record_id: Column, content: Column
) -> DataFrame:
    return table.select(
        url.alias("url"),
        F.lit(origin).alias("warc_filename"),
        record_id.cast("string").alias("warc_record_id"),
        content.alias("content"),
        F.lit(None).cast("string").alias("timestamp"),
    )


def pages_as_records(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` as records."""
    return as_records(pages, F.col("url"), "pages", F.col("page_id"), F.col("html"))


def documents_as_records(documents: DataFrame) -> DataFrame:
    """``documents(doc_id, text, source, ...)`` as records."""
    url = F.concat(F.lit("doc://"), F.col("source"), F.lit("/"), F.col("doc_id"))
    return as_records(documents, url, "documents", F.col("doc_id"), F.col("text"))
