"""Enrichment of contacts: T8 to T11."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardex.functions.extraction import email_domain


def enrich(
    contacts: DataFrame, extraction_date: datetime, source_crawl: str | None = None
) -> DataFrame:
    """Add ``domain``, ``extraction_date`` and, if given, ``source_crawl``.

    ``extraction_date`` is one constant per run and always an argument, so that a
    retried run writes what the first attempt wrote.
    """
    columns = {
        "domain": email_domain("email"),
        "extraction_date": F.lit(extraction_date).cast("timestamp"),
    }
    if source_crawl is not None:
        columns["source_crawl"] = F.lit(source_crawl)
    return contacts.withColumns(columns)
