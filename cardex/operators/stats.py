"""Counts and statistics over contacts: A1 to A4 and M1."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

DOMAIN_KEY = ["domain", "extraction_date"]


def _counters() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("contact_count"),
        F.count_if(F.col("contact_type") == "email").alias("email_count"),
        F.count_if(F.col("contact_type") == "phone").alias("phone_count"),
    ]


def _summed_counters() -> list[Column]:
    names = ["contact_count", "email_count", "phone_count"]
    return [F.sum(name).alias(name) for name in names]


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A1: ``df`` with its rows counted while some action runs; no job of its own.

    Read ``observation.get["rows"]`` after that action.  Stages that Spark repeats after
    losing an executor may count rows again: a figure for logs, not for results.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def domain_stats(contacts: DataFrame) -> DataFrame:
    """A2: exact counts and distinct URLs per (domain, extraction_date).

    Spark plans the distinct count as a first aggregation by (domain, extraction_date,
    url), partial before and final after the shuffle, so a hot domain is spread by URL
    and only its per-partition partial results meet in one task.

    Phones have no domain, so all of them are in the group of the NULL domain (of '' in
    the stored table) and ``phone_count`` is 0 for every real domain.
    """
    return contacts.groupBy(*DOMAIN_KEY).agg(
        *_counters(), F.count_distinct("url").alias("unique_urls")
    )


def domain_partials(contacts: DataFrame, *batch: str) -> DataFrame:
    """Additive counters per domain key and insert batch, the input of A3."""
    return contacts.groupBy(*DOMAIN_KEY, *batch).agg(*_counters())


def merge_domain_partials(partials: DataFrame) -> DataFrame:
    """A3: partials with equal keys summed.

    Only additive counters merge this way; a distinct count would count a URL once per
    batch.  Use ``url_partials`` where that is needed.
    """
    return partials.groupBy(*DOMAIN_KEY).agg(*_summed_counters())


def url_partials(contacts: DataFrame) -> DataFrame:
    """Counters per (domain, extraction_date, url): mergeable into exact ``domain_stats``."""
    return contacts.groupBy(*DOMAIN_KEY, "url").agg(*_counters())


def summed_url_partials(partials: DataFrame) -> DataFrame:
    """A3: ``url_partials`` of several batches as those of one."""
    return partials.groupBy(*DOMAIN_KEY, "url").agg(*_summed_counters())


def merge_url_partials(partials: DataFrame) -> DataFrame:
    """``domain_stats`` of all the contacts that ``partials`` were made from."""
    return partials.groupBy(*DOMAIN_KEY).agg(
        *_summed_counters(), F.count_distinct("url").alias("unique_urls")
    )


def contact_type_counts(contacts: DataFrame) -> DataFrame:
    """A4."""
    return contacts.groupBy("contact_type").count()


def run_metrics(contacts: DataFrame) -> DataFrame:
    """M1: one row of totals and exact distinct counts for a run's contacts.

    The first shuffle is by value, after a partial aggregation, so frequent values cost
    nothing; one partial row per partition goes into the last.
    """
    distinct = {
        "unique_urls": "url",
        "unique_domains": "domain",
        "unique_emails": "email",
        "unique_phones": "phone_number",
    }
    return contacts.agg(
        *_counters(), *(F.count_distinct(c).alias(name) for name, c in distinct.items())
    )
