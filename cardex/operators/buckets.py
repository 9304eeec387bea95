"""Contacts and their dimension laid out by domain: J1 and A2 without a shuffle.

Both are stored in as many buckets of domains, sorted, one file for each bucket, so the
lookup joins and the statistics group equal buckets where they lie.  A bucket is a task.
So rows without a domain, and those of domains with more rows than a fraction of a
bucket, do not go there: they are stored apart, evenly spread, and looked up by a
broadcast of their domains' few categories.

The tables belong to the session's catalog, which knows the buckets.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardex.operators.lookup import ATTRIBUTES, DEFAULTS, one_row_per_domain
from cardex.operators.stats import domain_stats

BUCKETS = 200
# A domain with more than an even bucket's rows by this divisor is kept apart.
SHARE = 4


def _bucketed(rows: DataFrame, table: str, path: str, buckets: int) -> None:
    (
        # dealt as the buckets are: a task writes one file
        rows.repartition(buckets, "domain")
        .write.bucketBy(buckets, "domain")
        .sortBy("domain")
        .option("path", path)
        .mode("overwrite")
        .saveAsTable(table)
    )


def store_by_domain(
    contacts: DataFrame, categories: DataFrame, name: str, path: str, buckets: int = BUCKETS
) -> None:
    """Lay out enriched contacts and a dimension as the tables ``name_...`` below ``path``.

    What the tables held is replaced.  Give it stored contacts: domains are counted
    first, which reads one column.  At most ``SHARE * buckets`` domains are frequent.
    """
    limit = contacts.count() // (SHARE * buckets)
    frequent = (
        contacts.where("domain is not null and domain <> ''")
        .groupBy("domain")
        .count()
        .where(F.col("count") > limit)
        .select("domain")
    )
    frequent.write.mode("overwrite").parquet(f"{path}/frequent")
    often = F.broadcast(contacts.sparkSession.read.schema("domain string").parquet(f"{path}/frequent"))
    named = contacts.where("domain is not null and domain <> ''")
    _bucketed(named.join(often, "domain", "left_anti"), f"{name}_contacts", f"{path}/contacts", buckets)
    apart = named.join(often, "domain", "left_semi").select(contacts.columns)
    apart.unionByName(contacts.where("domain is null or domain = ''")).hint("rebalance").write.option(
        "path", f"{path}/apart"
    ).mode("overwrite").saveAsTable(f"{name}_apart")
    dimension = one_row_per_domain(categories)
    _bucketed(dimension, f"{name}_categories", f"{path}/categories", buckets)
    # the categories of the frequent domains, no more rows than those
    dimension.join(often, "domain", "left_semi").write.option("path", f"{path}/frequent_categories").mode(
        "overwrite"
    ).saveAsTable(f"{name}_frequent_categories")


def _found(contacts: DataFrame, categories: DataFrame) -> DataFrame:
    return contacts.join(categories, "domain", "left").select(*contacts.columns, *ATTRIBUTES)


def categorised(spark: SparkSession, name: str) -> DataFrame:
    """J1 over the layout: contacts with their domain's attributes, nothing shuffled."""
    near = _found(spark.table(f"{name}_contacts"), spark.table(f"{name}_categories").hint("merge"))
    apart = _found(spark.table(f"{name}_apart"), F.broadcast(spark.table(f"{name}_frequent_categories")))
    return near.unionByName(apart).na.fill(DEFAULTS)


def domain_stats_by_bucket(spark: SparkSession, name: str) -> DataFrame:
    """A2 over the layout: only the rows kept apart are shuffled, partially aggregated."""
    stats = domain_stats(spark.table(f"{name}_contacts"))
    return stats.unionByName(domain_stats(spark.table(f"{name}_apart")))
