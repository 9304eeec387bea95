"""Domain categories looked up for contacts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardex.schemas import DOMAIN_CATEGORIES

ATTRIBUTES = ["category", "subcategory", "is_business", "country_code"]
DEFAULTS = {"category": "", "subcategory": "", "is_business": 0, "country_code": ""}

# Bytes of values; as a hash table in each executor they take several times as many.
BROADCAST_BYTES = 32 * 1024 * 1024
# Domains looked up apart, for each shuffle partition: any other domain then has less
# than this fraction of what a partition holds on average.
HOT_PER_PARTITION = 4


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """The stored dimension as it is now; read it anew for each run."""
    return spark.read.schema(DOMAIN_CATEGORIES).parquet(path)


def one_row_per_domain(categories: DataFrame) -> DataFrame:
    """The dimension with unique keys: of duplicates, the greatest attributes win."""
    best = F.max(F.struct(*ATTRIBUTES)).alias("best")
    return (
        categories.where("domain is not null")
        .groupBy("domain")
        .agg(best)
        .select("domain", "best.*")
    )


def stored_bytes(categories: DataFrame) -> int:
    """Bytes of the dimension's values (4 for the flag), counted by a Spark job."""
    texts = ["domain", "category", "subcategory", "country_code"]
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(4))
    return categories.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def with_categories(
    contacts: DataFrame, categories: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Contacts with their domain's attributes; absent keys get '' and 0.

    The dimension's size is measured first.  Up to ``broadcast_bytes`` it is broadcast
    and the contacts are not shuffled; beyond that the join shuffles, with the hottest
    domains and the rows without a domain kept apart (see ``_shuffled``).  A left join
    on unique keys never multiplies contacts.
    """
    dimension = one_row_per_domain(categories)
    if stored_bytes(categories) <= broadcast_bytes:
        joined = contacts.join(F.broadcast(dimension), "domain", "left")
    else:
        joined = _shuffled(contacts, dimension)
    return joined.select(*contacts.columns, *ATTRIBUTES).na.fill(DEFAULTS)


def _shuffled(contacts: DataFrame, dimension: DataFrame) -> DataFrame:
    """Left join with a dimension too large to broadcast.

    The most frequent domains, ``HOT_PER_PARTITION`` for each shuffle partition, are
    looked up by a broadcast of at most that many rows; every other domain then holds
    less than a fraction of what a shuffle partition takes on average.  Rows of hot
    domains and rows without a domain have no partner in the shuffled dimension; they
    get keys that spread them over all partitions and, holding an "@", equal no domain.
    Which domains count as hot only decides the route, never the result.

    Give it stored contacts: counting domains reads them once more (one column).
    """
    partitions = int(contacts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = (
        contacts.where("domain is not null")
        .groupBy("domain")
        .count()
        .orderBy(F.desc("count"), "domain")
        .limit(HOT_PER_PARTITION * partitions)
        .select("domain")
    )
    hot_rows = hot.join(dimension, "domain", "left").select(
        "domain", F.lit(True).alias("_hot"), F.struct(*ATTRIBUTES).alias("_hot_found")
    )
    cold_rows = dimension.where(~F.contains("domain", F.lit("@"))).select(
        F.col("domain").alias("_key"), F.struct(*ATTRIBUTES).alias("_cold_found")
    )
    scattered = F.concat(
        F.lit("@"), F.xxhash64("url", "warc_record_id", "email", "phone_number")
    )
    cold = F.col("domain").isNotNull() & F.col("_hot").isNull()
    return (
        contacts.join(F.broadcast(hot_rows), "domain", "left")
        .withColumn("_key", F.when(cold, F.col("domain")).otherwise(scattered))
        .join(cold_rows, "_key", "left")
        .withColumn("_found", F.coalesce("_hot_found", "_cold_found"))
        .select(*contacts.columns, *(F.col(f"_found.{a}").alias(a) for a in ATTRIBUTES))
    )
