"""Domain statistics of a stream that knows the URLs it has seen: ST2 with keyed state.

The state store holds the URLs of every (domain, extraction_date); a batch adds to the
stored statistics how many contacts it has and how many of its URLs are new.  These
counters are additive, so neither a batch nor a reader opens URLs of earlier batches:
what is stored has one row per domain and date for each folder, not one per URL.

The state is keyed by domain, date and URL, so a domain with a third of all contacts is
spread over all tasks.  It lies in the RocksDB store, on disk where it exceeds memory,
and is committed with the batch: a batch that failed is repeated from the state before
it, and replaces what it stored.  A batch's contacts are read twice, once for their URLs
and once for the counters, so stream stored contacts, of which these columns are few.
"""

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardex.operators.stats import DOMAIN_KEY
from cardex.schemas import DOMAIN_STATS
from cardex.streaming.harvest import stream_id
from cardex.streaming.merged import add_batch, live_folders

_COUNTERS = ["contact_count", "email_count", "phone_count", "unique_urls"]
_STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _counters(**counted: Column) -> list[Column]:
    return [counted.get(c, F.lit(0)).cast("bigint").alias(c) for c in _COUNTERS]


def added_domain_stats(contacts: DataFrame, lifetime: timedelta | None = None) -> DataFrame:
    """What each batch of a stream of ``contacts`` adds to ``domain_stats``, to be summed.

    Contacts without a domain count under '', a NULL URL is none.  The state forgets the
    URLs of a date once contacts of a date later by ``lifetime`` were seen; contacts of a
    forgotten date still count, but their URLs count no more.  Without ``lifetime``
    nothing is forgotten, and the state grows with the number of URLs.
    """
    keyed = contacts.withColumn("domain", F.coalesce("domain", F.lit("")))
    kind = F.col("contact_type")
    counts = keyed.select(
        *DOMAIN_KEY,
        *_counters(
            contact_count=F.lit(1),
            email_count=F.when(kind == "email", 1).otherwise(0),
            phone_count=F.when(kind == "phone", 1).otherwise(0),
        ),
    )
    urls = keyed.select(*DOMAIN_KEY, "url").where(F.col("url").isNotNull())
    if lifetime is not None:
        urls = urls.withWatermark("extraction_date", f"{int(lifetime.total_seconds())} seconds")
    new = urls.dropDuplicates([*DOMAIN_KEY, "url"])
    return counts.unionByName(new.select(*DOMAIN_KEY, *_counters(unique_urls=F.lit(1))))


def summed_domain_stats(added: DataFrame) -> DataFrame:
    return added.groupBy(*DOMAIN_KEY).agg(*(F.sum(c).alias(c) for c in _COUNTERS))


def stream_stats(
    contacts: DataFrame,
    stats_path: str,
    checkpoint: str,
    lifetime: timedelta | None = None,
) -> StreamingQuery:
    """ST2: add all contacts not yet counted to the statistics below ``stats_path``, then stop."""

    def store(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(batch.sparkSession, checkpoint)
        add_batch(
            summed_domain_stats(batch),
            stats_path,
            stream,
            batch_id,
            schema=DOMAIN_STATS,
            summed=summed_domain_stats,
        )

    spark = contacts.sparkSession
    before = {name: spark.conf.get(name, None) for name in _STATE_SETTINGS}
    for name, value in _STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        # the query keeps the settings of its start
        return (
            added_domain_stats(contacts, lifetime)
            .writeStream.foreachBatch(store)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def streamed_domain_stats(
    spark: SparkSession, stats_path: str, streams: list[str] | None = None
) -> DataFrame:
    """ST2: exact ``domain_stats`` of all contacts counted so far, or of the named streams'."""
    folders = live_folders(spark, stats_path, streams)
    if not folders:
        return summed_domain_stats(spark.createDataFrame([], DOMAIN_STATS))
    return summed_domain_stats(spark.read.schema(DOMAIN_STATS).parquet(*folders))
