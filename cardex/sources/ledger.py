"""Resumable listing of archives: L1 for scheduled runs.

A ledger holds the archives that finished runs have read.  A run's listing leaves those
out before its limit is taken, so each daily run with a limit of ``n`` takes the next
``n`` archives, and all are read once.  An archive is entered after the run's results
are stored: a run that failed, and is repeated, takes the same archives again.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cardex.schemas import LISTING
from cardex.sources.archives import ARCHIVE_SUFFIX, list_archives, same_path
from cardex.storage import existing_table


def finished_archives(spark: SparkSession, ledger_path: str) -> DataFrame:
    """``path, length, modificationTime`` of every archive in the ledger."""
    return existing_table(spark, ledger_path, LISTING)


def next_archives(
    spark: SparkSession,
    root: str,
    crawl_id: str,
    ledger_path: str,
    limit: int | None = None,
    suffix: str = ARCHIVE_SUFFIX,
) -> DataFrame:
    """L1: the first archives by path that no finished run has read.

    ``limit`` None or 0 means all that are left.  An archive whose length has changed
    since it was read is another one.  Listing and ledger are joined as tables; a large
    ledger is not brought to the driver.
    """
    files = list_archives(spark, root, crawl_id, suffix=suffix).withColumn("_path", same_path("path"))
    done = finished_archives(spark, ledger_path).select(same_path("path").alias("_path"), "length")
    left = files.join(done, ["_path", "length"], "left_anti").select(LISTING.names)
    return left.orderBy("path").limit(limit) if limit else left


def finish(archives: DataFrame, ledger_path: str, run_id: str) -> None:
    """Enter a run's archives.  A repeated run replaces its own entry.

    Give it the stored listing that the run has read; a listing made anew may hold
    archives that came since.
    """
    archives.select(LISTING.names).coalesce(1).write.mode("overwrite").parquet(
        f"{ledger_path.rstrip('/')}/run={run_id}"
    )


def runs(spark: SparkSession, ledger_path: str) -> DataFrame:
    """``run, archives, bytes`` of every finished run."""
    entries = existing_table(
        spark, ledger_path, StructType([*LISTING.fields, StructField("run", StringType())])
    )
    return entries.groupBy("run").agg(
        F.count(F.lit(1)).alias("archives"), F.sum("length").alias("bytes")
    )
