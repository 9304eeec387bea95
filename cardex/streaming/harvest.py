"""Incremental harvest of archives and incremental domain statistics: ST1, ST2.

Every micro-batch of a stream owns one folder of the contacts table and adds to the
stream's merged statistics.  A stream is known by the id that Spark keeps in its
checkpoint, so any number of crawls, each with its own checkpoint, fill one table.  A
batch that is retried replaces what it stored, so a crash between writing and committing
has no effect on the result, whatever the extraction date of the retry.

A new checkpoint is a new stream: it harvests all files of its crawl again and adds
their contacts to what other streams stored.  Where a checkpoint was lost, name the
streams to read, and leave the one out whose place the new one takes.
"""

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cardex.operators.contacts import contacts
from cardex.operators.enrich import enrich
from cardex.operators.lookup import read_categories, with_categories
from cardex.operators.stats import url_partials
from cardex.operators.tables import ROWS_PER_FILE, table_rows
from cardex.schemas import CONTACTS_TABLE, TABLE_ORDER, TABLE_PARTITIONS
from cardex.sources.archives import (
    ARCHIVE_SUFFIX,
    BOUNDARY,
    archive_glob,
    records_from_lines,
)
from cardex.storage import existing_table
from cardex.streaming.merged import add_batch, merged_domain_stats

FILES_PER_BATCH = 100


def stream_archives(
    spark: SparkSession,
    root: str,
    crawl_id: str,
    files_per_batch: int | None = None,
    suffix: str = ARCHIVE_SUFFIX,
    repair: bool = True,
    skip_bad_files: bool = False,
    skip_long_records: bool = False,
) -> DataFrame:
    """Records (D1) of the archives a checkpoint has not seen yet.

    A file is a task, so by default a batch has enough files for every core.  A file
    that cannot be read to its end fails the batch, which the next run repeats; with
    ``skip_bad_files`` the checkpoint marks it as done all the same.
    """
    if files_per_batch is None:
        files_per_batch = max(FILES_PER_BATCH, 4 * spark.sparkContext.defaultParallelism)
    lines = (
        spark.readStream.format("text")
        .option("lineSep", BOUNDARY)
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", str(skip_bad_files).lower())
        .option("maxFilesPerTrigger", files_per_batch)
        # files may be listed long after they were written
        .option("maxFileAge", "36500d")
        .load(archive_glob(root, crawl_id))
    )
    return records_from_lines(lines, repair, skip_long_records)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of a checkpoint's stream, kept there by Spark from its first start on."""
    (row,) = spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).collect()
    return json.loads(row.value)["id"]


def _batch_folder(path: str, stream: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/harvest_stream={stream}/harvest_batch={batch_id}"


def harvest(
    records: DataFrame,
    crawl_id: str,
    table_path: str,
    checkpoint: str,
    extraction_date: datetime,
    stats_path: str | None = None,
    categories_path: str | None = None,
    categorised_path: str | None = None,
) -> StreamingQuery:
    """ST1: load the contacts of all records not yet harvested, then stop.

    With ``stats_path`` also ST2: each batch adds its counters per (domain,
    extraction_date, url) to the merged ones, see ``streaming.merged``.  They are made
    from the stored contacts of the batch, so the extraction runs once.  With
    ``categories_path`` (J1b) the dimension is read anew for every batch, and the batch's
    contacts with their categories are stored below ``categorised_path``.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = stream_id(spark, checkpoint)
        rows = table_rows(enrich(contacts(batch), extraction_date, crawl_id))
        folder = _batch_folder(table_path, stream, batch_id)
        (
            rows.hint("rebalance")
            .sortWithinPartitions(*TABLE_PARTITIONS, *TABLE_ORDER)
            .write.partitionBy(*TABLE_PARTITIONS)
            .option("maxRecordsPerFile", ROWS_PER_FILE)
            .option("partitionOverwriteMode", "static")
            .mode("overwrite")
            .parquet(folder)
        )
        stored = spark.read.schema(CONTACTS_TABLE).parquet(folder)
        if stats_path:
            add_batch(url_partials(stored), stats_path, stream, batch_id)
        if categories_path and categorised_path:
            with_categories(stored, read_categories(spark, categories_path)).write.mode(
                "overwrite"
            ).parquet(_batch_folder(categorised_path, stream, batch_id))

    return (
        records.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def harvested_contacts(
    spark: SparkSession, table_path: str, streams: list[str] | None = None
) -> DataFrame:
    """ST1: everything harvested so far, or by the named streams only."""
    whole = StructType([*CONTACTS_TABLE.fields, *StructType().add("harvest_stream", "string")])
    rows = existing_table(spark, table_path, whole)
    if streams is not None:
        rows = rows.where(F.col("harvest_stream").isin(streams))
    return rows.select(CONTACTS_TABLE.names)


def harvested_domain_stats(
    spark: SparkSession, stats_path: str, streams: list[str] | None = None
) -> DataFrame:
    """ST2: exact domain statistics of everything harvested so far.

    The folders to read grow with the logarithm of the number of batches.
    """
    return merged_domain_stats(spark, stats_path, streams)
