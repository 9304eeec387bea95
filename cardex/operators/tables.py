"""Stored contacts: K1 to K4 and the storage order O1."""

import math
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from cardex.schemas import CONTACTS_TABLE, TABLE_ORDER, TABLE_PARTITIONS

ROWS_PER_FILE = 1_000_000
# Ranges come out unequal.
SLACK = 1.25
# Columns that are looked up by value and not sorted by, so that readers cannot skip by
# their bounds alone; files hold Bloom filters of them.
LOOKED_UP = ("email", "phone_number")
# Months are those of the session that wrote a row; another session's time zone may put
# a moment into a neighbouring month.
ZONES = timedelta(hours=26)


def write_snapshot(
    contacts: DataFrame,
    output_path: str,
    run_time: datetime,
    partition_count: int | None = None,
) -> str:
    """K1: contacts as Parquet in ``{output_path}/contacts_{YYYYmmdd_HHMMSS}``.

    Fails if the folder exists.  Without ``partition_count`` Spark sizes the files from
    the data it finds at run time (small outputs coalesced, large ones split).
    """
    path = f"{output_path.rstrip('/')}/contacts_{run_time:%Y%m%d_%H%M%S}"
    if partition_count:
        spread = contacts.repartition(partition_count)
    else:
        spread = contacts.hint("rebalance")
    spread.write.mode("errorifexists").parquet(path)
    return path


def table_rows(contacts: DataFrame) -> DataFrame:
    """Enriched contacts as rows of the contacts table, which holds no NULL contact."""
    filled = {name: F.coalesce(name, F.lit("")) for name in TABLE_ORDER}
    return (
        contacts.withColumns(filled)
        .withColumn("ym", F.date_format("extraction_date", "yyyyMM"))
        .select(CONTACTS_TABLE.names)
    )


def sorted_writer(
    contacts: DataFrame, batch_size: int = ROWS_PER_FILE, partitions: int | None = None
) -> DataFrameWriter:
    """O1: a writer of table rows by month and crawl, ranged and sorted in every file.

    Files skip by domain through their order, and by e-mail or phone number through
    Bloom filters (a column of few values keeps its dictionary instead, which serves
    the same).
    """
    keys = [*TABLE_PARTITIONS, *TABLE_ORDER, "url", "warc_record_id"]
    ranges = partitions
    if ranges is None:
        ranges = max(math.ceil(SLACK * contacts.count() / batch_size), 1)
    writer = (
        table_rows(contacts)
        .repartitionByRange(ranges, *keys)
        .sortWithinPartitions(*keys)
        .write.partitionBy(*TABLE_PARTITIONS)
        .option("maxRecordsPerFile", batch_size)
        .option("parquet.bloom.filter.adaptive.enabled", "true")
    )
    for name in LOOKED_UP:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    return writer


def append_contacts(
    contacts: DataFrame,
    table_path: str,
    batch_size: int = ROWS_PER_FILE,
    overwrite_run: bool = False,
    partitions: int | None = None,
) -> None:
    """K3, O1: load enriched contacts, sorted inside each file of each partition.

    Rows are ranged by the storage order and then by URL and record, so that neither
    the many rows without a domain nor one very frequent address end up in one task,
    and every file covers a narrow range of domains for readers to skip by.  The number
    of ranges follows from the rows and ``batch_size``, the most rows of a file, unless
    ``partitions`` gives it.

    Give it stored contacts: counting them takes only file footers, and the ranges are
    found by sampling.  A lazy extraction would run for each of these again.

    Appending twice stores the rows twice.  With ``overwrite_run`` the rows replace
    those of the same month and crawl, so a retried run has no further effect.
    """
    writer = sorted_writer(contacts, batch_size, partitions)
    if overwrite_run:
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    else:
        writer = writer.mode("append")
    writer.parquet(table_path)


def within(since: datetime | None = None, until: datetime | None = None) -> Column:
    """Condition on ``extraction_date``, ``until`` exclusive, and so on the months.

    Spark prunes folders by ``ym`` only, which it does not derive from a date: the
    months that the range may touch in any time zone are part of the condition.
    """
    found = F.lit(True)
    if since is not None:
        found &= (F.col("extraction_date") >= F.lit(since)) & (F.col("ym") >= _month(since - ZONES))
    if until is not None:
        found &= (F.col("extraction_date") < F.lit(until)) & (F.col("ym") <= _month(until + ZONES))
    return found


def _month(when: datetime) -> str:
    if when.tzinfo is not None:
        when = when.astimezone(timezone.utc)
    return f"{when:%Y%m}"


def read_contacts(
    spark: SparkSession,
    table_path: str,
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """The contacts table; filters on ``ym`` and ``source_crawl`` prune partitions.

    With ``since`` and ``until`` (exclusive) only contacts extracted between them, from
    the folders of their months.
    """
    rows = spark.read.schema(CONTACTS_TABLE).parquet(table_path)
    return rows if since is None and until is None else rows.where(within(since, until))


def lookup_contacts(
    contacts: DataFrame, email: str | None = None, phone_number: str | None = None
) -> DataFrame:
    """Rows of the contacts table with an address or a number, in any domain.

    Files and row groups whose Bloom filters do not know the value are not read.
    """
    given = {"email": email, "phone_number": phone_number}
    for name, value in given.items():
        if value is not None:
            contacts = contacts.where(F.col(name) == value)
    return contacts


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def create_contacts_table(spark: SparkSession, table: str, table_path: str) -> None:
    """K2: the catalog entry, if not there yet, over what the path holds.

    ``table`` may name its database, which is created too.  Call it again after loads to
    make new partitions known.
    """
    database, _, _ = table.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    # makes the folder, which recovering partitions needs
    nothing = spark.createDataFrame([], CONTACTS_TABLE)
    nothing.write.partitionBy(*TABLE_PARTITIONS).mode("append").parquet(table_path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CONTACTS_TABLE)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
        f" PARTITIONED BY ({', '.join(TABLE_PARTITIONS)}) LOCATION '{_quoted(table_path)}'"
    )
    spark.catalog.recoverPartitions(table)


def query_contacts(
    spark: SparkSession,
    table_path: str,
    query: str,
    view: str = "contacts",
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """K4: any SQL query over the stored table, which it names as ``view``.

    The view holds what was extracted between ``since`` and ``until``, if given.
    """
    read_contacts(spark, table_path, since, until).createOrReplaceTempView(view)
    return spark.sql(query)


def register_contacts_between(
    spark: SparkSession, view: str, function: str = "contacts_between"
) -> None:
    """K4 for SQL users: ``contacts_between(since, until)`` over a table or view.

    A table function with the rows extracted from ``since`` to before ``until``.  Called
    with constants it reads the folders of their months only::

        SELECT domain, count(*) FROM contacts_between(DATE'2024-01-01', DATE'2024-03-01')
        GROUP BY domain
    """
    hours = int(ZONES.total_seconds() // 3600)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CONTACTS_TABLE)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {function}(since TIMESTAMP, until TIMESTAMP)"
        f" RETURNS TABLE({columns}) RETURN"
        f" SELECT {', '.join(CONTACTS_TABLE.names)} FROM {view}"
        f" WHERE extraction_date >= {function}.since AND extraction_date < {function}.until"
        f" AND ym >= date_format({function}.since - INTERVAL {hours} HOURS, 'yyyyMM')"
        f" AND ym <= date_format({function}.until + INTERVAL {hours} HOURS, 'yyyyMM')"
    )
