"""Versioned loads of the contacts table: K3 published at once, K1 as of earlier loads.

A load writes a folder of its own, and only then adds a record to the table's log.  The
log says which folders, less which months of them, are the table, so readers see all of
a load or nothing of it, even where it replaces a month that they are reading, and a
load that fails leaves the table as it was.  Loads are numbered; reading as of a number
gives the table as it stood then, until ``expire`` deletes what only older states need.

Loads that run at the same time do not disturb each other: each adds its own record, and
among equal numbers the load's id decides, for all readers alike.
"""

import uuid
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cardex.operators.tables import ROWS_PER_FILE, sorted_writer
from cardex.schemas import CONTACTS_TABLE
from cardex.storage import delete, existing_table, names, publish, published

_RECORD = (
    "number bigint, load_id string, folder string, published timestamp, replaces_months boolean,"
    " partitions array<struct<ym: string, source_crawl: string>>"
)
_STORED = StructType([*CONTACTS_TABLE.fields, StructField("load", StringType())])


class Part(NamedTuple):
    """A load's folder and the months and crawls of it that the table still holds."""

    folder: str
    partitions: frozenset[tuple[str, str]]
    whole: bool


def _log(spark: SparkSession, path: str) -> list[Row]:
    rows = published(spark, f"{path.rstrip('/')}/log", _RECORD)
    return sorted(rows, key=lambda r: (r.number, r.load_id, r.folder))


def visible_parts(log: list[Row], as_of: int | None = None) -> list[Part]:
    """What the table consists of after all loads, or those up to number ``as_of``."""
    parts: dict[str, Part] = {}
    owner: dict[str, str] = {}
    for row in log:
        if as_of is not None and row.number > as_of:
            break
        held = frozenset((p.ym, p.source_crawl) for p in row.partitions)
        for folder, part in list(parts.items()):
            left = part.partitions - held if row.replaces_months else part.partitions
            if owner[folder] == row.load_id or not left:
                del parts[folder]
            elif left != part.partitions:
                parts[folder] = Part(folder, left, False)
        if held:
            parts[row.folder], owner[row.folder] = Part(row.folder, held, True), row.load_id
    return list(parts.values())


def load_version(
    contacts: DataFrame,
    path: str,
    load_id: str,
    replace_months: bool = False,
    batch_size: int = ROWS_PER_FILE,
    partitions: int | None = None,
) -> int:
    """Load enriched contacts and publish them at once; the number of the load.

    A load replaces the one of the same id, so a run that is repeated has no further
    effect.  With ``replace_months`` it also takes the place of all that the table held
    of its months and crawls.  Otherwise it adds to the table.  Give it stored contacts,
    as ``append_contacts``.
    """
    spark, root = contacts.sparkSession, path.rstrip("/")
    folder = uuid.uuid4().hex
    sorted_writer(contacts, batch_size, partitions).parquet(f"{root}/data/load={folder}")
    stored = existing_table(spark, f"{root}/data/load={folder}", CONTACTS_TABLE)
    # one row for each month and crawl, and no column but those of the folders' names
    held = [tuple(r) for r in stored.select("ym", "source_crawl").distinct().collect()]
    number = max((r.number for r in _log(spark, root)), default=0) + 1
    record = (number, load_id, folder, datetime.now(timezone.utc), replace_months, sorted(held))
    publish(spark, f"{root}/log", record, _RECORD)
    return number


def read_version(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """The contacts table after its last load, or after load number ``as_of``.

    Replaced months are left out by conditions on folder names, so nothing of them is
    read; filters on ``ym`` and ``source_crawl`` prune as in the plain table.
    """
    root = path.rstrip("/")
    parts = visible_parts(_log(spark, root), as_of)
    if not parts:
        return spark.createDataFrame([], CONTACTS_TABLE)
    rows = (
        spark.read.schema(_STORED)
        .option("basePath", f"{root}/data")
        .parquet(*(f"{root}/data/load={p.folder}" for p in parts))
    )
    shown = F.lit(False)
    for part in parts:
        here = F.col("load") == part.folder
        if not part.whole:
            months = F.lit(False)
            for ym, crawl in sorted(part.partitions):
                months |= (F.col("ym") == ym) & (F.col("source_crawl") == crawl)
            here &= months
        shown |= here
    if not all(part.whole for part in parts):
        rows = rows.where(shown)
    return rows.select(CONTACTS_TABLE.names)


def load_history(spark: SparkSession, path: str) -> DataFrame:
    """``number, load_id, published, replaces_months, months``: one row for each load."""
    rows = [
        (r.number, r.load_id, r.published, r.replaces_months, len(r.partitions))
        for r in _log(spark, path)
    ]
    schema = "number bigint, load_id string, published timestamp, replaces_months boolean, months int"
    return spark.createDataFrame(rows, schema)


def expire(spark: SparkSession, path: str, before: int) -> list[str]:
    """Delete folders that no state from load ``before`` on shows; their names.

    That includes what failed loads left, so run it while no load is running.
    """
    root = path.rstrip("/")
    log = _log(spark, root)
    states = [before] + [r.number for r in log if r.number > before]
    used = {f"load={p.folder}" for number in states for p in visible_parts(log, number)}
    left = [name for name in names(spark, f"{root}/data") if name.startswith("load=") and name not in used]
    for name in left:
        delete(spark, f"{root}/data/{name}")
    return left
