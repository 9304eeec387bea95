"""The batch job: archives of a crawl to a contacts snapshot and table."""

import argparse
import logging
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cardex.operators.contacts import contacts
from cardex.operators.enrich import enrich
from cardex.operators.lookup import read_categories, with_categories
from cardex.operators.stats import counted, run_metrics
from cardex.operators.tables import append_contacts, create_contacts_table, write_snapshot
from cardex.operators.versions import load_version
from cardex.schemas import LISTING
from cardex.session import build_session
from cardex.sources.archives import ARCHIVE_SUFFIX, archive_glob, list_archives, read_archives
from cardex.sources.ledger import finish, next_archives
from cardex.sources.quarantine import (
    COUNTED,
    file_counts,
    outcomes,
    pass_contacts,
    rejected,
    store_pass,
)

logger = logging.getLogger(__name__)


def run_job(
    spark: SparkSession,
    archive_root: str,
    crawl_id: str,
    output_path: str,
    table_path: str | None = None,
    limit_files: int | None = None,
    partition_count: int | None = None,
    run_time: datetime | None = None,
    overwrite_run: bool = False,
    metrics_path: str | None = None,
    suffix: str = ARCHIVE_SUFFIX,
    table: str | None = None,
    categories_path: str | None = None,
    categorised_path: str | None = None,
    repair: bool = True,
    skip_bad_files: bool = False,
    skip_long_records: bool = False,
    ledger_path: str | None = None,
    versioned: bool = False,
) -> dict | None:
    """Harvest a crawl; None if it has no archives.

    Contacts are appended to the table, or with ``overwrite_run`` replace what it holds
    of the same month and crawl.  ``table`` names its catalog entry, made before the load
    if it is not there yet (K2).

    With ``categories_path`` (J1) the dimension is read as it is at this run, and the
    contacts with their categories are stored in a folder of the run below
    ``categorised_path``.

    With ``metrics_path`` a JSON row of exact run metrics is stored there in a folder of
    the run, which a retried run replaces.

    Bad files and overlong records fail the job, unless they may be skipped.  What was
    wrong is then stored beside the snapshot by the same pass, see
    ``sources.quarantine``, with the rejected records in a folder of their own, and the
    metrics count it; bodies are repaired in any case.

    With ``ledger_path`` (L1) the run takes only archives that no finished run has read,
    and enters them once all its outputs are stored; ``limit_files`` then means the
    next so many.

    With ``versioned`` the load is published at once and replaces a former load of the
    same run, see ``operators.versions``; such a table has no catalog entry.

    The archives are read once, for the snapshot.  The table is loaded from the
    snapshot, which also takes the place of a cache: losing executors costs no second
    extraction.
    """
    if versioned and table:
        raise ValueError("a versioned table is read by operators.versions, not by a catalog")
    run_time = run_time or datetime.now(timezone.utc)
    run_id = f"{crawl_id}_{run_time:%Y%m%d_%H%M%S}"
    if ledger_path:
        archives = next_archives(spark, archive_root, crawl_id, ledger_path, limit_files, suffix)
        # what is entered in the end is what is read now
        listing = f"{output_path.rstrip('/')}/listing_{run_time:%Y%m%d_%H%M%S}"
        archives.write.mode("overwrite").parquet(listing)
        archives = spark.read.schema(LISTING).parquet(listing)
    else:
        archives = list_archives(spark, archive_root, crawl_id, limit_files, suffix)
    if archives.isEmpty():
        logger.error("no archives found for crawl %s", crawl_id)
        return None
    if limit_files or ledger_path:
        paths = [row.path for row in archives.select("path").collect()]
    else:
        paths = archive_glob(archive_root, crawl_id)

    skipping = skip_bad_files or skip_long_records
    if skipping:
        passed = f"{output_path.rstrip('/')}/pass_{run_time:%Y%m%d_%H%M%S}"
        store_pass(outcomes(spark, paths, suffix, skip_bad_files, skip_long_records), passed)
        found = pass_contacts(spark, passed)
        rejected(spark, passed, archives).write.parquet(passed.replace("/pass_", "/rejected_"))
    else:
        records, records_seen = counted(read_archives(spark, paths, suffix, repair), "records")
        found = contacts(records)
    found, contacts_seen = counted(found, "contacts")
    snapshot = write_snapshot(
        enrich(found, run_time, crawl_id), output_path, run_time, partition_count
    )
    stored = spark.read.parquet(snapshot)
    if table and table_path:
        create_contacts_table(spark, table, table_path)
    if table_path and versioned:
        load_version(stored, table_path, run_id, replace_months=overwrite_run)
    elif table_path:
        append_contacts(stored, table_path, overwrite_run=overwrite_run)
    if table and table_path:
        spark.catalog.recoverPartitions(table)
    if categories_path and categorised_path:
        with_categories(stored, read_categories(spark, categories_path)).write.mode(
            "overwrite"
        ).parquet(f"{categorised_path.rstrip('/')}/run={run_id}")
    counts = {}
    if skipping:
        totals = file_counts(spark, passed, archives)
        counts = totals.agg(*(F.sum(name).alias(name) for name in COUNTED)).first().asDict()
    if metrics_path:
        run = {
            "run_id": run_id,
            "application_id": spark.sparkContext.applicationId,
            "crawl_id": crawl_id,
            "output_path": snapshot,
        }
        run_metrics(stored).withColumns(
            {k: F.lit(v) for k, v in (run | counts).items()}
        ).coalesce(1).write.mode("overwrite").json(f"{metrics_path.rstrip('/')}/run={run_id}")
    if ledger_path:
        finish(archives, ledger_path, run_id)
    result = {
        "run_id": run_id,
        "snapshot": snapshot,
        "records": counts["responses"] if skipping else records_seen.get["rows"],
        "contacts": contacts_seen.get["rows"],
    }
    logger.info("%(records)d records, %(contacts)d contacts in %(snapshot)s", result)
    return result


def parse_arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Harvest contacts of a crawl")
    parser.add_argument("--archive-root", required=True)
    parser.add_argument("--crawl-id", required=True)
    parser.add_argument("--output-path", required=True)
    parser.add_argument("--table-path", help="also load the contacts table here")
    parser.add_argument("--table", help="catalog name of that table")
    parser.add_argument("--metrics-path", help="add a JSON row of run metrics here")
    parser.add_argument("--categories-path", help="stored domain categories to look up")
    parser.add_argument("--categorised-path", help="store contacts with categories here")
    parser.add_argument("--limit-files", type=int, help="first files only")
    parser.add_argument(
        "--partition-count", type=int, help="output partitions; default: sized by Spark"
    )
    parser.add_argument(
        "--overwrite-run",
        action="store_true",
        help="replace the table's rows of this month and crawl instead of appending",
    )
    parser.add_argument(
        "--no-repair",
        dest="repair",
        action="store_false",
        help="bodies are stored plainly and hold no record boundary",
    )
    parser.add_argument(
        "--skip-bad-files",
        action="store_true",
        help="keep what can be read of damaged files, and store what was wrong",
    )
    parser.add_argument(
        "--skip-long-records",
        action="store_true",
        help="leave out records beyond 2 GB instead of failing",
    )
    parser.add_argument("--ledger-path", help="take the next archives that no run has read")
    parser.add_argument(
        "--versioned",
        action="store_true",
        help="publish the load at once in a table of versions",
    )
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse_arguments(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session("cardex")
    try:
        run_job(spark, **vars(args))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
