from datetime import datetime

import pytest

from archive_files import record, write
from cardex.operators.tables import read_contacts
from cardex.plans.job import parse_arguments, run_job

NOON = datetime(2024, 1, 1, 12)


def test_job(spark, tmp_path):
    for i in range(3):
        write(
            tmp_path, "1", f"{i}.warc.gz",
            record(b"a@x.org 555-123-4567", f"r{i}"), record(b"none", f"n{i}"),
        )
    output, table = str(tmp_path / "out"), str(tmp_path / "table")
    result = run_job(spark, str(tmp_path), "CRAWL", output, table, run_time=NOON)
    assert result == {
        "run_id": "CRAWL_20240101_120000",
        "snapshot": f"{output}/contacts_20240101_120000",
        "records": 6,
        "contacts": 6,
    }
    stored = read_contacts(spark, table)
    assert {(r.email, r.phone_number, r.domain, r.ym, r.source_crawl) for r in stored.collect()} == {
        ("a@x.org", "", "x.org", "202401", "CRAWL"),
        ("", "5551234567", "", "202401", "CRAWL"),
    }
    # run again, the job appends, or replaces the rows of its month and crawl
    for hour, overwrite_run, rows in ((13, False, 12), (14, True, 6)):
        again = run_job(
            spark,
            str(tmp_path),
            "CRAWL",
            output,
            table,
            run_time=datetime(2024, 1, 1, hour),
            overwrite_run=overwrite_run,
        )
        assert again["contacts"] == 6
        assert read_contacts(spark, table).count() == rows


def test_file_limit(spark, tmp_path):
    for i in range(3):
        write(tmp_path, "1", f"{i}.warc.gz", record(b"a%d@x.org" % i, f"r{i}"))
    result = run_job(
        spark, str(tmp_path), "CRAWL", str(tmp_path / "out"), limit_files=2,
        partition_count=2, run_time=NOON, metrics_path=str(tmp_path / "metrics"),
    )
    found = spark.read.parquet(result["snapshot"])
    assert {r.email for r in found.collect()} == {"a0@x.org", "a1@x.org"}
    metrics = spark.read.json(str(tmp_path / "metrics")).first()
    assert (metrics.contact_count, metrics.unique_emails, metrics.unique_domains) == (2, 2, 1)
    assert (metrics.crawl_id, metrics.output_path) == ("CRAWL", result["snapshot"])


def test_no_archives(spark, tmp_path):
    write(tmp_path, "1", "a.txt", b"x")
    output = tmp_path / "out"
    assert run_job(spark, str(tmp_path), "CRAWL", str(output)) is None
    assert run_job(spark, str(tmp_path), "UNKNOWN", str(output)) is None
    assert not output.exists()


def test_arguments():
    required = "--archive-root r --crawl-id c --output-path o".split()
    args = vars(parse_arguments(required))
    assert args == {
        "archive_root": "r",
        "crawl_id": "c",
        "output_path": "o",
        "table_path": None,
        "limit_files": None,
        "partition_count": None,
        "overwrite_run": False,
        "metrics_path": None,
        "table": None,
        "categories_path": None,
        "categorised_path": None,
        "repair": True,
        "skip_bad_files": False,
        "skip_long_records": False,
        "ledger_path": None,
        "versioned": False,
    }
    options = "--no-repair --skip-bad-files --skip-long-records --table a.b"
    args = parse_arguments([*required, *options.split()])
    assert (args.repair, args.skip_bad_files, args.skip_long_records) == (False, True, True)
    assert args.table == "a.b"
    args = parse_arguments([*required, *"--limit-files 5 --partition-count 7".split()])
    assert (args.limit_files, args.partition_count) == (5, 7)


def test_damaged_files_fail_the_job_or_are_counted(spark, tmp_path):
    write(tmp_path, "1", "good.warc.gz", record(b"a@x.org", "1"))
    write(tmp_path, "1", "bad.warc.gz", b"not gzip")
    metrics = str(tmp_path / "metrics")
    with pytest.raises(Exception):
        run_job(spark, str(tmp_path), "CRAWL", str(tmp_path / "failed"), run_time=NOON)
    for folder in ("out", "again"):
        result = run_job(
            spark, str(tmp_path), "CRAWL", str(tmp_path / folder), run_time=NOON,
            metrics_path=metrics, skip_bad_files=True,
        )
        assert result["contacts"] == 1
    # one row, though the run was repeated
    (row,) = spark.read.json(metrics).collect()
    assert (row.run_id, row.responses, row.incomplete) == ("CRAWL_20240101_120000", 1, 0)
    (bad,) = spark.read.parquet(str(tmp_path / "out" / "rejected_*")).collect()
    assert bad.file_path.endswith("bad.warc.gz") and bad.reason == "unreadable file"


def test_table_and_categories(spark, tmp_path):
    write(tmp_path, "1", "a.warc.gz", record(b"a@x.org b@y.org", "1"))
    categories = str(tmp_path / "categories")
    columns = "domain string, category string, subcategory string, is_business int, country_code string"
    spark.createDataFrame([("x.org", "shop", "", 1, "")], columns).write.parquet(categories)
    run_job(
        spark, str(tmp_path), "CRAWL", str(tmp_path / "out"), str(tmp_path / "it's a table"),
        run_time=NOON, table="job_contacts", categories_path=categories,
        categorised_path=str(tmp_path / "categorised"),
    )
    assert spark.table("job_contacts").count() == 2
    found = spark.read.parquet(str(tmp_path / "categorised"))
    assert {(r.domain, r.category) for r in found.collect()} == {("x.org", "shop"), ("y.org", "")}
