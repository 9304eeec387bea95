from datetime import datetime

import pytest

from archive_files import record, write
from cardex.operators.tables import read_contacts
from cardex.operators.versions import read_version
from cardex.plans import job
from cardex.sources import ledger


def names(df):
    return [r.path.rsplit("/", 1)[1] for r in df.collect()]


def add(root, *numbers):
    for i in numbers:
        write(root, str(i % 2), f"{i}.warc.gz", record(b"a%d@x.org" % i, f"r{i}"))


def test_each_listing_takes_the_next(spark, tmp_path):
    root, path = str(tmp_path / "root"), str(tmp_path / "ledger")
    add(root, 0, 1, 2, 3, 4)
    seen = []
    for run in range(3):
        taken = ledger.next_archives(spark, root, "CRAWL", path, 2)
        first, again = names(taken), names(taken)
        assert first == again
        seen += first
        ledger.finish(spark.createDataFrame(taken.collect(), taken.schema), path, f"run{run}")
    assert seen == ["0.warc.gz", "2.warc.gz", "4.warc.gz", "1.warc.gz", "3.warc.gz"]
    assert ledger.next_archives(spark, root, "CRAWL", path, 2).isEmpty()
    assert {(r.run, r.archives) for r in ledger.runs(spark, path).collect()} == {
        ("run0", 2), ("run1", 2), ("run2", 1)
    }
    # a new archive, and one that was written again
    add(root, 6)
    write(root, "1", "1.warc.gz", record(b"longer than before", "r1"))
    assert sorted(names(ledger.next_archives(spark, root, "CRAWL", path))) == ["1.warc.gz", "6.warc.gz"]
    assert ledger.next_archives(spark, root, "UNKNOWN", path).isEmpty()


def test_daily_jobs_read_all_archives_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "root")
    add(root, *range(5))

    def run(day, **options):
        return job.run_job(
            spark, root, "CRAWL", str(tmp_path / "out"), str(tmp_path / "table"), limit_files=2,
            run_time=datetime(2024, 1, day), ledger_path=str(tmp_path / "ledger"), **options,
        )

    assert run(1)["records"] == 2

    def fail(*args, **kwargs):
        raise OSError("lost")

    # a run that fails is repeated with the same archives
    monkeypatch.setattr(job, "append_contacts", fail)
    with pytest.raises(OSError):
        run(2)
    monkeypatch.undo()
    assert run(3)["records"] == 2 and run(4)["records"] == 1 and run(5) is None
    stored = read_contacts(spark, str(tmp_path / "table"))
    assert sorted(r.email for r in stored.collect()) == [f"a{i}@x.org" for i in range(5)]


def test_versioned_jobs(spark, tmp_path):
    root, table = str(tmp_path / "root"), str(tmp_path / "table")
    add(root, 0, 1, 2)
    for day, skip in ((1, False), (2, True), (3, False)):
        job.run_job(
            spark, root, "CRAWL", str(tmp_path / "out"), table, limit_files=1, versioned=True,
            run_time=datetime(2024, 1, day), ledger_path=str(tmp_path / "ledger"), skip_bad_files=skip,
        )
    for number in (1, 2, 3):
        assert read_version(spark, table, number).count() == number
    with pytest.raises(ValueError):
        job.run_job(spark, root, "CRAWL", "x", table, table="t", versioned=True)
