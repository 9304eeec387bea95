import gzip
import random
from pathlib import Path

import pytest

from archive_files import record, write
from cardex.operators.contacts import contacts
from cardex.sources import quarantine as Q
from cardex.sources.archives import archive_glob, archive_report, list_archives, read_archives


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


class Pass:
    def __init__(self, spark, root, path, **options):
        self.spark, self.root, self.path = spark, str(root), str(path)
        Q.store_pass(Q.outcomes(spark, archive_glob(self.root, "CRAWL"), **options), self.path)
        self.files = list_archives(spark, self.root, "CRAWL")

    def contacts(self):
        return rows(Q.pass_contacts(self.spark, self.path))

    def rejected(self):
        found = Q.rejected(self.spark, self.path, self.files).collect()
        return sorted((r.file_path.rsplit("/", 1)[1], r.offset, r.reason, r.kept, r.warc_record_id) for r in found)

    def counts(self):
        return {
            r.path.rsplit("/", 1)[1]: tuple(r[c] for c in Q.COUNTED)
            for r in Q.file_counts(self.spark, self.path, self.files).collect()
        }


@pytest.fixture
def site(tmp_path):
    root = tmp_path / "root"
    whole = [record(b"a@x.org 555-123-4567", "1"), record(b"b@x.org", "2", kind="request"), record(b"c@x.org", "3")]
    write(root, "1", "good.warc.gz", *whole)
    no_type = gzip.compress(b"WARC/1.0\r\nWARC-Record-ID: lost\r\n\r\nd@x.org\r\n\r\n")
    boundary = record(b"x\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\ne@x.org", "4")
    write(root, "1", "mixed.warc.gz", record(b"f@x.org", "5"), no_type, boundary, no_type, record(b"", "6"))
    write(root, "1", "not.warc.gz", b"not gzip")
    write(root, "1", "empty.warc.gz", gzip.compress(b""))
    # cut in a record, and with the end of the last record missing
    bodies = (random.Random(i).randbytes(3000).hex().encode() for i in range(200))
    many = b"".join(record(b, f"m{i}") for i, b in enumerate(bodies))
    write(root, "2", "cut.warc.gz", many[: len(many) // 2])
    short = gzip.decompress(whole[2])[:-10]
    write(root, "2", "short.warc.gz", whole[0], gzip.compress(short))
    return root


def test_outcomes(spark, site, tmp_path):
    found = Pass(spark, site, tmp_path / "pass")
    expected = contacts(read_archives(spark, archive_glob(str(site), "CRAWL"), skip_bad_files=True))
    assert found.contacts() == rows(expected) and len(found.contacts()) > 6
    rejected = found.rejected()
    mixed = gzip.decompress(Path(site, "crawl-data/CRAWL/segments/1/warc/mixed.warc.gz").read_bytes())
    at = [i for i in range(len(mixed)) if mixed.startswith(b"WARC/1.0\r\nWARC-Record-ID", i)]
    assert [(r[1], r[4]) for r in rejected if r[0] == "mixed.warc.gz"] == [(i, "lost") for i in at]
    (cut,) = [r for r in rejected if r[0] == "cut.warc.gz"]
    responses = found.counts()["cut.warc.gz"][0]
    assert 50 < responses < 100 and cut[2:] == (Q.CUT_SHORT, True, f"m{responses - 1}")
    assert [r for r in rejected if r[0] not in ("mixed.warc.gz", "cut.warc.gz")] == [
        ("empty.warc.gz", 0, Q.UNREADABLE_FILE, False, None),
        ("not.warc.gz", 0, Q.UNREADABLE_FILE, False, None),
        ("short.warc.gz", len(gzip.decompress(record(b"a@x.org 555-123-4567", "1"))), Q.CUT_SHORT, True, "3"),
        ("short.warc.gz", len(gzip.decompress(record(b"a@x.org 555-123-4567", "1"))), Q.INCOMPLETE, True, "3"),
    ]
    assert found.counts() == {
        "good.warc.gz": (2, 1, 0, 0, 0, 0),
        "mixed.warc.gz": (3, 0, 0, 2, 0, 0),
        "not.warc.gz": (0,) * 6,
        "empty.warc.gz": (0,) * 6,
        "cut.warc.gz": (responses, 0, 0, 0, 0, 1),
        "short.warc.gz": (2, 0, 1, 0, 0, 1),
    }
    report = archive_report(spark, found.files, archive_glob(str(site), "CRAWL"))
    same = {r.path.rsplit("/", 1)[1]: r.unreadable for r in report.collect()}
    assert same == {name: counts[3] for name, counts in found.counts().items()}


def test_one_scan(spark, site):
    found = Q.outcomes(spark, archive_glob(str(site), "CRAWL"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("MapInArrow") == 1


def test_bad_files_fail_unless_skipped(spark, site, tmp_path):
    with pytest.raises(Exception):
        Pass(spark, site, tmp_path / "pass", skip_bad_files=False)


@pytest.mark.parametrize("size", [1, 2, 3])
def test_places_over_small_batches(spark, tmp_path, size):
    bodies = [b"a%d@x.org" % i for i in range(7)]
    for name in ("a.warc.gz", "b.warc.gz"):
        write(tmp_path / "root", "1", name, *(record(b, f"{name}{i}") for i, b in enumerate(bodies)))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        found = Pass(spark, tmp_path / "root", tmp_path / "pass")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert found.counts() == {n: (7, 0, 0, 0, 0, 0) for n in ("a.warc.gz", "b.warc.gz")}
    lines = spark.read.parquet(f"{tmp_path}/pass/row=line").orderBy("file_path", "offset").collect()
    at = 0
    for i, line in enumerate(lines[:7]):
        assert line.offset == at and line.warc_record_id == f"a.warc.gz{i}"
        assert line.ends == (True if i == 6 else None)
        at += len(gzip.decompress(record(bodies[i], f"a.warc.gz{i}")))


def test_no_lines_at_all(spark, tmp_path):
    write(tmp_path / "root", "1", "not.warc.gz", b"not gzip")
    found = Pass(spark, tmp_path / "root", tmp_path / "pass")
    assert found.contacts() == [] and found.counts() == {"not.warc.gz": (0,) * 6}
    assert [r[2] for r in found.rejected()] == [Q.UNREADABLE_FILE]
