import re
from datetime import datetime
from glob import glob
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.functions import lit

from cardex.operators import tables
from cardex.operators.contacts import contacts
from cardex.operators.enrich import enrich
from cardex.plans.queries import documents
from conftest import TESTDATA
from cardex.schemas import CONTACTS_TABLE

JANUARY, FEBRUARY = datetime(2024, 1, 1), datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Contacts of a month and crawl, kept as a snapshot."""
    found = contacts(documents(spark, str(TESTDATA / "sf0.01")))

    def make(month, crawl):
        path = str(tmp_path_factory.mktemp("snapshot"))
        snapshot = tables.write_snapshot(enrich(found, month, crawl), path, month)
        return spark.read.parquet(snapshot)

    return {
        (month, crawl): make(month, crawl)
        for month in (JANUARY, FEBRUARY)
        for crawl in ("A", "B")
    }


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_snapshot(spark, stored, tmp_path):
    df = stored[JANUARY, "A"]
    when = datetime(2024, 3, 4, 5, 6, 7)
    path = tables.write_snapshot(df, str(tmp_path), when, partition_count=3)
    assert path == f"{tmp_path}/contacts_20240304_050607"
    assert len(glob(f"{path}/*.parquet")) == 3
    assert rows(spark.read.parquet(path)) == rows(df)
    with pytest.raises(AnalysisException):
        tables.write_snapshot(df, str(tmp_path), when)


def test_table_holds_no_null_contact(stored):
    table = tables.table_rows(stored[JANUARY, "A"])
    assert table.columns == CONTACTS_TABLE.names
    assert table.where("domain = ''").count() > 0
    assert table.where("domain IS NULL OR email IS NULL OR phone_number IS NULL").count() == 0


def test_append_adds_and_overwrite_run_replaces(spark, stored, tmp_path):
    path = str(tmp_path / "table")
    one = stored[JANUARY, "A"].count()
    for key in stored:
        tables.append_contacts(stored[key], path, overwrite_run=True)
    tables.append_contacts(stored[JANUARY, "A"], path, overwrite_run=True)
    table = tables.read_contacts(spark, path)
    assert table.count() == 4 * one
    assert rows(table.select("ym", "source_crawl").distinct()) == [
        ("202401", "A"),
        ("202401", "B"),
        ("202402", "A"),
        ("202402", "B"),
    ]
    tables.append_contacts(stored[JANUARY, "A"], path)
    assert table.sparkSession.read.parquet(path).count() == 5 * one


def test_files_are_sorted_bounded_and_ranged(spark, stored, tmp_path):
    path = str(tmp_path / "table")
    both = stored[JANUARY, "A"].unionByName(stored[FEBRUARY, "B"])
    tables.append_contacts(both, path, batch_size=7, partitions=5)
    files = sorted(glob(f"{path}/*/*/*.parquet"))
    ends = {}
    for file in files:
        keys = [
            tuple(row.values())
            for row in pq.ParquetFile(file)
            .read(["domain", "email", "phone_number"])
            .to_pylist()
        ]
        assert keys == sorted(keys)
        assert len(keys) <= 7
        ends.setdefault(file.rsplit("/", 1)[0], []).append((keys[0], keys[-1]))
    assert len(ends) == 2
    for ranges in ends.values():
        ranges.sort()
        assert len(ranges) > 2
        assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_ranges_follow_from_the_rows(spark, stored, tmp_path):
    contacts = stored[JANUARY, "A"]
    size = contacts.count() // 4
    tables.append_contacts(contacts, str(tmp_path / "sized"), batch_size=size)
    assert 5 <= len(glob(f"{tmp_path}/sized/*/*/*.parquet")) <= 8
    tables.append_contacts(contacts, str(tmp_path / "one"), batch_size=size, partitions=1)
    files = glob(f"{tmp_path}/one/*/*/*.parquet")
    assert len({Path(file).name.split("-")[1] for file in files}) == 1
    assert len(files) in (4, 5)
    assert rows(tables.read_contacts(spark, str(tmp_path / "one"))) == rows(
        tables.read_contacts(spark, str(tmp_path / "sized"))
    )


def test_rows_without_domain_do_not_share_one_task(spark, stored, tmp_path):
    path = str(tmp_path / "table")
    tables.append_contacts(stored[JANUARY, "A"], path, partitions=6)
    holding = [
        file
        for file in glob(f"{path}/*/*/*.parquet")
        if "" in pq.ParquetFile(file).read(["domain"])["domain"].to_pylist()
    ]
    assert len(holding) > 2


def test_query_contacts_prunes_partitions(spark, stored, tmp_path):
    path = str(tmp_path / "table")
    for key in stored:
        tables.append_contacts(stored[key], path)
    found = tables.query_contacts(
        spark,
        path,
        "SELECT source_crawl, count(*) AS n FROM held WHERE ym = '202402' GROUP BY 1",
        view="held",
    )
    assert {r.source_crawl for r in found.collect()} == {"A", "B"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan


def test_catalog_table(spark, stored, tmp_path):
    path = str(tmp_path / "table")
    tables.append_contacts(stored[JANUARY, "A"], path)
    for _ in range(2):
        tables.create_contacts_table(spark, "contact_data.held", path)
    assert spark.table("contact_data.held").schema.names == CONTACTS_TABLE.names
    assert spark.table("contact_data.held").count() == stored[JANUARY, "A"].count()
    tables.append_contacts(stored[FEBRUARY, "A"], path)
    tables.create_contacts_table(spark, "contact_data.held", path)
    assert spark.table("contact_data.held").count() == 2 * stored[JANUARY, "A"].count()
    spark.sql("DROP TABLE contact_data.held")


@pytest.fixture(scope="module")
def months(spark, stored, tmp_path_factory):
    """A table of six months."""
    path = str(tmp_path_factory.mktemp("months") / "table")
    for month in range(1, 7):
        rows_of = stored[JANUARY, "A"].withColumn("extraction_date", lit(datetime(2024, month, 15)))
        tables.append_contacts(rows_of, path)
    return path


def scanned_months(spark, df):
    """The months of the folders that the plan reads, by its partition filters."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    (filters,) = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    return sorted(set(re.findall(r"20240\d", filters)))


def test_dates_prune_months(spark, months):
    since, until = datetime(2024, 2, 10), datetime(2024, 4, 1)
    all_rows = tables.read_contacts(spark, months)
    expected = rows(all_rows.where("extraction_date >= '2024-02-10' AND extraction_date < '2024-04-01'"))
    read = tables.read_contacts(spark, months, since, until)
    assert rows(read) == expected and {r.ym for r in read.collect()} == {"202402", "202403"}
    # April may hold the last hours of March of another time zone
    assert scanned_months(spark, read) == ["202402", "202404"]
    assert rows(tables.read_contacts(spark, months, until=since)) == rows(all_rows.where("ym = '202401'"))
    assert rows(tables.read_contacts(spark, months, since=datetime(2024, 6, 1))) == rows(all_rows.where("ym = '202406'"))
    query = tables.query_contacts(spark, months, "SELECT * FROM c", "c", since, until)
    assert rows(query) == expected

    all_rows.createOrReplaceTempView("six_months")
    tables.register_contacts_between(spark, "six_months")
    called = spark.sql("SELECT * FROM contacts_between(TIMESTAMP'2024-02-10', TIMESTAMP'2024-04-01')")
    assert rows(called) == expected and called.columns == CONTACTS_TABLE.names
    assert scanned_months(spark, called) == ["202402", "202404"]


@pytest.mark.parametrize("zone", ["Pacific/Kiritimati", "Etc/GMT+12"])
def test_dates_in_any_time_zone(spark, months, stored, tmp_path, zone):
    # written by a session of one zone, read by that of another
    before = spark.conf.get("spark.sql.session.timeZone")
    moments = [datetime(2024, 3, 1), datetime(2024, 2, 29, 23, 59), datetime(2024, 3, 31, 23)]
    path = str(tmp_path / "table")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for moment in moments:
            tables.append_contacts(stored[JANUARY, "A"].limit(1).withColumn("extraction_date", lit(moment)), path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    found = tables.read_contacts(spark, path, datetime(2024, 2, 29), datetime(2024, 4, 1))
    assert found.count() == 3


def rows_read(df):
    """Rows that the scan of a collected frame gave to the rest of its plan."""
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return rows_read_of(plan.executedPlan())
    return rows_read_of(plan)


def rows_read_of(plan):
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_lookup_reads_few_row_groups(spark, tmp_path):
    # more values than a dictionary page holds, so that Bloom filters are written
    n, files = 200_000, 20
    path = str(tmp_path / "table")
    people = spark.range(n).selectExpr(
        "'u' AS url", "'f' AS warc_filename", "cast(id AS string) AS warc_record_id", "'t' AS timestamp",
        "if(id % 2 = 0, concat(sha2(cast(id AS string), 256), '@mail.org'), NULL) AS email",
        "if(id % 2 = 1, conv(substring(sha2(cast(id AS string), 256), 1, 12), 16, 10), NULL) AS phone_number",
        "if(id % 2 = 0, 'email', 'phone') AS contact_type",
        "if(id % 2 = 0, concat('d', id % 997), NULL) AS domain",
        "TIMESTAMP'2024-01-01' AS extraction_date", "'C' AS source_crawl",
    )
    tables.append_contacts(people, path, batch_size=n // files, partitions=files)
    table = tables.read_contacts(spark, path)
    (someone,) = people.where("warc_record_id = '4242'").collect()
    (other,) = people.where("warc_record_id = '4243'").collect()
    for given in ({"email": someone.email}, {"phone_number": other.phone_number}):
        found = tables.lookup_contacts(table, **given)
        assert len(found.collect()) == 1
        assert rows_read(found) <= 3 * n // files
    assert tables.lookup_contacts(table, email="nobody@mail.org").collect() == []
