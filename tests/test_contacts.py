from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cardex.functions import patterns as P
from cardex.operators import contacts as C
from cardex.operators.enrich import enrich
from cardex.schemas import CONTACTS, ENRICHED_CONTACTS, RECORDS

STAMP = datetime(2024, 1, 1)


@pytest.fixture
def records(spark):
    rows = [
        (
            "http://shop.invalid/imprint",
            "seg-7.warc.gz",
            "record1",
            "Orders: desk@shop.example.org; hotline +1 (123) 456-7890",
            "2022-06-30T08:00:00Z",
        ),
        (
            "http://blog.invalid/",
            "seg-7.warc.gz",
            "record2",
            "A page with nothing of the kind",
            "2022-06-30T08:00:01Z",
        ),
        (None, None, "record3", "b@x.org a@x.org A@X.org", None),
        ("https://null.org", "test.warc.gz", "record4", None, None),
    ]
    return spark.createDataFrame(rows, RECORDS)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_contacts(records):
    found = C.contacts(records)
    assert found.schema.names == CONTACTS.names
    assert [f.dataType for f in found.schema] == [f.dataType for f in CONTACTS]
    assert rows(
        found, "url", "warc_record_id", "email", "phone_number", "contact_type"
    ) == sorted(
        [
            ("http://shop.invalid/imprint", "record1", "desk@shop.example.org", None, "email"),
            ("http://shop.invalid/imprint", "record1", None, "+11234567890", "phone"),
            ("http://shop.invalid/imprint", "record1", None, "1234567890", "phone"),
            (None, "record3", "a@x.org", None, "email"),
            (None, "record3", "b@x.org", None, "email"),
        ],
        key=repr,
    )


def test_union_of_the_types_equals_single_pass(records):
    both = C.union_contacts(C.email_contacts(records), C.phone_contacts(records))
    assert both.schema == C.contacts(records).schema
    assert rows(both, "*") == rows(C.contacts(records), "*")


def test_union_keeps_duplicates(records):
    emails = C.email_contacts(records)
    assert C.union_contacts(emails, emails).count() == 6


def test_records_with_contacts(records):
    kept = C.records_with_contacts(records)
    assert kept.columns == [*C.PROVENANCE, "emails", "phone_numbers"]
    assert rows(kept, "warc_record_id", "emails", "phone_numbers") == [
        ("record1", ["desk@shop.example.org"], ["+11234567890", "1234567890"]),
        ("record3", ["a@x.org", "b@x.org"], []),
    ]


def test_enrich(records):
    enriched = enrich(C.contacts(records), STAMP, "CRAWL")
    assert enriched.columns == [*ENRICHED_CONTACTS.names, "source_crawl"]
    assert enriched.schema["extraction_date"].dataType.typeName() == "timestamp"
    assert rows(
        enriched.where("warc_record_id = 'record1'"),
        "email",
        "domain",
        "extraction_date",
        "source_crawl",
    ) == [
        ("desk@shop.example.org", "shop.example.org", STAMP, "CRAWL"),
        (None, None, STAMP, "CRAWL"),
        (None, None, STAMP, "CRAWL"),
    ]


def test_source_crawl_is_optional(records):
    assert enrich(C.contacts(records), STAMP).columns == ENRICHED_CONTACTS.names


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PHONE_PATTERNS = [P.DIGIT_RUN, P.INTERNATIONAL, *P.NATIONAL]


@pytest.mark.parametrize(
    "operator, patterns",
    [
        (C.contacts, [P.EMAIL, *PHONE_PATTERNS]),
        (C.records_with_contacts, [P.EMAIL, *PHONE_PATTERNS]),
        (C.email_contacts, [P.EMAIL]),
        (C.phone_contacts, PHONE_PATTERNS),
    ],
)
def test_each_pattern_runs_once_without_python(records, operator, patterns):
    text = plan(operator(records.repartition(2)))
    for pattern in [P.EMAIL, *PHONE_PATTERNS]:
        assert text.count(f" {pattern}, ") == (pattern in patterns)
    assert "Python" not in text


def test_scan_reads_only_needed_columns(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.range(3).select(
        F.col("id").alias("page_id"),
        F.lit("u").alias("url"),
        F.lit("a@b.org").alias("html"),
        F.lit("unused").alias("other"),
    ).write.parquet(path)
    from cardex.operators.stats import domain_stats
    from cardex.sources.tables import pages_as_records

    pages = pages_as_records(spark.read.parquet(path))
    stats = domain_stats(enrich(C.contacts(pages), STAMP))
    assert "ReadSchema: struct<url:string,html:string>" in plan(stats)
