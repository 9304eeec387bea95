from datetime import datetime

import pytest

from cardex.operators import stats
from cardex.schemas import ENRICHED_CONTACTS

STAMP = datetime(2024, 1, 1)


def contact(url, value, kind="email"):
    email, phone = (value, None) if kind == "email" else (None, value)
    domain = email.split("@")[1] if email else None
    return (url, "f", "r", None, email, phone, kind, domain, STAMP)


ROWS = [
    contact("u1", "a@x.org"),
    contact("u1", "b@x.org"),
    contact("u2", "a@x.org"),
    contact("u2", "a@y.org"),
    contact(None, "a@y.org"),
    contact("u1", "5551234567", "phone"),
    contact("u3", "5551234567", "phone"),
]


@pytest.fixture
def contacts(spark):
    return spark.createDataFrame(ROWS, ENRICHED_CONTACTS).repartition(3)


def by_domain(df):
    return {r.domain: tuple(r)[2:] for r in df.collect()}


DOMAIN_STATS = {"x.org": (3, 3, 0, 2), "y.org": (2, 2, 0, 1), None: (2, 0, 2, 2)}


def test_domain_stats(contacts):
    found = stats.domain_stats(contacts)
    assert found.columns == [
        "domain",
        "extraction_date",
        "contact_count",
        "email_count",
        "phone_count",
        "unique_urls",
    ]
    assert by_domain(found) == DOMAIN_STATS


def test_merged_partials_keep_the_counters(contacts, spark):
    halves = [
        stats.domain_partials(spark.createDataFrame(half, ENRICHED_CONTACTS))
        for half in (ROWS[:3], ROWS[3:])
    ]
    merged = stats.merge_domain_partials(halves[0].unionByName(halves[1]))
    assert by_domain(merged) == {k: v[:3] for k, v in DOMAIN_STATS.items()}


def test_merged_url_partials_are_exact(spark):
    # u1 and u2 occur in both halves with the same domain
    halves = [
        stats.url_partials(spark.createDataFrame(half, ENRICHED_CONTACTS))
        for half in (ROWS[::2], ROWS[1::2])
    ]
    merged = stats.merge_url_partials(halves[0].unionByName(halves[1]))
    assert by_domain(merged) == DOMAIN_STATS


def test_contact_type_counts(contacts):
    found = {tuple(r) for r in stats.contact_type_counts(contacts).collect()}
    assert found == {("email", 5), ("phone", 2)}


def test_run_metrics(contacts):
    assert stats.run_metrics(contacts).first().asDict() == {
        "contact_count": 7,
        "email_count": 5,
        "phone_count": 2,
        "unique_urls": 3,
        "unique_domains": 2,
        "unique_emails": 3,
        "unique_phones": 1,
    }


def test_run_metrics_of_nothing(contacts):
    assert set(stats.run_metrics(contacts.where("false")).first()) == {0}


def test_counted(contacts):
    counted, seen = stats.counted(contacts, "rows")
    counted.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 7}


def test_a_hot_domain_is_shuffled_by_url_first(contacts):
    plan = stats.domain_stats(contacts)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert len(exchanges) == 2
    assert "url" in exchanges[1].split("hashpartitioning")[1]
