from datetime import datetime

import pytest

from cardex.operators import lookup
from cardex.schemas import DOMAIN_CATEGORIES, ENRICHED_CONTACTS

STAMP = datetime(2024, 1, 1)


def contact(i, domain):
    return (f"u{i}", "f", f"r{i}", None, domain and f"a@{domain}", None, "email", domain, STAMP)


@pytest.fixture
def contacts(spark):
    domains = ["hot.org"] * 50 + ["cold.org", "gone.org", "partial.org"] + [None] * 30
    rows = [contact(i, d) for i, d in enumerate(domains)]
    return spark.createDataFrame(rows, ENRICHED_CONTACTS).repartition(4)


@pytest.fixture
def categories(spark):
    rows = [
        ("hot.org", "news", "b", 1, "DE"),
        ("hot.org", "news", "a", 0, "FR"),
        ("cold.org", "shop", "c", 0, "US"),
        ("partial.org", "misc", None, None, None),
        (None, "nobody", "n", 1, "XX"),
        ("@1", "never", "n", 1, "XX"),
    ]
    return spark.createDataFrame(rows, DOMAIN_CATEGORIES)


def check(joined, contacts):
    assert joined.columns == [*contacts.columns, *lookup.ATTRIBUTES]
    assert joined.count() == contacts.count()
    found = {
        (r.domain, r.category, r.subcategory, r.is_business, r.country_code)
        for r in joined.collect()
    }
    assert found == {
        ("hot.org", "news", "b", 1, "DE"),
        ("cold.org", "shop", "c", 0, "US"),
        ("partial.org", "misc", "", 0, ""),
        ("gone.org", "", "", 0, ""),
        (None, "", "", 0, ""),
    }


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_dimension_is_broadcast(contacts, categories):
    joined = lookup.with_categories(contacts, categories)
    check(joined, contacts)
    assert "BroadcastHashJoin [domain" in plan(joined)
    assert "SortMergeJoin" not in plan(joined)


@pytest.mark.parametrize("hot_domains", [0, 1, 100])
def test_large_dimension_is_shuffled(contacts, categories, monkeypatch, hot_domains):
    monkeypatch.setattr(lookup, "HOT_PER_PARTITION", hot_domains)
    joined = lookup.with_categories(contacts, categories, broadcast_bytes=0)
    check(joined, contacts)


def test_rows_without_partner_are_spread(contacts, categories):
    joined = lookup.with_categories(contacts, categories, broadcast_bytes=0)
    assert "SortMergeJoin [_key" in plan(joined)


def test_empty_dimension(contacts, categories):
    for limit in (lookup.BROADCAST_BYTES, -1):
        joined = lookup.with_categories(contacts, categories.where("false"), limit)
        assert {r.category for r in joined.collect()} == {""}


def test_stored_bytes(categories):
    assert lookup.stored_bytes(categories.where("domain = 'cold.org'")) == 4 + 15
    assert lookup.stored_bytes(categories.where("false")) == 0
