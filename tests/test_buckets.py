from datetime import datetime
from glob import glob

import pytest

from cardex.operators import buckets
from cardex.operators.lookup import with_categories
from cardex.operators.stats import domain_stats
from cardex.schemas import DOMAIN_CATEGORIES, ENRICHED_CONTACTS

STAMP = datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("buckets"))
    full = []
    for k in range(3000):
        domain = [None, "hot.org", f"d{k % 400}.org"][k % 3]
        full.append((f"u{k % 97}", "f", str(k), "t", f"a{k}@{domain}" if domain else None,
                     None if domain else str(k), "email" if domain else "phone", domain, STAMP))
    spark.createDataFrame(full, ENRICHED_CONTACTS).write.parquet(f"{path}/stored")
    contacts = spark.read.parquet(f"{path}/stored")
    known = [(f"d{k}.org", f"c{k % 7}", "s", k % 2, "FR") for k in range(0, 500, 3)]
    known += [("hot.org", "big", "", 1, "DE"), ("hot.org", "bigger", "", 0, "DE"), (None, "x", "", 1, "")]
    categories = spark.createDataFrame(known, DOMAIN_CATEGORIES)
    buckets.store_by_domain(contacts, categories, "laid", f"{path}/laid", 16)
    return contacts, categories, f"{path}/laid"


def test_equals_the_other_routes(spark, tables):
    contacts, categories, _ = tables
    assert rows(buckets.categorised(spark, "laid").select(*contacts.columns, "category", "is_business")) == rows(
        with_categories(contacts, categories).select(*contacts.columns, "category", "is_business")
    )
    assert rows(buckets.domain_stats_by_bucket(spark, "laid")) == rows(domain_stats(contacts))


def shuffles(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_nothing_is_shuffled(spark, tables):
    assert shuffles(buckets.categorised(spark, "laid")) == 0
    assert shuffles(domain_stats(spark.table("laid_contacts"))) == 0


def test_no_bucket_is_hot(spark, tables):
    _, _, path = tables
    assert spark.table("laid_apart").where("domain = 'hot.org'").count() == 1000
    assert spark.table("laid_apart").where("domain is null").count() == 1000
    assert len(glob(f"{path}/contacts/*.parquet")) <= 16
    per_bucket = spark.table("laid_contacts").groupBy("_metadata.file_name").count()
    assert max(r["count"] for r in per_bucket.collect()) < 4 * 1000 / 16


def test_empty(spark, tables, tmp_path):
    contacts, categories, _ = tables
    buckets.store_by_domain(contacts.where("false"), categories, "nothing", str(tmp_path), 4)
    assert buckets.categorised(spark, "nothing").collect() == []
    buckets.store_by_domain(contacts, categories.where("false"), "nothing", str(tmp_path), 4)
    assert buckets.categorised(spark, "nothing").where("category <> ''").collect() == []
    assert buckets.categorised(spark, "nothing").count() == 3000
