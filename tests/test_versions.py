from datetime import datetime

import pytest

from cardex.operators import versions
from cardex.schemas import ENRICHED_CONTACTS

JANUARY, FEBRUARY = datetime(2024, 1, 9), datetime(2024, 2, 9)


def contacts(spark, *rows, crawl="A"):
    full = [("u", "f", str(k), "t", mail, None, "email", "x.org", when) for k, (mail, when) in enumerate(rows)]
    return spark.createDataFrame(full, ENRICHED_CONTACTS).selectExpr("*", f"'{crawl}' AS source_crawl")


def mails(df):
    return sorted(r.email for r in df.collect())


def test_versions_side_by_side(spark, tmp_path):
    path = str(tmp_path)
    assert versions.read_version(spark, path).collect() == []
    first = versions.load_version(contacts(spark, ("a", JANUARY), ("b", FEBRUARY)), path, "one")
    second = versions.load_version(contacts(spark, ("c", JANUARY)), path, "two")
    third = versions.load_version(contacts(spark, ("d", JANUARY)), path, "three", replace_months=True)
    assert (first, second, third) == (1, 2, 3)
    assert mails(versions.read_version(spark, path, 1)) == ["a", "b"]
    assert mails(versions.read_version(spark, path, 2)) == ["a", "b", "c"]
    assert mails(versions.read_version(spark, path, 3)) == ["b", "d"]
    assert mails(versions.read_version(spark, path)) == ["b", "d"]
    history = versions.load_history(spark, path).orderBy("number").collect()
    assert [(r.load_id, r.months) for r in history] == [("one", 2), ("two", 1), ("three", 1)]
    # what is replaced is not even listed for reading, and months prune
    read = versions.read_version(spark, path).where("ym = '202401'")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "load=" not in plan or "PartitionFilters: [" in plan
    assert mails(read) == ["d"]
    # only the second load is nothing but replaced
    assert len(versions.expire(spark, path, before=3)) == 1
    assert mails(versions.read_version(spark, path)) == ["b", "d"]


def test_other_crawls_are_not_replaced(spark, tmp_path):
    path = str(tmp_path)
    versions.load_version(contacts(spark, ("a", JANUARY), crawl="A"), path, "one")
    versions.load_version(contacts(spark, ("b", JANUARY), crawl="B:1/%"), path, "two", replace_months=True)
    versions.load_version(contacts(spark, ("c", JANUARY), crawl="B:1/%"), path, "three", replace_months=True)
    assert mails(versions.read_version(spark, path)) == ["a", "c"]


def test_a_repeated_load_replaces_itself(spark, tmp_path):
    path = str(tmp_path)
    versions.load_version(contacts(spark, ("a", JANUARY)), path, "run")
    versions.load_version(contacts(spark, ("other", JANUARY)), path, "other")
    versions.load_version(contacts(spark, ("b", FEBRUARY)), path, "run")
    assert mails(versions.read_version(spark, path)) == ["b", "other"]
    versions.load_version(contacts(spark), path, "run")
    assert mails(versions.read_version(spark, path)) == ["other"]


def test_a_failed_load_is_invisible(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    versions.load_version(contacts(spark, ("a", JANUARY)), path, "one")

    def fail(*args):
        raise OSError("lost")

    monkeypatch.setattr(versions, "publish", fail)
    with pytest.raises(OSError):
        versions.load_version(contacts(spark, ("b", JANUARY)), path, "two", replace_months=True)
    monkeypatch.undo()
    assert mails(versions.read_version(spark, path)) == ["a"]
    assert len(versions.expire(spark, path, before=1)) == 1
    assert versions.load_version(contacts(spark, ("c", JANUARY)), path, "two") == 2
    assert mails(versions.read_version(spark, path)) == ["a", "c"]


def test_a_reader_keeps_what_it_began_with(spark, tmp_path):
    path = str(tmp_path)
    versions.load_version(contacts(spark, ("a", JANUARY)), path, "one")
    reader = versions.read_version(spark, path)
    versions.load_version(contacts(spark, ("b", JANUARY)), path, "two", replace_months=True)
    assert mails(reader) == ["a"] and mails(versions.read_version(spark, path)) == ["b"]


def test_loads_of_equal_number_are_both_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    real = versions._log
    monkeypatch.setattr(versions, "_log", lambda *args: [])
    for name in ("x", "y"):
        assert versions.load_version(contacts(spark, (name, JANUARY)), path, name) == 1
    monkeypatch.setattr(versions, "_log", real)
    assert mails(versions.read_version(spark, path)) == ["x", "y"]
