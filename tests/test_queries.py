"""Every registered query against DuckDB on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from cardex.plans import queries
from cardex.plans.oracles import ORACLES
from cardex.plans.queries import QUERIES
from conftest import TESTDATA

FOLDER = TESTDATA / os.environ.get("TEST_SF", "sf0.01")

SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp": "TIMESTAMP",
}


def answers(name):
    with duckdb.connect() as db:
        for file in FOLDER.glob("*.parquet"):
            db.execute(f"CREATE VIEW {file.stem} AS FROM '{file}'")
        result = db.sql(entry.oracle_sql()[name])
        return dict(zip(result.columns, map(str, result.types))), sorted(
            (tuple(row[i] for i in order(result.columns)) for row in result.fetchall()),
            key=repr,
        )


def order(columns):
    return sorted(range(len(columns)), key=lambda i: columns[i])


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, name):
    expected_types, expected = answers(name)
    df = entry.queries()[name](spark, str(FOLDER))
    assert {c: SPARK_TYPES[t] for c, t in df.dtypes} == expected_types
    positions = order(df.columns)
    found = sorted((tuple(r[i] for i in positions) for r in df.collect()), key=repr)
    assert found == expected
    assert found


def test_scan_whose_first_task_has_no_rows(spark):
    sizes = {"spark.sql.files.maxPartitionBytes": "100k", "spark.sql.files.openCostInBytes": "1k"}
    before = {name: spark.conf.get(name) for name in sizes}
    try:
        for name, value in sizes.items():
            spark.conf.set(name, value)
        scanned = spark.read.parquet(f"{FOLDER}/pages.parquet").rdd.glom().map(len).collect()
        found = entry.queries()["archive_quarantine"](spark, str(FOLDER))
        positions = order(found.columns)
        rows = sorted((tuple(r[i] for i in positions) for r in found.collect()), key=repr)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert scanned[0] == 0 and sum(scanned) > 0
    assert rows == answers("archive_quarantine")[1]


def test_archives_grow_in_number_not_in_size(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(queries, "ARCHIVED_BYTES", 100_000, raising=False)
    monkeypatch.setattr(
        queries.ledger, "finish", lambda df, *a, real=queries.ledger.finish: taken.append(df.collect()) or real(df, *a)
    )
    found = entry.queries()["ledger_runs"](spark, str(FOLDER))
    positions = order(found.columns)
    rows = sorted((tuple(r[i] for i in positions) for r in found.collect()), key=repr)
    assert rows == answers("ledger_runs")[1]
    stored = sum((FOLDER / f"{name}.parquet").stat().st_size for name in ("pages", "documents"))
    assert len(taken) == 3 and sum(map(len, taken)) >= stored // 100_000


def test_flagship_query(spark):
    assert entry.entry(spark).count() > 1
