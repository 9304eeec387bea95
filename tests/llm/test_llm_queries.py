"""The registered queries against DuckDB where SQL can express them, else by brute force."""

import os
import struct
import zlib

import corpus_pipeline
import duckdb
import plain
import pytest
from cardex.llm import decontaminate, quality, tokens
from cardex.llm.queries import ORACLES, QUERIES

FOLDER = os.path.join(os.environ.get("TESTDATA", "/root/testdata"), "sf0.001")


def read(name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{FOLDER}/{name}.parquet'").fetchall()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(spark, name):
    with duckdb.connect() as db:
        for table in ("documents", "pages", "benchmark", "labels", "embeddings"):
            db.execute(f"CREATE VIEW {table} AS FROM '{FOLDER}/{table}.parquet'")
        result = db.sql(ORACLES[name])
        columns = sorted(result.columns)
        expected = sorted(result.select(*columns).fetchall(), key=repr)
    found = QUERIES[name](spark, FOLDER).select(*columns).collect()
    assert sorted(map(tuple, found), key=repr) == expected


def test_secrets(spark):
    texts = read("documents", "doc_id, text")
    expected = {}
    for i, text in texts:
        spans = plain.secrets(text)
        expected[i] = (*(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")), plain.digest(spans))
    found = QUERIES["op1_secrets"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in found} == expected
    assert len(found) == len(texts)


def test_pii(spark):
    expected = {}
    for i, text in read("documents", "doc_id, text"):
        spans = plain.pii(text)
        expected[i] = (*(sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")), plain.digest(spans))
    found = QUERIES["op6_pii"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found} == expected


def test_tokens(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.tokenizer_path())
    expected, at = [], 0
    for i, text in sorted(read("documents", "doc_id, text")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        expected.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert sorted(map(tuple, QUERIES["op8_tokens"](spark, FOLDER).collect())) == expected


@pytest.mark.parametrize("name", ["op2_urls", "op4_quality", "op5_toxicity", "op7_mix"])
def test_one_row_each(spark, name):
    table, key = ("pages", "page_id") if name == "op2_urls" else ("documents", "doc_id")
    found = [r[key] for r in QUERIES[name](spark, FOLDER).collect()]
    assert sorted(found) == sorted(i for (i,) in read(table, key))


def test_pipeline(spark):
    texts = dict(read("documents", "doc_id, text"))
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    forest = quality.fit(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    kept = [r.doc_id for r in quality.quality_rules(documents, forest).collect() if r.kept]
    parts = plain.components([(i, texts[i]) for i in kept], 5, 80, 100)
    single = [i for i, _, c in parts if i == c]
    clean = plain.contamination([(i, texts[i]) for i in single], read("benchmark", "item_id, text"))
    expected = {i for i, _, hit, _ in clean if not hit}
    found = sorted(corpus_pipeline.run(spark, FOLDER).collect(), key=lambda r: r.start)
    assert {r.doc_id for r in found} == expected and len(found) == len(expected)
    at = 0
    for row in found:
        assert row.start == at
        at += row.n_tokens


def test_stages_return_documents(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, FOLDER).schema.names == documents.columns
        assert stage(spark, documents.where("false"), FOLDER).count() == 0


def test_decontamination_keeps_most(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    assert decontaminate.clean_documents(documents, items).count() > 0.8 * documents.count()
