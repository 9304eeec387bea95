import plain
from cardex.llm.line_dedup import line_dedup
from llm_data import documents, odd, odd_rows  # noqa: F401


def check(spark, documents, rows, least=10):
    found = line_dedup(documents(rows), min_documents=least).collect()
    assert odd(tuple(r) for r in found) == odd(plain.line_dedup(rows, least))


def test_odd_rows(spark, documents, odd_rows):
    check(spark, documents, odd_rows, 3)


def test_shared_lines_go_from_all_documents(spark, documents, monkeypatch):
    rows = [(i, f"own {i}\n  Shared LINE\t\n\x0bshared line\nÉ\né\n\n{i % 2}") for i in range(12)]
    rows += [(100 + i, "rare\nshared  line") for i in range(9)]
    check(spark, documents, rows)
    monkeypatch.setattr("cardex.llm.line_dedup.BROADCAST_ROWS", 0)
    check(spark, documents, rows)


def test_lines_counted_once_per_document(spark, documents):
    check(spark, documents, [(i, "x\nx\nx\nx") for i in range(9)])
    check(spark, documents, [(i, "x\nx") for i in range(10)])


def test_a_document_of_very_many_lines(spark, documents):
    long = "\n".join(f"line {i % 5000}" for i in range(20_000))
    check(spark, documents, [(i, long) for i in range(3)] + [(9, "line 7\nown")], 4)


def test_empty_table(spark, documents):
    assert line_dedup(documents([(1, "x")]).where("false")).collect() == []
