"""The pipeline's stages on rows that tables should not have, but do."""

import collections

import corpus_pipeline
import pytest
from cardex.llm.ngram_join import without_near_duplicates
from llm_data import documents, odd, odd_rows, prose  # noqa: F401

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES[:-1])


def texts(rows):
    return collections.Counter((r.doc_id, r.text) for r in rows)


def test_one_row_of_every_group(documents):
    one, other, near = prose(1, 60), prose(2, 60), prose(3, 400)
    rows = [(1, one), (1, one), (1, other), (2, one), (None, one), (2, near), (7, near + " tail")]
    rows += [(None, None), (None, None), (9, ""), (9, ""), (None, prose(4, 50)), (None, prose(4, 50))]
    frame = documents(rows)
    left = without_near_duplicates(frame, n=5, similarity=(80, 100))
    assert left.columns == frame.columns
    expected = [(1, one), (1, other), (2, near), (None, prose(4, 50))]
    expected += [(None, None), (None, None), (9, ""), (9, "")]
    assert texts(left.collect()) == collections.Counter(expected)


def test_a_row_repeated_very_often(documents):
    rows = [(5, prose(1, 30))] * 500 + [(i, prose(i, 30)) for i in range(10, 40)]
    left = without_near_duplicates(documents(rows), n=5, similarity=(80, 100))
    assert texts(left.collect()) == collections.Counter(dict.fromkeys(set(rows), 1))


@pytest.mark.parametrize("name", list(STAGES))
def test_odd_rows(spark, documents, odd_rows, name):
    frame = documents(odd_rows)
    left = STAGES[name](spark, frame, FOLDER)
    assert left.columns == frame.columns
    found, given = texts(left.collect()), texts(frame.collect())
    if name.startswith("n-gram"):
        # ids 0 to 5 twice or thrice; one row of each text with words that is alone or first
        words = {(i, t) for i, t in given if t and t.split()}
        assert all(n == 1 for row, n in found.items() if row in words)
        assert {row: n for row, n in found.items() if row not in words} == {
            row: n for row, n in given.items() if row not in words
        }
    else:
        assert all(found[row] == given[row] for row in found)
    if name.startswith("mixing"):
        assert found == given


def test_columns_of_any_kind_stay(spark):
    frame = spark.sql(
        "SELECT id AS doc_id, concat('one two three four five six seven ', id % 3) AS text, 'en' AS lang,"
        " 's' AS source, id AS n_chars, map('k', id) AS m, id AS `a.b`, 1 AS _rank, 2 AS _c0 FROM range(12)"
    )
    left = without_near_duplicates(frame, n=5, similarity=(80, 100)).collect()
    assert odd((r.doc_id, r.m, r["a.b"]) for r in left) == odd((i, {"k": i}, i) for i in range(3))
