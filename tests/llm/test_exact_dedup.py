import collections

import numpy as np
import plain
from cardex.llm import exact_dedup
from cardex.llm.exact_dedup import exact_duplicates, frequent, reduced, without_duplicates
from llm_data import documents, odd, odd_rows, prose  # noqa: F401
from pyspark.sql import functions as F


def expected(rows):
    """(doc_id, keep_id, group_size, digest) of every row, and how many stay per group."""
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(plain.LOWER)].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return [
        (i, best[t], len(groups[t]), plain.sha256(t))
        for i, t in ((i, (text or "").translate(plain.LOWER)) for i, text in rows)
    ]


def check(spark, documents, rows):
    frame = documents(rows)
    found = exact_duplicates(frame).collect()
    assert odd((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == odd(expected(rows))
    kept = [r for r in found if r.kept]
    digests = {r.text_sha256 for r in found}
    assert len(kept) == len(digests) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)
    left = without_duplicates(frame)
    assert left.columns == frame.columns
    texts = collections.Counter(plain.sha256((r.text or "").translate(plain.LOWER)) for r in left.collect())
    assert texts == collections.Counter(digests)
    assert odd((r.doc_id,) for r in left.collect()) == odd((r.doc_id,) for r in kept)


def test_odd_rows(spark, documents, odd_rows):
    check(spark, documents, odd_rows)


def test_a_third_of_all_rows_is_one_text(spark, documents):
    rows = [(i, "Same TEXT" if i % 3 == 0 else prose(i // 4, 12)) for i in range(1500)]
    check(spark, documents, rows)
    ranked = documents(rows).select(
        exact_dedup.digest("text").alias("_digest"), F.struct(F.col("doc_id").alias("id")).alias("_rank")
    )
    large = frequent(ranked).collect()
    assert [(r["_size"], r["_winner"].id) for r in large] == [(500, 1497)]


def test_one_repeated_row_is_frequent(spark, documents):
    check(spark, documents, [(7, "x")] * 400 + [(None, None)] * 300 + [(None, "NULL id")] * 300)


def test_only_letters_a_to_z_are_folded(spark, documents):
    check(spark, documents, [(1, "É a"), (2, "é a"), (3, "É A"), (4, "K"), (5, "K"), (6, "k"), (7, "a "), (8, "a")])


def test_counters_name_every_frequent_value():
    random = np.random.default_rng(1)
    for k in (3, 7, 20):
        values = np.concatenate([random.integers(0, 4, 900), random.integers(0, 10_000, 2000)])
        random.shuffle(values)
        held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in np.array_split(values, 23):
            both = np.concatenate([held, batch])
            weights = np.concatenate([counts, np.ones(len(batch), np.int64)])
            new, at = np.unique(both, return_inverse=True)
            held, counts = reduced(new, np.bincount(at, weights).astype(np.int64), k)
            assert len(held) <= k
        seen = dict(zip(held.tolist(), counts.tolist()))
        for value, true in collections.Counter(values.tolist()).items():
            short = true - seen.get(value, 0)
            assert 0 <= short <= len(values) / (k + 1)


def test_columns_of_any_kind_stay(spark):
    frame = spark.sql(
        "SELECT id AS doc_id, 'same' AS text, map('k', id) AS m, id AS `a.b`, 1 AS kept, 2 AS _digest FROM range(50)"
    )
    left = without_duplicates(frame).collect()
    assert [(r.doc_id, r.m, r["a.b"]) for r in left] == [(49, {"k": 49}, 49)]
    assert exact_duplicates(frame).where("kept").count() == 1


def test_empty_table(spark, documents):
    empty = documents([(1, "x")]).where("false")
    assert exact_duplicates(empty).collect() == [] and without_duplicates(empty).collect() == []
