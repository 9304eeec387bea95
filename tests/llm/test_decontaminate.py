import random

import plain
import pytest
from cardex.llm import decontaminate as D
from llm_data import documents, odd, odd_rows, prose  # noqa: F401


@pytest.fixture(scope="module")
def items(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id bigint, text string, doc_id string")

    return make


ITEMS = [
    (1, prose(50, 25)),
    (2, prose(51, 10)),
    (3, "short item"),
    (4, "One"),
    (5, None),
    (6, "--- ..."),
    (7, prose(50, 25)),
    (10, "a b c d e f g h i j k l"),
    (None, prose(52, 12)),
    (11, "the the the the the the the the the the the the"),
]


def rows():
    choice = random.Random(8)
    out = []
    for i in range(120):
        words = prose(i, 40).split()
        at = choice.randrange(40)
        piece = choice.choice([prose(50, 25), prose(51, 10), "Short, ITEM!", prose(52, 12), prose(50, 9), ""]).split()
        cut = choice.randrange(len(piece)) if piece and i % 3 == 0 else 0
        out.append((1000 + i, " ".join([*words[:at], *piece[cut:], *words[at:]])))
    return out + [(2000, "the " * 30), (2001, "𝒳 a-b.c_d e/f\x00g h(i)j K L 𝒳")]


def check(documents, items, docs, bench, **options):
    found = D.contamination(documents(docs), items(bench), **options).collect()
    named = [(i, t) for i, t in bench]
    expected = []
    for doc, n, hit, names in plain.contamination(docs, named):
        expected.append((doc, n, hit, [x for x in names if x != "None"], hit > 0))
    assert odd((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in found) == odd(expected)


def test_against_brute_force(documents, items, odd_rows):
    check(documents, items, odd_rows + rows(), ITEMS)


@pytest.mark.parametrize("limit", [0, 4500])
def test_large_benchmarks_are_shuffled(documents, items, odd_rows, limit):
    # 4500 bytes hold the windows, not the hashes of all their shingles
    docs = odd_rows + rows()[:60] + rows()[-2:]
    check(documents, items, docs + docs[-70:], ITEMS, broadcast_bytes=limit)


def test_the_passes_do_not_grow_with_the_benchmark(spark, documents, items, monkeypatch):
    plans = []

    def stored(session, frame, name):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return frame

    monkeypatch.setattr(D, "store", stored)
    own = documents(rows()).selectExpr("doc_id as _row_key", "text as _text")
    own.write.mode("overwrite").saveAsTable("searched_documents")
    bench = items([(i, prose(i + 500, 30)) for i in range(40)])
    for limit, least in ((D.BROADCAST_BYTES, 1), (0, 0)):
        plans.clear()
        windows = D.item_windows(bench, "item_id", "text", D.WINDOW)
        D.occurrences(spark.table("searched_documents"), windows, "_text", broadcast_bytes=limit)
        # the second plan holds the first, as nothing was stored
        counted, whole = (p.count("searched_documents") for p in plans)
        assert counted == 1 and whole == (2 if least else 3)
    spark.sql("DROP TABLE searched_documents")


def test_clean_documents(documents, items, monkeypatch):
    docs = rows()
    hit = {d for d, _, n, _ in plain.contamination(docs, ITEMS) if n}
    for limit in (D.BROADCAST_ROWS, 0):
        monkeypatch.setattr(D, "BROADCAST_ROWS", limit)
        kept = D.clean_documents(documents(docs), items(ITEMS))
        assert kept.columns == documents(docs).columns
        assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - hit


def test_nothing_to_find(documents, items):
    check(documents, items, rows()[:5], [(1, None)])
    assert D.contamination(documents(rows()[:1]).where("false"), items(ITEMS)).collect() == []


def test_all_documents_are_split_into_words_once(spark, documents, items, monkeypatch):
    plans, store = [], D.store

    def stored(session, frame, name, **measures):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return store(session, frame, name, **measures)

    monkeypatch.setattr(D, "store", stored)
    documents(rows()).write.mode("overwrite").saveAsTable("split_documents")
    found = D.contamination(spark.table("split_documents"), items(ITEMS))
    plans.append(found._jdf.queryExecution().optimizedPlan().toString())
    # each size of shingle and the number of words took a pass of their own
    assert sum(p.count("split_documents") for p in plans if "regexp_extract_all" in p) == 1
    assert sum(p.count("split_documents") for p in plans) == 2
    assert found.count() == len(rows())
    spark.sql("DROP TABLE split_documents")


@pytest.mark.parametrize("limit", [D.BROADCAST_HASHES, 0])
def test_documents_with_too_few_shingles_are_not_read_again(documents, items, odd_rows, monkeypatch, limit):
    read, occurrences = [], D.occurrences

    def seen(near, *rest):
        read.extend(r._text for r in near.select("_text").collect())
        return occurrences(near, *rest)

    monkeypatch.setattr(D, "occurrences", seen)
    monkeypatch.setattr(D, "BROADCAST_HASHES", limit)
    item = "Él a b c d É f g h I J k".split()
    at = {i: f"x {' '.join(item[i:])} y" for i in range(4)}
    # eight shingles; a window of ten words has six of them, in its order
    out_of_order = " ".join([*item[6:], "z", *item[:6]])
    twice = " ".join([*item[:9], "z", *item[:9]])
    other = " ".join(item).replace("É", "é")
    docs = [*enumerate([*at.values(), out_of_order, twice, other, " ".join(item).lower().replace("é", "É")])]
    check(documents, items, odd_rows + docs + docs[:2], [(1, " ".join(item))])
    assert {at[0], at[1], at[2], twice} <= set(read)
    assert {at[3], out_of_order, other}.isdisjoint(read) and not any(t in read for _, t in odd_rows)


def test_words_are_runs_of_ascii_letters_and_digits_and_of_all_beyond(spark):
    every = [*map(chr, range(1, 0x250)), *"\x00\u2028\u3000\u1e9e𝒳"]
    texts = spark.createDataFrame([(a + "b".join(every),) for a in every], "t string")
    ranges = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    for text in ("lower(t)", D.ascii_lower("t")):
        assert texts.where(f"{D.words_sql(text, D.WORD)} <> {D.words_sql(text, ranges)}").count() == 0
