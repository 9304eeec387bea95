import random

import plain
import pytest
from cardex.llm import ngram_join as N
from cardex.llm.components import components
from llm_data import documents, odd, odd_rows, prose  # noqa: F401


def edited(text, rate, seed):
    choice = random.Random(seed)
    return " ".join(w if choice.random() > rate else f"e{seed}x{k}" for k, w in enumerate(text.split()))


def rows():
    out = [(i, prose(i, 30 + i)) for i in range(20)]
    for g in range(6):
        base = prose(100 + g, 60 + 40 * g)
        out += [(1000 * (g + 1) + k, edited(base, 0.004 * k, 31 * g + k)) for k in range(12)]
    shared = prose(999, 55)
    out += [(9000 + k, f"{shared} {prose(200 + k, 3 * k)}") for k in range(25)]
    out += [(20_000 + k, out[25][1].upper() + "  \n") for k in range(8)]
    out += [(30_000 + k, " ".join(f"t{j}" for j in range(k, k + 40))) for k in range(12)]
    return out


def check(documents, docs, n=4, similarity=(85, 100)):
    found = N.ngram_components(documents(docs), n=n, similarity=similarity).collect()
    assert odd(tuple(r) for r in found) == odd(plain.components(docs, n, *similarity))


def test_against_brute_force(documents):
    check(documents, rows())


@pytest.mark.parametrize("n, similarity", [(5, (80, 100)), (1, (50, 100)), (2, (1, 1))])
def test_other_parameters(documents, n, similarity):
    check(documents, rows()[::2], n, similarity)


def test_odd_rows(documents, odd_rows):
    check(documents, [r for r in odd_rows if r[0] is not None])
    found = N.ngram_components(documents([(None, "a b c d e"), (None, "a b c d e"), (None, ""), (3, "a b c d e")])).collect()
    assert odd((r.doc_id, r.component_id) for r in found) == odd([(None, 3), (None, 3), (None, None), (3, 3)])


def test_shuffled_joins_give_the_same(documents, monkeypatch):
    monkeypatch.setattr(N, "_small", lambda frame: frame)
    check(documents, rows()[::3])


def test_no_jobs_that_only_count(documents, monkeypatch):
    docs = documents(rows()[::3])
    for action in ("count", "first", "isEmpty"):
        monkeypatch.setattr(type(docs), action, None)
    found = N.ngram_components(docs).collect()
    assert odd(tuple(r) for r in found) == odd(plain.components(rows()[::3]))


def test_a_large_group_makes_few_comparisons(spark, documents):
    base = prose(5, 200)
    docs = documents([(i, edited(base, 0.003, i)) for i in range(150)])
    classes = N._classes(docs, "doc_id", "text", 4)
    sets = classes.selectExpr("_id as c", "_n as n", "_set")
    postings = N._postings(sets, N.SIMILARITY)
    star = N._star_pairs(postings, N.SIMILARITY).count()
    assert 100 < star < 1500 < 150 * 149 / 2


def test_long_lists_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 7)
    docs = rows()
    found = N.ngram_components(documents(docs)).collect()
    assert odd(map(tuple, found)) == odd(plain.components(docs))


def test_one_per_component(documents):
    docs = rows()
    kept = N.without_near_duplicates(documents(docs))
    assert kept.columns == documents(docs[:1]).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, c in plain.components(docs) if i == c}


def test_empty_table(documents):
    assert N.ngram_components(documents([(1, "x")]).where("false")).collect() == []


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (7000, 7000)]
    random.Random(4).shuffle(chain)
    links = spark.createDataFrame(chain, "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}


def all_links(docs, n=4, num=85, den=100):
    """Sets by row, and the pairs of rows that link, compared one by one."""
    sets = []
    for _, text in docs:
        w = (text or "").translate(plain.LOWER).split()
        sets.append(frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) or frozenset([tuple(w)] * bool(w)))
    pairs = [(i, j) for j in range(len(sets)) for i in range(j) if sets[i] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    return sets, pairs


@pytest.mark.parametrize("block", [N.BLOCK, 3])
def test_every_link_is_returned(documents, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    docs = rows() + [(40_000, ""), (40_001, None), (40_002, "one two")]
    docs += [(60_000 + k, edited(prose(77, 200), 0.003, 900 + k)) for k in range(20)]
    sets, expected = all_links(docs)
    pairs, members = N.ngram_join(documents(docs))
    number = {i: k for k, (i, _) in enumerate(docs)}
    chosen = {}
    for r in members.collect():
        assert (r["class"] is None) == (not sets[number[r.doc_id]])
        chosen.setdefault(r["class"], []).append(number[r.doc_id])
    chosen.pop(None)
    assert all(len({sets[k] for k in group}) == 1 for group in chosen.values())
    found = [(chosen[r.a][0], chosen[r.b][0], r.overlap) for r in pairs.collect()]
    wanted = {frozenset((sets[i], sets[j])) for i, j in expected if sets[i] != sets[j]}
    assert len(found) == len(wanted) > 100
    assert {frozenset((sets[i], sets[j])) for i, j, _ in found} == wanted
    assert all(overlap == len(sets[i] & sets[j]) for i, j, overlap in found)


def test_links_are_counted_per_document(documents, odd_rows):
    docs = rows()[::2] + odd_rows + [(50_000, rows()[30][1])] * 3
    sets, expected = all_links(docs)
    links = [0] * len(docs)
    for i, j in expected:
        links[i] += 1
        links[j] += 1
    found = N.ngram_links(documents(docs)).collect()
    assert odd(tuple(r) for r in found) == odd((i, len(s), k) for (i, _), s, k in zip(docs, sets, links))
    assert N.ngram_links(documents(docs).where("false")).collect() == []
