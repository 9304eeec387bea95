import math

import numpy as np
import pytest
from cardex.llm import vector_codes as vc
from llm_data import odd

SCHEMA = "vec_id bigint, embedding array<float>, label int, _id string, _parts string, _codes string, r int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", 0) for r in rows], SCHEMA)


def brute(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error) by plain rounds, and the codebooks."""
    kept = [
        (i, np.floor(4096 * np.array(v, np.float32).astype(float)).astype(object), label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1].tolist()))
    edges = vc.bounds(len(kept[0][1]), parts)
    cut = [[[int(x) for x in v[a:b]] for a, b in zip(edges, edges[1:])] for _, v, _ in kept]
    books = [[cut[r][p] for r in range(min(entries, len(kept)))] for p in range(parts)]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(c[p], books[p])[1] for c in cut]
            for k in range(len(books[p])):
                members = [c[p] for c, o in zip(cut, own) if o == k]
                if members:
                    books[p][k] = [sum(x) // len(members) for x in zip(*members)]
    final = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in final]
    labels = {}
    for (_, _, label), e in zip(kept, errors):
        labels[label] = labels.get(label, 0) + e
    return [
        (i, "".join(f"{k:02x}" for _, k in f), e, labels[label])
        for (i, _, label), f, e in zip(kept, final, errors)
    ], [x for book in books for e in book for x in e]


def check(spark, rows, **options):
    coded, books = vc.vector_codes(table(spark, rows), **options)
    expected, entries = brute(rows, **options)
    assert vc.books_text(books) == ",".join(map(str, entries))
    assert odd(map(tuple, vc.with_label_error(coded).collect())) == odd(expected)


def random_rows(seed, n, size, spread=1.0):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(9, size)) * spread
    vectors = centres[random.integers(0, 9, n)] + random.normal(size=(n, size)) * 0.1
    return [(int(i), [float(x) for x in v], int(i) % 3 or None) for i, v in zip(random.permutation(n), vectors)]


def test_equals_plain_rounds(spark):
    check(spark, random_rows(1, 300, 16))
    check(spark, random_rows(2, 200, 19), parts=4, entries=5, rounds=9)


def test_ties_and_odd_rows(spark):
    # few distinct values: many equal distances and unused entries
    random = np.random.default_rng(3)
    rows = [(i, [float(x) / 4096 for x in random.integers(-2, 3, 8)], None) for i in range(250)]
    rows += rows[:40] + [(5, [1.0] * 8, 1), (None, [0.5] * 8, 2), (None, [-0.5] * 8, 2)]
    rows += [(600, None, 1), (601, [None] * 8, 1), (602, [math.nan] * 8, 1), (603, [math.inf] + [0.0] * 7, 1)]
    check(spark, rows)


def test_fewer_vectors_than_entries(spark):
    check(spark, [(3, [0.1] * 8, 1), (1, [0.2] * 8, 1), (2, [0.2] * 8, None)])
    check(spark, [(3, [], 1), (1, [], 1)])


def test_large_components_stay_exact(spark):
    check(spark, random_rows(4, 60, 8, spread=5000.0))


def test_other_lengths_and_too_large_ones_are_dropped(spark):
    rows = random_rows(5, 40, 8)
    coded, _ = vc.vector_codes(table(spark, rows + [(900, [1.0] * 7, 1), (901, [1e30] * 8, 1)]))
    assert sorted(r["_id"] for r in coded.collect()) == sorted(r[0] for r in rows)


def test_many_labels_join_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(vc, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(vc, "FREQUENT_LABELS", 4)
    rows = [(i, v, None if k % 3 == 0 else k % 7) for k, (i, v, _) in enumerate(random_rows(6, 120, 8))]
    check(spark, rows)


def test_empty_table(spark):
    coded, books = vc.vector_codes(table(spark, []))
    assert books == [] and vc.with_label_error(coded).collect() == []
    coded, books = vc.vector_codes(table(spark, [(1, None, 1), (2, [None], 2)]))
    assert books == [] and coded.collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_active_entries_give_what_a_rescan_gives(seed):
    random = np.random.default_rng(seed)
    vectors = random.integers(-3, 4, (500, 2))
    entries = random.integers(-3, 4, (8, 2))
    found = vc.distances(vectors, entries)
    codes, held = found.argmin(1), found.min(1)
    for _ in range(6):
        moved = random.random(8) < 0.4
        entries = np.where(moved[:, None], random.integers(-3, 4, (8, 2)), entries)
        codes, held = vc.reassigned(vectors, entries, moved, codes, held)
        found = vc.distances(vectors, entries)
        assert (codes == found.argmin(1)).all() and (held == found.min(1)).all()
