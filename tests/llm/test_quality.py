import random

import corpus_pipeline
import numpy as np
import plain
import pyarrow as pa
from cardex.llm import quality as Q
from llm_data import documents, odd, odd_rows, prose  # noqa: F401

NOISE = random.Random(2)
FOREST = Q.grow(np.zeros((0, 4)))


def test_counts_and_base_rules(spark, documents, odd_rows):
    texts = ["a b c d e f g " * 3, "x " * 40, "l1\nl2\nl1\n\n \nl1", "𝒳 é\x1fa\x85b c d", "# * $%&|<>\n#"]
    texts += [" ".join(NOISE.choices("abc", k=40)) for _ in range(50)]
    rows = odd_rows + list(enumerate(texts, 100))
    found = Q.quality_rules(documents(rows), FOREST).collect()
    expected = []
    for i, text in rows:
        counts = plain.quality_counts(text)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        expected.append((i, *counts, failed, not failed))
    names = ("doc_id", *Q.COUNTS, "base_failed", "kept")
    assert odd(tuple(r[n] for n in names) for r in found) == odd(expected)


def test_slices_do_not_change_counts(monkeypatch):
    texts = pa.array([prose(i, 200) for i in range(50)])
    whole = Q.statistics(texts)
    batch = pa.RecordBatch.from_arrays([texts], ["t"])
    parts = [Q.statistics(part["t"].combine_chunks() if isinstance(part["t"], pa.ChunkedArray) else part["t"]) for part in Q.arrays.slices(batch, "t", 3000)]
    assert len(parts) > 5
    for name, values in whole.items():
        assert (np.concatenate([p[name] for p in parts]) == values).all()


def junk(i):
    words, part = prose(i, 60 + 3 * i % 400).split(), 0.4 + i % 60 / 100
    spoilt = [w.upper() + "!!" if i % 2 else w + "%$#"[: 1 + i % 3] for w in words]
    return " ".join(spoilt[: int(part * len(words))] + words[int(part * len(words)) :])


def test_forest_finds_junk_and_keeps_clean_documents(spark, documents):
    rows = [(i, junk(i) if i % 23 in (0, 5) else prose(i, 60 + i % 200).capitalize()) for i in range(1200)]
    labels = spark.createDataFrame([(i, int("%" not in t and "!" not in t)) for i, t in rows[:800]], "doc_id long, quality int")
    forest = Q.fit(documents(rows), labels)
    kept = {r.doc_id: r.kept for r in Q.quality_rules(documents(rows), forest).collect()}
    bad = {i for i, t in rows if "%" in t or "!" in t}
    assert len(bad) > 90
    assert sum(kept[i] for i in bad) <= 0.35 * len(bad)
    assert sum(not kept[i] for i, _ in rows if i not in bad) <= 10
    filtered = Q.kept_documents(documents(rows), forest)
    assert filtered.columns == documents(rows[:1]).columns
    assert {r.doc_id for r in filtered.collect()} == {i for i, k in kept.items() if k}


def odd_words(i):
    return "\n".join(f"{NOISE.getrandbits(400):0100x}" for _ in range(40))


def odd_letters(i):
    return " ".join(NOISE.choices("abcdefghij", k=200))


def odd_lines(i):
    words = prose(i, 90).split()
    return "\n".join(f"{' '.join(words[k : k + 3])}\n{['click here', 'read more'][k % 2]}" for k in range(0, 90, 3))


def odd_repeats(i):
    words = prose(i, 180).split()
    return " ".join(words + words[10:26])


def test_each_statistic_may_reject(spark, documents):
    rows = [(i, junk(i) if i % 23 in (0, 5) else prose(i, 60 + i % 200).capitalize()) for i in range(800)]
    labels = spark.createDataFrame([(i, int("%" not in t and "!" not in t)) for i, t in rows], "doc_id long, quality int")
    forest = Q.fit(documents(rows), labels)
    kinds = (odd_words, odd_letters, odd_lines, odd_repeats)
    for kind in kinds:
        found = Q.statistics(pa.array([kind(5000 + i) for i in range(40)]))
        assert not Q.base_failed(found).any(), kind
        assert forest.rejects(Q.features(found), found["n_words"]).mean() > 0.9, kind
    plain_texts = Q.statistics(pa.array([prose(9000 + i, 60 + i) for i in range(300)] + [prose(9999, 20_000)]))
    assert forest.rejects(Q.features(plain_texts), plain_texts["n_words"]).sum() <= 6


def late_rows(spark):
    """Rows, ids of clean ones, and of the last thousand by hash: clean, with a statistic of their own."""
    ids = [r.id for r in spark.sql("select id from range(7000) order by xxhash64(id), id").collect()]
    late = set(ids[6000:])
    rows = [(i, odd_repeats(i) if i in late else junk(i) if i % 23 in (0, 5) else prose(i, 30 + i % 60)) for i in range(7000)]
    clean = {i for i, t in rows if i in late or ("%" not in t and "!" not in t)}
    labels = spark.createDataFrame([(i, int(i in clean)) for i, _ in rows], "doc_id long, quality int")
    return rows, labels, clean, late


def test_pipeline_fits_on_all_labelled_rows(spark, documents, tmp_path):
    rows, labels, clean, late = late_rows(spark)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, documents(rows), str(tmp_path)).collect()}
    assert len(late & kept) > 980 and len(clean - kept) <= 2 * Q.FALSE_REJECTS * len(clean)


def test_all_labelled_rows_count(spark, documents):
    rows, labels, clean, late = late_rows(spark)
    forest = Q.fit(documents(rows), labels)
    kept = {r.doc_id for r in Q.quality_rules(documents(rows), forest).where("kept").collect()}
    assert len(late & kept) > 980
    assert len(clean - kept) <= 2 * Q.FALSE_REJECTS * len(clean)
    assert len(kept - clean) <= 0.35 * (7000 - len(clean))


def test_trees_rows_reach_the_driver_with_their_own_features_only(spark, documents, monkeypatch):
    rows = [(i, junk(i) if i % 23 in (0, 5) else prose(i, 30 + i % 60)) for i in range(2000)]
    labels = spark.createDataFrame([(i, int("%" not in t and "!" not in t)) for i, t in rows], "doc_id long, quality int")
    frames = type(labels)
    sizes, to_arrow = [], frames.toArrow
    monkeypatch.setattr(frames, "toArrow", lambda frame: sizes.append(found := to_arrow(frame)) or found)
    monkeypatch.setattr(frames, "first", None)  # rows are counted while they are stored
    forest = Q.fit(documents(rows), labels)
    drawn = max(sizes, key=lambda t: t.nbytes)
    kinds = 1 + len(forest.others)
    assert len(forest.roots) == Q.TREES and kinds == 4
    assert drawn.num_rows > kinds * Q.TREES * Q.SUBSAMPLE
    # tree, key, offset and 2 to 4 features
    assert drawn.nbytes < 40 * drawn.num_rows


def test_threshold_is_the_best_of_all():
    random = np.random.default_rng(3)
    for _ in range(50):
        good, bad = random.normal(0.4, 0.05, 400).round(2), random.normal(0.5, 0.08, random.integers(0, 60)).round(2)
        top = np.sort(good)[::-1][:21]
        edges = np.unique(top)
        bins = np.searchsorted(edges, bad[bad > edges[0]]) - 1
        above = bad[bad > edges[0]]
        groups = [
            {"bin": b, "rows": int((bins == b).sum()), "least": above[bins == b].min(), "most": above[bins == b].max()}
            for b in set(bins)
        ]
        cut = Q._threshold(top, len(good), groups, len(bad))

        def gain(c):
            return (bad >= c).sum() / max(len(bad), 1) - (good >= c).mean()

        assert (good >= cut).sum() <= 20
        if len(groups):
            assert gain(cut) >= max(gain(c) for c in [*(above - 1e-9), 2.0] if c > edges[0]) - 1e-12


def test_isolation():
    rows = np.random.default_rng(0).normal(size=(500, 4))
    rows[0] = 9
    forest = Q.grow(rows)
    assert forest.scores(rows).argmax() == 0
    assert (forest.scores(rows) == Q.grow(rows).scores(rows)).all()


def test_no_labels_and_no_rows(spark, documents):
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    forest = Q.fit(documents([(1, prose(1, 50))]), labels)
    assert [r.kept for r in Q.quality_rules(documents([(1, prose(1, 50))]), forest).collect()] == [True]
    assert Q.quality_rules(documents([(1, "x")]).where("false"), forest).collect() == []
