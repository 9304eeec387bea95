import zlib

import numpy as np
import pyarrow as pa
import pytest
from cardex.llm import toxicity as T
from llm_data import documents, odd_rows, prose  # noqa: F401

INSULTS = ("vilerun", "vilemor", "vileska", "grotbit", "grotlum")


def text(i):
    words = prose(i, 40 + i % 50).split()
    if i % 4 == 0:
        words[i % 30] = INSULTS[i % 5] + ","
    return " ".join(words)


@pytest.fixture(scope="module")
def network(spark, documents):
    rows = [(i, text(i)) for i in range(1200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(1200)], "doc_id long, toxic int")
    return T.fit(documents(rows), labels)


def scored(documents, network, rows):
    return {r.doc_id: r for r in T.toxicity(documents(rows), network).collect()}


def test_held_out_accuracy(documents, network):
    rows = [(i, text(i)) for i in range(2000, 2400)]
    found = scored(documents, network, rows)
    right = sum(found[i].predicted == (i % 4 == 0) for i, _ in rows)
    assert right >= 390
    assert all(r.predicted == (r.score >= T.THRESHOLD) for r in found.values())


def test_prefixes_carry_over_to_unseen_words(documents, network):
    assert scored(documents, network, [(1, prose(7, 30) + " vilexyz")])[1].score > scored(documents, network, [(1, prose(7, 30))])[1].score


def test_odd_rows(documents, network, odd_rows):
    found = T.toxicity(documents(odd_rows), network).collect()
    assert len(found) == len(odd_rows)
    assert all(0 <= r.score <= 1 for r in found)
    empty = {r.score for r in found if r.doc_id in (0, 1, 2, 3)}
    assert len(empty) == 1


def test_held_out_labels_are_never_read(spark, documents):
    rows = [(i, text(i)) for i in range(60)]
    table = documents(rows)

    def labels(flip):
        return spark.createDataFrame(
            [(i, int(i % 4 == 0) ^ (flip and zlib.crc32(str(i).encode()) % 4 == 2)) for i, _ in rows], "doc_id long, toxic int"
        )

    first, second = (T.fit(table, labels(flip)) for flip in (False, True))
    assert (first.output == second.output).all() and first.offset == second.offset


def test_scores_do_not_depend_on_neighbours(network):
    texts = [prose(i, i % 7) for i in range(40)]
    together = network.calibrated(T.words_of(pa.array(texts)))
    alone = np.concatenate([network.calibrated(T.words_of(pa.array([t]))) for t in texts])
    assert np.allclose(together, alone)


def test_slopes_follow_differences():
    rng = np.random.default_rng(1)
    buckets = [rng.integers(0, 50, (n, 3)) for n in (4, 9, 1)]
    labels = np.array([1, 0, 1])
    network = T.train(buckets, labels)
    losses = []
    for steps in (network, T.train(buckets[:0], labels[:0])):
        words = T._joined([b.astype(np.int64) for b in buckets])
        p = np.clip(steps.scores(words), 1e-6, 1 - 1e-6)
        losses.append(-(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean())
    assert losses[0] < 0.1 < losses[1]


def test_no_labels_and_no_rows(spark, documents):
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    network = T.fit(documents([(1, "x")]), labels)
    assert len({r.score for r in T.toxicity(documents([(1, "x"), (2, None)]), network).collect()}) == 1
    assert T.toxicity(documents([(1, "x")]).where("false"), network).collect() == []


def long(i):
    words = prose(10_000 + i, 10_000).split()
    for k in range(3 if i % 4 == 0 else 0):
        words[(i * 977 + k * 1231) % len(words)] = INSULTS[(i // 4 + k) % 5]
    return " ".join(words)


def test_long_texts_count(spark, documents):
    rows = [(i, text(i) if i < 600 else long(i)) for i in range(624)]
    toxic = [(i, int(i % 4 == 0)) for i, _ in rows]
    network = T.fit(documents(rows), spark.createDataFrame(toxic, "doc_id long, toxic int"))
    found = scored(documents, network, [(i, long(i)) for i in range(5000, 5040)])
    assert sum(r.predicted == (i % 4 == 0) for i, r in found.items()) >= 38


def test_rows_beyond_the_bytes_are_left_out_not_long_ones(spark, documents, monkeypatch):
    seen = []
    monkeypatch.setattr(T, "train", lambda buckets, labels, real=T.train: seen.append(buckets) or real(buckets, labels))
    rows = [(i, prose(i, 4000 if i == 7 else 50)) for i in range(100)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    for most in (T.SAMPLE_BYTES, 12 * 1000, 12 * 5000):
        monkeypatch.setattr(T, "SAMPLE_BYTES", most)
        T.fit(documents(rows), labels)
    everything, few, half = ([len(b) for b in s] for s in seen)
    assert sum(few) <= 1000 and set(few) == {50}
    assert sum(half) <= 5000 and sum(everything) > 3000
    assert all(b.dtype == np.int32 for b in seen[0])


def test_all_labelled_rows_train_and_calibrate(spark, documents, monkeypatch):
    calibrated = []
    monkeypatch.setattr(T, "calibrate", lambda n, scored, real=T.calibrate: calibrated.append(scored.count()) or real(n, scored))
    # an insult of its own that the first rows by hash do not have
    ids = [r.id for r in spark.sql("select id from range(6000) order by xxhash64(id), id").collect()]
    late = set(ids[1500:])

    def other(i):
        words = prose(i, 40).split()
        words[i % 30] = "zorgblat" if i in late else INSULTS[i % 5]
        return " ".join(words) if i % 4 == 0 else prose(i, 40)

    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(6000)], "doc_id long, toxic int")
    network = T.fit(documents([(i, other(i)) for i in range(6000)]), labels, 300)
    rows = [(i, prose(i, 40) + (" zorgblat" if i % 2 else "")) for i in range(20_000, 20_200)]
    found = scored(documents, network, rows)
    assert sum(r.predicted == i % 2 for i, r in found.items()) >= 190
    assert calibrated[0] > 600
    known = scored(documents, network, [(i, text(i)) for i in range(30_000, 30_200)])
    assert sum(r.predicted == (i % 4 == 0) for i, r in known.items()) >= 180
