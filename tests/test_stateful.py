from datetime import datetime, timedelta

import pytest

from cardex.operators.stats import domain_stats
from cardex.schemas import CONTACTS_TABLE
from cardex.streaming import merged, stateful

STAMP, LATER = datetime(2024, 1, 1), datetime(2024, 1, 4)


def contacts(spark, *rows):
    """(domain, url, date) as contacts; a domain of '' is that of a phone."""
    full = [(u, "", "", "", f"a@{d}" if d else "", "" if d else "123", "email" if d else "phone",
             d, t, "202401", "C") for d, u, t in rows]
    return spark.createDataFrame(full, CONTACTS_TABLE)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


class Stream:
    """A folder of contacts, and the stream over it, started anew by each run."""

    def __init__(self, spark, root, lifetime=None):
        self.spark, self.lifetime = spark, lifetime
        self.source, self.stats, self.checkpoint = (f"{root}/{n}" for n in ("in", "stats", "cp"))
        self.arrived = contacts(spark)

    def arrive(self, *new):
        added = contacts(self.spark, *new)
        added.coalesce(1).write.mode("append").parquet(self.source)
        self.arrived = self.arrived.unionByName(added)

    def run(self):
        source = self.spark.readStream.schema(CONTACTS_TABLE).option("maxFilesPerTrigger", 1)
        query = stateful.stream_stats(
            source.parquet(self.source), self.stats, self.checkpoint, self.lifetime
        )
        query.awaitTermination()
        return query

    def found(self):
        return rows(stateful.streamed_domain_stats(self.spark, self.stats))


def test_equals_domain_stats_over_batches_and_restarts(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    assert stream.found() == []
    for run in range(3):
        for n in range(2):
            # u0 to u3 return in every batch, under two dates, and repeated in one batch
            again = [("hot", f"u{k % 4}", STAMP) for k in range(40)]
            stream.arrive(*again, ("hot", f"run{run}-{n}", STAMP), ("hot", "u0", LATER),
                          ("", "u0", STAMP), ("x", None, STAMP))
        stream.run()
        assert stream.found() == rows(domain_stats(stream.arrived))
    assert ("hot", STAMP, 246, 246, 0, 10) in stream.found()
    assert ("x", STAMP, 6, 6, 0, 0) in stream.found()
    # a run without news changes nothing, and readers open few folders of few rows
    stream.run()
    assert stream.found() == rows(domain_stats(stream.arrived))
    live = merged.live_folders(spark, stream.stats)
    assert len(live) <= 2 * (merged.FANOUT - 1)
    assert spark.read.parquet(*live).count() <= 4 * len(live)


def test_a_failed_batch_is_repeated_from_the_state_before_it(spark, tmp_path, monkeypatch):
    stream = Stream(spark, tmp_path)
    stream.arrive(("a", "u", STAMP))
    stream.run()
    before = stream.found()
    stream.arrive(("a", "u", STAMP), ("a", "v", STAMP), ("b", "u", STAMP))

    def fail(*args, **kwargs):
        raise OSError("lost")

    for step in ("publish", "_expire"):
        monkeypatch.setattr(merged, step, fail)
        with pytest.raises(Exception):
            stream.run()
        monkeypatch.undo()
        if step == "publish":
            assert stream.found() == before
    stream.run()
    assert stream.found() == rows(domain_stats(stream.arrived))
    assert ("a", STAMP, 3, 3, 0, 2) in stream.found()


def urls_in_state(query):
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    assert all(s["operatorName"] == "dedupe" for s in states)
    return states[-1]["numRowsTotal"]


def test_urls_of_old_dates_are_forgotten(spark, tmp_path):
    stream = Stream(spark, tmp_path, timedelta(days=1))
    stream.arrive(("a", "u", STAMP), ("a", "v", STAMP))
    assert urls_in_state(stream.run()) == 2
    stream.arrive(("a", "u", LATER))
    assert urls_in_state(stream.run()) == 1
    # late contacts count, their URLs no more, whether known before or not
    stream.arrive(("a", "u", STAMP), ("a", "w", STAMP), ("a", "u", LATER))
    assert urls_in_state(stream.run()) == 1
    assert stream.found() == [("a", STAMP, 4, 4, 0, 2), ("a", LATER, 2, 2, 0, 1)]


def test_settings_of_the_session_stay(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    stream = Stream(spark, tmp_path)
    stream.arrive(("a", "u", STAMP))
    query = stream.run()
    assert spark.conf.get(name) == before
    assert urls_in_state(query) == 1
    (state,) = query.recentProgress[0]["stateOperators"]
    assert any(metric.startswith("rocksdb") for metric in state["customMetrics"])
