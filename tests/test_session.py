import pytest

from cardex.session import scratch_dir


class FakeSession:
    def __init__(self, **settings):
        self.settings = settings
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_is_below_the_shared_folder(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError):
        scratch_dir(FakeSession(**{"spark.master": "yarn"}), "x")


def test_a_local_master_may_leave_it_out():
    assert scratch_dir(FakeSession(**{"spark.master": "local[2]"}), "x")
