"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from tidecast import session


def stand_in(master: str, shared: str | None):
    conf = SimpleNamespace(get=lambda key, default: shared or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_the_shared_folder_is_used_where_it_is_named():
    assert session.scratch_root(stand_in("yarn", "hdfs://nn/work/")) == "hdfs://nn/work"


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(stand_in("yarn", None))


def test_local_scratch_paths_are_new_each_time(spark):
    first, second = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    assert first != second and first.rsplit("/", 1)[0] == session.scratch_root(spark)
