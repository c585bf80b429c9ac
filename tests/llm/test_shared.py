"""Working tables: where they go, and that they go."""

from types import SimpleNamespace

import pytest

from velograph.llm import shared


def exists(spark, path):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def test_working_tables_are_deleted_at_the_end(spark):
    before = list(shared._SETTLED)
    with shared.working_tables(spark):
        assert shared.settle(spark.range(3), "x").count() == 3
        path = shared._SETTLED[-1]
        assert exists(spark, path) and path.startswith(shared.shared_folder(spark))
    assert not exists(spark, path) and shared._SETTLED == before


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "yarn", "spark://host:7077"])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    conf = SimpleNamespace(get=lambda *a: None)
    session = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(session)


def test_names_are_made_free():
    assert shared.free_name("a", ["b"]) == "a" and shared.free_name("a", ["A", "a_"]) == "a__"
