import pathlib

import pytest

from tillcast import session


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class _Session:
    def __init__(self, master, **conf):
        self.sparkContext, self.conf = _Context(master), _Conf(conf)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1024]"])
def test_a_cluster_must_name_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(_Session(master), "x")
    named = _Session(master, **{"spark.checkpoint.dir": "hdfs://store/shared/"})
    assert session.shared_folder(named, "x").startswith("hdfs://store/shared/x-")


def test_a_local_master_may_use_a_temporary_folder():
    assert session.shared_folder(_Session("local[4]"), "x") != session.shared_folder(_Session("local[4]"), "x")


def test_scratch_removes_what_was_named_inside(spark):
    def there(path):
        return pathlib.Path(path.removeprefix("file:")).exists()

    with session.scratch(spark) as kept:
        path = session.shared_folder(spark, "outer")
        outer = session.stored(spark.range(3), "outer", path)
        with session.scratch(spark) as inner:
            assert session.stored(spark.range(5), "inner").count() == 5
            (gone,) = inner
            assert there(gone)
        assert not there(gone) and there(path)
        session.stored(spark.range(5), "more")
        more = kept[-1]
        kept.remove(path)
    assert outer.count() == 3 and there(path) and not there(more)
