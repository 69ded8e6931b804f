"""The shared work folder comes from spark.checkpoint.dir; never a local
temporary folder on a cluster."""

import pytest


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _SC:
    def __init__(self, master, conf, ckpt=None):
        self.master = master
        self._conf = _Conf(conf)
        self.applicationId = "app-test"
        self._ckpt = ckpt
        self.set_to = None

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self.set_to = d
        self._ckpt = d


class _RuntimeConf:
    def get(self, key, *default):
        raise Exception("not set")


class _Spark:
    def __init__(self, sc):
        self.sparkContext = sc
        self.conf = _RuntimeConf()


def test_cluster_without_checkpoint_dir_is_refused():
    from cartscope.session import work_root
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_root(_Spark(_SC("yarn", {})))


def test_configured_checkpoint_dir_is_used():
    from cartscope.session import work_root
    sc = _SC("k8s://cluster", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert work_root(_Spark(sc)) == "hdfs://nn/shared/ckpt"
    assert sc.set_to == "hdfs://nn/shared/ckpt/"


def test_local_session_gets_a_private_folder():
    from cartscope.session import work_root
    sc = _SC("local[2]", {})
    root = work_root(_Spark(sc))
    assert root and sc.set_to == root
