"""The shared checkpoint folder comes from the session."""

import pytest

from chorus import session


class _Conf(dict):
    def get(self, k, default=None):
        return dict.get(self, k, default)

    def set(self, k, v):
        self[k] = v


class _SC:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt = master, ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self._ckpt = d


class _Spark:
    def __init__(self, master, conf=None, ckpt=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _SC(master, ckpt)


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError):
        session.shared_dir(_Spark("yarn"))


def test_cluster_setting_is_used_as_is():
    s = _Spark("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert session.shared_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs:///shared/ckpt"
    assert session.scratch_path(s, "x").startswith("hdfs:///shared/ckpt/chorus/x-")


def test_local_master_gets_a_scratch_folder():
    s = _Spark("local[2]")
    d = session.shared_dir(s)
    assert d and s.conf.get("spark.checkpoint.dir") == d
