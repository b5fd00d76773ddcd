"""Scratch locations: taken from spark.checkpoint.dir; never a local temp
folder on a cluster."""

import pytest

from postlake.session import checkpoint_root, scratch_path


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master = master
        self.applicationId = "app-1"
        self._conf = _Conf(conf)
        self.dir = None

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, master, conf):
        self.conf = _Conf(conf)
        self.sparkContext = _Context(master, conf)


def test_root_comes_from_the_session_setting():
    s = _Session("spark://cluster:7077", {"spark.checkpoint.dir": "s3a://shared/ckpt/"})
    assert checkpoint_root(s) == "s3a://shared/ckpt"
    assert scratch_path(s, "lake", "x") == "s3a://shared/ckpt/postlake/app-1/lake/x"
    a, b = scratch_path(s, "t", unique=True), scratch_path(s, "t", unique=True)
    assert a != b and a.startswith("s3a://shared/ckpt/postlake/app-1/t-")


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        checkpoint_root(_Session("yarn", {}))


def test_local_session_without_setting_gets_a_temporary_folder():
    s = _Session("local[2]", {})
    root = checkpoint_root(s)
    assert root and s.sparkContext.dir == root
    assert checkpoint_root(s) == root  # remembered, not a fresh folder per call


def test_real_session_uses_its_setting(spark):
    root = checkpoint_root(spark)
    assert scratch_path(spark, "x").startswith(root + "/postlake/")
