"""The shared working folder: taken from the session, never machine-local on a cluster."""

import pytest

from lamina import session


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Ctx:
    def __init__(self, master, configured=None, current=None):
        self.master, self._conf, self._current = master, _Conf(configured), current

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._current

    def setCheckpointDir(self, path):
        self._current = path


class _Session:
    def __init__(self, ctx):
        self.sparkContext = ctx


def test_configured_dir_is_used():
    s = _Session(_Ctx("yarn", configured="hdfs://nn/shared/ckpt/"))
    assert session.checkpoint_root(s) == "hdfs://nn/shared/ckpt"
    assert session.work_path(s, "x").startswith("hdfs://nn/shared/ckpt/lamina/x-")


def test_cluster_without_dir_refuses_local_folder():
    with pytest.raises(ValueError):
        session.checkpoint_root(_Session(_Ctx("yarn")))
    with pytest.raises(ValueError):
        session.checkpoint_root(_Session(_Ctx("local-cluster[2,1,1024]")))


def test_local_run_gets_its_own_folder():
    ctx = _Ctx("local[8]")
    root = session.checkpoint_root(_Session(ctx))
    assert root and ctx.getCheckpointDir() == root
