"""Checkpoint-folder policy: use the configured shared folder, fall back to a
scratch folder only for local masters, refuse otherwise."""

import pytest

from ludica.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value
        self.set_calls = []

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default

    def set(self, key, value):
        self.set_calls.append((key, value))


class _SC:
    def __init__(self, master, current=None):
        self.master, self.current = master, current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, d):
        self.current = d


class _Spark:
    def __init__(self, master, conf_dir=None, current=None):
        self.conf = _Conf(conf_dir)
        self.sparkContext = _SC(master, current)


def test_refuses_cluster_without_shared_folder():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Spark("yarn"))


def test_uses_configured_folder_on_cluster():
    s = _Spark("spark://head:7077", conf_dir="hdfs:///shared/ckpt")
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_keeps_an_already_set_folder():
    s = _Spark("k8s://api", current="s3a://bucket/ckpt")
    assert ensure_checkpoint_dir(s) == "s3a://bucket/ckpt"


def test_local_scratch_fallback():
    s = _Spark("local[2]")
    d = ensure_checkpoint_dir(s)
    assert d and s.sparkContext.current == d
