"""Checkpoint folder rules: the session's setting wins; a local temp folder only on a local master."""

import pytest

from sparklytics.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None):
        self.master, self.current, self.set_to = master, current, None

    def getCheckpointDir(self):
        return self.current or self.set_to

    def setCheckpointDir(self, d):
        self.set_to = d


class _Session:
    def __init__(self, master, conf=None, current=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, current)


def test_configured_folder_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert checkpoint_dir(s) == "hdfs://nn/ckpt"


def test_existing_context_folder_wins():
    s = _Session("k8s://x", current="s3a://bucket/ckpt")
    assert checkpoint_dir(s) == "s3a://bucket/ckpt"


def test_cluster_without_setting_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("spark://host:7077"))


def test_local_master_gets_a_temporary_folder():
    d = checkpoint_dir(_Session("local[2]"))
    assert d and "sparklytics-ckpt-" in d
