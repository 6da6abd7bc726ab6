"""Shared scratch folder: read from the session, local fallback only locally."""

from __future__ import annotations

import pytest

from postlens.session import new_scratch_dir, scratch_root


class _Conf(dict):
    def get(self, key, default=None):  # SparkConf / RuntimeConfig style
        return super().get(key, default)


class _Context:
    def __init__(self, master, conf=None):
        self.master = master
        self._conf = _Conf(conf or {})
        self._ckpt = None

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, path):
        self._ckpt = path


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf)
        self.conf = _Conf(conf or {})


def test_configured_folder_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt/"})
    assert scratch_root(s) == "hdfs:///shared/ckpt"
    assert new_scratch_dir(s, "posts").startswith("hdfs:///shared/ckpt/postlens/posts-")


def test_cluster_without_folder_fails():
    with pytest.raises(RuntimeError):
        scratch_root(_Session("spark://host:7077"))


def test_local_without_folder_gets_own():
    s = _Session("local[2]")
    root = scratch_root(s)
    assert root and s.sparkContext.getCheckpointDir() == root
