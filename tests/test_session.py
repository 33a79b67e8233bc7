"""Scratch locations: the session's shared checkpoint folder, never a
machine-local folder outside local mode."""

import pytest

from tessera.session import checkpoint_dir, scratch_path


class _Conf(dict):
    def get(self, k, default=None):
        return dict.get(self, k, default)

    def set(self, k, v):
        self[k] = v


class _Session:
    def __init__(self, conf):
        self.conf = _Conf(conf)

    @property
    def sparkContext(self):  # a client without a local context
        raise RuntimeError("no context")


def test_cluster_without_checkpoint_dir_refuses():
    with pytest.raises(ValueError):
        checkpoint_dir(_Session({"spark.master": "yarn"}))


def test_cluster_uses_configured_shared_folder():
    s = _Session({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs://nn/shared/ckpt"
    assert scratch_path(s, "x").startswith("hdfs://nn/shared/ckpt/tessera-scratch/x-")


def test_local_session_gets_a_folder(spark):
    d = checkpoint_dir(spark)
    assert d and spark.conf.get("spark.checkpoint.dir") == d
