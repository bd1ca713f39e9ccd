"""The shared scratch folder: given, private for a local master, or an error."""

import pytest

from pulsekit import session as S


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path

    def getConf(self):
        return _Conf()


class _Session:
    def __init__(self, master):
        self.sparkContext, self.conf = _Context(master), _Conf()


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_unset_folder_on_a_cluster_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.checkpoint_root(_Session(master))


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_unset_folder_on_a_local_master_is_private(master):
    assert "pulsekit-ckpt-" in S.checkpoint_root(_Session(master))


def test_given_folder_is_used(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    a, b = S.scratch_path(spark, "x"), S.scratch_path(spark, "x")
    assert configured.split(":")[-1] in a and a != b
