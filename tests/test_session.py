"""The checkpoint folder: the session's own setting, a private folder only
in one JVM, an error on a cluster."""

import pytest

from wareshift import session


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Context:
    def __init__(self, master, made=None):
        self.master, self.made = master, made

    def getCheckpointDir(self):
        return self.made

    def setCheckpointDir(self, path):
        self.made = path


class _Session:
    def __init__(self, master, conf=None):
        self.conf, self.sparkContext = _Conf(conf or {}), _Context(master)


@pytest.mark.parametrize("master", ["yarn", "spark://h:1", "local-cluster[2,1,512]", "k8s://x"])
def test_cluster_without_shared_folder_raises(master):
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(_Session(master))


def test_named_folder_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared"})
    assert session.ensure_checkpoint_dir(s) == "hdfs:///shared"
    assert s.sparkContext.made == "hdfs:///shared"


def test_local_session_gets_a_private_folder():
    s = _Session("local[2]")
    assert "wareshift-ckpt-" in session.ensure_checkpoint_dir(s)
