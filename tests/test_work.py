"""Folders for intermediate data."""

import pytest

from boardloom.plans import work


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, named=""):
        self.sparkContext, self.named = Context(master), named

    @property
    def conf(self):
        return self

    def get(self, _, default):
        return self.named or default


def test_only_local_masters_get_a_temporary_folder():
    assert work.shared_folder(Session("local[4]")).rpartition("/")[2].startswith("boardloom-")
    assert work.shared_folder(Session("spark://host:7077", "hdfs:///shared")) == "hdfs:///shared"
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,512]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work.shared_folder(Session(master))
