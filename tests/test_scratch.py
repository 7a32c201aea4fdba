"""Where intermediate tables go: the cluster's shared folder, a temporary one only in local mode."""

import pytest

from siftmark.sources.scratch import ensure_checkpoint_dir


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, context, **conf):
        self.sparkContext, self.conf = context, conf


def test_setting_of_the_cluster_is_used():
    session = Session(Context("spark://host"), **{"spark.checkpoint.dir": "hdfs:///shared"})
    ensure_checkpoint_dir(session)
    assert session.sparkContext.folder == "hdfs:///shared"


def test_folder_already_set_stays():
    session = Session(Context("spark://host", "hdfs:///mine"), **{"spark.checkpoint.dir": "hdfs:///shared"})
    ensure_checkpoint_dir(session)
    assert session.sparkContext.folder == "hdfs:///mine"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session(Context("spark://host")))


def test_temporary_folder_in_local_mode():
    session = Session(Context("local[2]"))
    ensure_checkpoint_dir(session)
    assert session.sparkContext.folder
