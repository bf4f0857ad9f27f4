from types import SimpleNamespace

import pytest

from holdfast.session import ensure_checkpoint_dir, materialise


class FakeContext:
    def __init__(self, master, current=None):
        self.master, self.folder = master, current

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake(master, current=None, configured=None):
    settings = {"spark.checkpoint.dir": configured}
    conf = SimpleNamespace(get=lambda key, default: settings[key] or default)
    return SimpleNamespace(sparkContext=FakeContext(master, current), conf=conf)


def test_the_folder_in_use_is_kept():
    assert ensure_checkpoint_dir(fake("yarn", "hdfs:/a", "hdfs:/b")) == "hdfs:/a"


def test_the_named_folder_is_used():
    assert ensure_checkpoint_dir(fake("yarn", None, "hdfs:/b")) == "hdfs:/b"
    assert ensure_checkpoint_dir(fake("local[2]", None, "/shared")) == "/shared"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake("spark://host:7077"))
    assert "holdfast-checkpoint-" in ensure_checkpoint_dir(fake("local[2]"))


def test_materialise_cuts_the_plan(spark):
    df = materialise(spark.range(10).selectExpr("id * 2 as x"))
    assert sorted(r.x for r in df.collect()) == list(range(0, 20, 2))
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
