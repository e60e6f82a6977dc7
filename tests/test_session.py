"""Where checkpoints go."""

from types import SimpleNamespace

import pytest

from touchline.session import shared_folder
from touchline.sources.tables import scratch_table


def pretend(master, named=None, current=None):
    """A session with the given master and settings."""
    state = {"folder": current}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["folder"],
        setCheckpointDir=lambda folder: state.update(folder=folder),
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named))


def test_a_named_folder_is_used():
    assert shared_folder(pretend("yarn", named="hdfs:///shared")) == "hdfs:///shared"
    assert shared_folder(pretend("yarn", current="hdfs:///now")) == "hdfs:///now"


def test_a_cluster_needs_a_named_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(pretend("spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(pretend("local-cluster[2,1,1024]"))


def test_a_local_session_gets_one(tmp_path):
    assert "touchline-" in shared_folder(pretend("local[2]"))


def test_written_frames_do_not_depend_on_their_source(spark):
    df = spark.range(5).selectExpr("id", "uuid() AS u")
    frame = scratch_table(df, "test")
    assert sorted(frame.collect()) == sorted(frame.collect())
