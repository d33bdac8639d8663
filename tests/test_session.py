"""The shared folder for intermediate data."""

from types import SimpleNamespace

import pytest

from docloom import session


def fake(master, conf=None):
    context = SimpleNamespace(master=master, folder=None)
    context.getCheckpointDir = lambda: context.folder
    context.setCheckpointDir = lambda folder: setattr(context, "folder", folder)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: conf))


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(fake(master))


def test_the_named_folder_is_used():
    assert session.checkpoint_dir(fake("yarn", "hdfs://shared")) == "hdfs://shared"
    assert session.checkpoint_dir(fake("local[4]")).startswith("/")
