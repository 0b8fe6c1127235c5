"""The shared folder: only a local master may fall back to a local one."""

from types import SimpleNamespace

import pytest

from fleetpulse import config


def _session(master, folder=None):
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: folder, set=lambda k, v: None))


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h"])
def test_a_cluster_without_shared_folder_raises_before_any_job(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        config.shared_dir(_session(master))


def test_a_named_folder_is_used_as_it_is():
    assert config.shared_dir(_session("yarn", "hdfs://x/ckpt/")) == "hdfs://x/ckpt"


def test_local_master_gets_a_folder():
    assert config.shared_dir(_session("local[2]")).startswith("/")
