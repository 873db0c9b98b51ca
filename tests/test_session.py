from types import SimpleNamespace

import pytest

from patrolspark.session import shared_dir


def fake(master, folder=None):
    made = []
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None,
                         setCheckpointDir=made.append)
    conf = SimpleNamespace(get=lambda key, default=None: folder)
    return SimpleNamespace(sparkContext=sc, conf=conf)


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(fake(master))


def test_the_named_folder_or_a_local_one():
    assert shared_dir(fake("yarn", "hdfs:///ck")) == "hdfs:///ck"
    assert "patrolspark-ckpt-" in shared_dir(fake("local[4]"))
