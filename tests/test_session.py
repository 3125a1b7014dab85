from types import SimpleNamespace

import pytest

from jornada.session import checkpoint_folder, shared_root


def cluster(master, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, *other: conf.get(key, *other)), sparkContext=SimpleNamespace(master=master))


@pytest.mark.parametrize("master", ["yarn", "spark://a:7077", "k8s://b"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(cluster(master, spark__sql__warehouse__dir="file:/home/me/spark-warehouse"))
    assert shared_root(cluster(master, spark__sql__warehouse__dir="hdfs://n/warehouse/")) == "hdfs://n/warehouse/_checkpoints"
    named = cluster(master, spark__checkpoint__dir="file:/mnt/shared/", spark__sql__warehouse__dir="file:/home/me/w")
    assert shared_root(named) == "file:/mnt/shared"


def test_one_machine_may_use_its_warehouse():
    assert shared_root(cluster("local[8]", spark__sql__warehouse__dir="file:/w")) == "file:/w/_checkpoints"


def test_checkpoints_go_to_the_named_folder(spark):
    assert checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert spark.sparkContext.getCheckpointDir()
