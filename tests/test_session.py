"""The shared folder comes from the session; the recommended settings are applied."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from tillroll.session import RECOMMENDED_CONF, is_single_machine, remove_path, scratch_path, shared_dir


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (configured or spark.sparkContext.getCheckpointDir())


def test_scratch_paths_are_unique_and_under_the_shared_dir(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    assert a.startswith(shared_dir(spark)) and b.startswith(shared_dir(spark))


def test_recommended_settings_are_active(spark):
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        assert spark.conf.get(key) == RECOMMENDED_CONF[key]
    assert spark.conf.get("spark.ui.enabled") == "false"


def _session(master, conf=None, checkpoint=None):
    """The parts of a session that decide about the shared folder."""
    made = []
    context = SimpleNamespace(
        master=master, getConf=lambda: SimpleNamespace(get=lambda k, d=None: (conf or {}).get(k, d)),
        getCheckpointDir=lambda: checkpoint, setCheckpointDir=made.append,
    )
    return SimpleNamespace(sparkContext=context, made=made)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[3,2,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    assert not is_single_machine(master)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_session(master))
    assert shared_dir(_session(master, {"spark.checkpoint.dir": "hdfs:///ck"})) == "hdfs:///ck"
    assert shared_dir(_session(master, checkpoint="hdfs:///own")) == "hdfs:///own"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[4,2]"])
def test_a_local_run_makes_its_folder(master):
    session = _session(master)
    folder = shared_dir(session)
    assert os.path.isdir(folder) and session.made == [folder]


def test_remove_path_deletes_a_folder(spark, scratch):
    spark.range(3).write.parquet(f"{scratch}/t")
    remove_path(spark, f"{scratch}/t")
    assert not os.path.exists(f"{scratch}/t")
