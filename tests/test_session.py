from types import SimpleNamespace

import pytest

from dayloom.session import CHECKPOINT_KEY, scratch_path, scratch_root


def session(master, conf=None, folder=None):
    """Just the parts of a session that name the scratch folder."""
    state = {"folder": folder}
    context = SimpleNamespace(
        master=master,
        getConf=lambda: SimpleNamespace(get=lambda key: (conf or {}).get(key)),
        getCheckpointDir=lambda: state["folder"],
        setCheckpointDir=lambda path: state.update(folder=f"file:{path}"),
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, other: other))


def test_the_named_folder_is_used():
    spark = session("yarn", {CHECKPOINT_KEY: "hdfs:///shared/"})
    assert scratch_root(spark) == "hdfs:///shared"
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match=CHECKPOINT_KEY):
        scratch_root(session("spark://host:7077"))


def test_a_local_session_gets_its_own():
    spark = session("local[2]")
    assert scratch_root(spark).startswith("file:/tmp/dayloom-")
    assert scratch_root(spark) == scratch_root(spark)


def test_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
