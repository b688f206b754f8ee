"""The checkpoint folder comes from the session; a cluster never gets a local one."""

import pytest

from crashgrid.session import RUNTIME_CONF, apply_runtime_conf, checkpoint_dir


class _Conf:
    def __init__(self, value=None):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default


class _Context:
    def __init__(self, master, configured=None, current=None):
        self.master = master
        self._conf = _Conf(configured)
        self._dir = current

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self._dir = d


class _Session:
    def __init__(self, master, configured=None, current=None):
        self.sparkContext = _Context(master, configured, current)
        self.conf = _Conf(None)


def test_existing_folder_is_kept():
    s = _Session("yarn", current="hdfs:///shared/ckpt")
    assert checkpoint_dir(s, fallback="/tmp/x") == "hdfs:///shared/ckpt"


def test_configured_folder_is_used():
    s = _Session("yarn", configured="s3a://bucket/ckpt")
    assert checkpoint_dir(s) == "s3a://bucket/ckpt"


def test_cluster_without_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session("spark://host:7077"))


def test_local_mode_gets_a_temp_folder():
    assert checkpoint_dir(_Session("local[2]"))


def test_settings_of_the_submitter_are_kept(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "256m")
    try:
        apply_runtime_conf(spark)
        assert spark.conf.get(key) == "256m"
        spark.conf.unset(key)
        apply_runtime_conf(spark)
        assert spark.conf.get(key) in (old, RUNTIME_CONF[key])
    finally:
        spark.conf.set(key, old)
