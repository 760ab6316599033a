"""Where intermediate data goes: the cluster's shared checkpoint folder."""

from __future__ import annotations

import pytest

from tessera import session as S


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master, checkpoint=None):
        self.master = master
        self.checkpoint = checkpoint

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = path


class _Session:
    def __init__(self, master, checkpoint=None, conf=None):
        self.sparkContext = _Context(master, checkpoint)
        self.conf = _Conf(conf or {})


def test_cluster_session_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.checkpoint_dir(_Session("yarn"))


def test_cluster_setting_is_used_as_given():
    spark = _Session("spark://head:7077", conf={"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert S.checkpoint_dir(spark) == "hdfs://nn/shared/ckpt"
    assert spark.sparkContext.getCheckpointDir() == "hdfs://nn/shared/ckpt/"
    assert S.scratch_path(spark, "x").startswith("hdfs://nn/shared/ckpt/tessera/x-")


def test_context_checkpoint_dir_wins():
    spark = _Session("k8s://api", checkpoint="gs://b/ckpt", conf={"spark.checkpoint.dir": "gs://other"})
    assert S.checkpoint_dir(spark) == "gs://b/ckpt"


def test_local_session_gets_its_own_folder_only_when_unset():
    spark = _Session("local[4]")
    path = S.checkpoint_dir(spark)
    assert path and spark.conf.get("spark.checkpoint.dir") == path
    assert S.checkpoint_dir(spark) == path  # registered once, then reused


def test_real_session_is_local(spark):
    assert S.is_local_session(spark)
    assert S.checkpoint_dir(spark)


def test_shuffle_partitions_follow_input_size():
    gib = 1024**3
    assert S.shuffle_partitions_for(1 * gib, cores=8) == 16  # two per core at least
    assert S.shuffle_partitions_for(100 * gib, cores=8) == 400  # 256 MiB each
    assert S.shuffle_partitions_for(100 * 1024**4, cores=8000) == 409_600  # no cap


def test_shuffles_sized_for_each_job(spark, workdir):
    import os

    path = os.path.join(workdir, "f.txt")
    with open(path, "w") as fh:
        fh.write("x" * 1000)
    assert S.input_bytes(spark, path) == 1000
    assert S.input_bytes(spark, os.path.join(workdir, "*.txt")) == 1000
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    # a count the user has set is kept, Spark's default number too
    for own in (before, "200"):
        spark.conf.set(key, own)
        with S.shuffles_sized_for(spark, path) as n:
            assert n == int(own)
    spark.conf.unset(key)
    cores = S.default_parallelism(spark)
    try:
        for expansion, wanted in ((1.0, 2 * cores), (10**9, -(-(10**12) // S.TARGET_PARTITION_BYTES))):
            if key in spark.conf.getAll:  # set for the whole application: can't be unset here
                break
            with S.shuffles_sized_for(spark, path, expansion) as n:
                assert n == wanted == int(spark.conf.get(key))
            assert key not in spark.conf.getAll
    finally:
        spark.conf.set(key, before)


def test_spread_follows_the_bytes(spark):
    one = spark.range(1000).coalesce(1)
    mib, cores = 1024**2, S.default_parallelism(spark)
    assert S.spread(one, 1000).rdd.getNumPartitions() == 1
    assert S.spread(one, 64 * mib).rdd.getNumPartitions() == min(cores, 4)
    assert S.spread(one, 100 * 1024 * mib).rdd.getNumPartitions() == 400  # more than cores
    assert S.spread(spark.range(0, 10, 1, 7), 1000).rdd.getNumPartitions() == 7


def test_object_store_options():
    assert S.object_store_conf({"fs.gs.project.id": "p", "spark.x": "1"}) == {"spark.hadoop.fs.gs.project.id": "p", "spark.x": "1"}


def test_scratch_tables_go(spark):
    import os

    from tessera import scratch

    with scratch.Scratch(spark) as s:
        assert s.table(spark.range(3)).count() == 3
        inner, kept = s.last, s.keep(spark.range(4))
        assert os.path.isdir(inner.removeprefix("file:"))
    assert not os.path.exists(inner.removeprefix("file:")) and kept.count() == 4
    path = scratch._KEPT[-1][-1].removeprefix("file:")
    assert os.path.isdir(path)
    scratch._remove_kept()
    assert not os.path.exists(path)


def test_shuffle_files_go_with_the_write(spark):
    import glob
    import time

    from tessera import scratch

    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before, key = files(), next(iter(scratch.WRITE_CONF))
    setting = spark.conf.get(key, None)
    with scratch.Scratch(spark) as s:
        table = s.table(spark.range(0, 1000, 1, 4).repartition(3, "id"))
        ends = time.time() + 20
        while files() - before and time.time() < ends:
            time.sleep(0.1)
        assert not files() - before
        assert table.count() == 1000
    assert spark.conf.get(key, None) == setting
