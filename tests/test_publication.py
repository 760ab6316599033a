"""Datasets in versions behind a manifest, and jobs through a second Hadoop scheme."""

from __future__ import annotations

import glob
import os
from datetime import date

import pytest

from tessera.plans.bronze import bronze_layer
from tessera.plans.profile_job import profile_dataset
from tessera.plans.silver import silver_layer
from tessera.sources import versions as V
from tessera.sources.parquet import read_parquet, write_parquet
from tessera.sources.snapshot import read_snapshots, require_object_store, write_snapshot


def rows(df):
    return sorted(r[0] for r in df.collect())


@pytest.fixture()
def store(spark, workdir):
    """A folder behind a scheme that isn't ``file``, as an object store is."""
    name = f"store{os.path.basename(workdir).replace('_', '').lower()}"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(f"fs.viewfs.mounttable.{name}.link./data", f"file://{workdir}")
    return f"viewfs://{name}/data"


def test_a_load_replaces_the_one_before(spark, workdir):
    path = f"{workdir}/t"
    for n in (3, 5):
        assert write_parquet(spark.range(n), path, versions=True) == path
        assert rows(read_parquet(spark, path)) == list(range(n))
    assert len(glob.glob(f"{path}/v-*")) == 1 and len(glob.glob(f"{path}/_manifest-*")) == 1


def test_stopped_between_commit_and_clean_up_one_version_is_read(spark, workdir, monkeypatch):
    path = f"{workdir}/t"
    V.publish(spark.range(3), path)

    def lost(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(V, "remove_old", lost)
    with pytest.raises(KeyboardInterrupt):
        V.publish(spark.range(10, 15), path)
    assert len(glob.glob(f"{path}/v-*")) == 2  # both are there, one is read
    assert rows(read_parquet(spark, path)) == list(range(10, 15))
    monkeypatch.undo()
    V.publish(spark.range(2), path)
    assert len(glob.glob(f"{path}/v-*")) == 1 and rows(read_parquet(spark, path)) == [0, 1]


def test_stopped_before_the_manifest_the_old_version_is_read(spark, workdir, monkeypatch):
    path = f"{workdir}/t"
    V.publish(spark.range(3), path)
    V.write_version(spark.range(9), path)
    assert rows(read_parquet(spark, path)) == [0, 1, 2]
    monkeypatch.setattr(V, "ABANDONED_MS", -10_000)
    V.publish(spark.range(4), path)  # the folder that no manifest names goes
    assert len(glob.glob(f"{path}/v-*")) == 1 and rows(read_parquet(spark, path)) == [0, 1, 2, 3]


def test_a_manifest_that_is_not_whole_does_not_count(spark, workdir):
    path = f"{workdir}/t"
    V.publish(spark.range(3), path)
    for part in ("", "version=v-", "version=v-" + "0" * 32):
        with open(f"{path}/_manifest-000000000002", "w") as f:
            f.write(part)
        assert rows(read_parquet(spark, path)) == [0, 1, 2]


def test_of_two_writers_one_is_refused(spark, workdir):
    path = f"{workdir}/t"
    V.publish(spark.range(3), path)
    first, second = V.write_version(spark.range(4), path), V.write_version(spark.range(5), path)
    V.point_to(spark, path, first, after=1)
    with pytest.raises(Exception, match="exists"):
        V.point_to(spark, path, second, after=1)
    assert rows(read_parquet(spark, path)) == [0, 1, 2, 3]


def test_a_reader_that_began_before_finishes_when_versions_are_kept(spark, workdir):
    path = f"{workdir}/t"
    V.publish(spark.range(3), path)
    began = read_parquet(spark, path)
    V.publish(spark.range(8), path, keep=2)
    assert rows(began) == [0, 1, 2] and rows(read_parquet(spark, path)) == list(range(8))
    V.publish(spark.range(1), path, keep=2)
    assert len(glob.glob(f"{path}/v-*")) == 2


def test_a_plain_dataset_turns_into_versions(spark, workdir):
    path = f"{workdir}/t"
    write_parquet(spark.range(3), path)
    write_parquet(spark.range(7), path, versions=True)
    assert rows(read_parquet(spark, path)) == list(range(7)) and not glob.glob(f"{path}/part-*")


def test_a_failed_load_leaves_the_version(spark, workdir):
    path = f"{workdir}/t"
    V.publish(spark.range(3), path)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        V.publish(spark.range(3).selectExpr("1 / (id - 1)"), path)
    assert rows(read_parquet(spark, path)) == [0, 1, 2]


def test_jobs_through_another_scheme(spark, workdir, store):
    """Bronze, silver and profile with source and destination behind a scheme that Spark alone opens."""
    with open(f"{workdir}/raw.tsv", "w") as f:
        f.write("code\tproduct_name\tgeneric_name\tlast_modified_datetime\n1\ta\t\t2026-01-01T00:00:00\n1\tb\t\t2026-01-02T00:00:00\n2\t\t\t2026-01-02T00:00:00\n")
    for _ in range(2):  # a rerun replaces
        bronze = bronze_layer(spark, f"{store}/raw.tsv", f"{store}/bronze", run_date=date(2026, 7, 1))
        assert bronze == f"{store}/bronze/2026-07-01/products.parquet"
        keep = ("code", "product_name", "last_modified_datetime")
        silver = silver_layer(spark, bronze, f"{store}/silver", run_date=date(2026, 7, 1), keep=keep, utc_columns=())
    assert read_parquet(spark, bronze).count() == 3
    assert [tuple(r)[:2] for r in read_parquet(spark, silver).collect()] == [(1, "b")]
    assert glob.glob(f"{workdir}/silver/2026-07-01/products.parquet/_manifest-*")
    assert {r["column"]: r["distinct_values"] for r in profile_dataset(spark, bronze, fmt="parquet").collect()}["code"] == 2
    write_snapshot(read_parquet(spark, silver), f"{store}/silver", date(2026, 7, 2))
    history = read_snapshots(spark, f"{store}/silver")
    assert sorted(str(r.snapshot_date) for r in history.collect()) == ["2026-07-01", "2026-07-02"]
    assert read_snapshots(spark, f"{store}/silver", dates=[date(2026, 7, 2)]).count() == 1
    assert require_object_store(f"{store}/silver", scheme="viewfs") and pytest.raises(ValueError, require_object_store, f"{store}/silver")
