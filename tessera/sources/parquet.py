"""Parquet scan and sink."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.versions import current_version, publish
from tessera.sources.versions import hadoop_path as _fs


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columnar scan; Catalyst prunes columns and pushes filters into it. Of a
    dataset in versions (:mod:`tessera.sources.versions`) the current one is read."""
    return spark.read.parquet(current_version(spark, path))


def _swap(fs, staged, target, aside) -> None:
    """``staged`` in the place of ``target`` by renames; if the second one fails
    the old folder comes back."""
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"could not move {target} aside")
    moved = False
    try:
        moved = fs.rename(staged, target)
        if not moved:
            raise OSError(f"could not move {staged} to {target}")
    finally:
        if had and not moved and not fs.rename(aside, target):
            raise OSError(f"the previous data of {target} is in {aside}")
    if had:
        fs.delete(aside, True)


# File systems on which a folder is renamed as one step, without copying. (What
# is behind a viewfs mount may be an object store.)
RENAMES = ("file", "hdfs", "abfs", "abfss")


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), versions: bool | None = None) -> str:
    """Write ``df`` as a Parquet dataset at ``path``; a rerun replaces it.

    Failed tasks are retried on other executors by Spark, and a job that fails
    leaves the previous data at ``path``. (``mode("overwrite")`` alone deletes it
    before the first row is written.) ``partition_by`` writes one folder per value.

    Where folders are renamed in one step the new data is written beside
    ``path``; once the job has committed, the old folder is moved aside, the new
    one moved in and the old one deleted, and a rename that fails is undone. On
    an object store, where a rename copies every byte, the data is published as
    a version behind a manifest (:func:`tessera.sources.versions.publish`), and
    :func:`read_parquet` reads it. ``versions`` asks for one of the two.
    """
    path = str(path).rstrip("/")
    spark = df.sparkSession
    fs, target = _fs(spark, path)
    if versions is None:
        versions = fs.getUri().getScheme() not in RENAMES
    if versions:
        return publish(df, path, partition_by)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    tag = uuid.uuid4().hex
    staging = f"{path}.__writing-{tag}"
    writer.mode("errorifexists").parquet(staging)
    _swap(fs, _fs(spark, staging)[1], target, _fs(spark, f"{path}.__before-{tag}")[1])
    return path
