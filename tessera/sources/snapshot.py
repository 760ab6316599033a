"""Dated snapshot layout: ``{dest}/{YYYY-MM-DD}/products.parquet``.

Local folders and object-store URIs (``gs://``, ``s3a://``, ``abfss://`` ...)
are the same to Spark's Hadoop file system layer, so there is no separate
remote code path: the writer creates the folders, no local ``mkdir`` is done.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.parquet import write_parquet
from tessera.sources.versions import current_version, hadoop_path

DEFAULT_NAME = "products.parquet"


def snapshot_path(dest_dir: str, run_date: date | None = None, name: str = DEFAULT_NAME) -> str:
    """Path of one run's snapshot; a trailing ``/`` on ``dest_dir`` is ignored."""
    run_date = run_date or date.today()
    return f"{str(dest_dir).rstrip('/')}/{run_date.isoformat()}/{name}"


def write_snapshot(df: DataFrame, dest_dir: str, run_date: date | None = None, name: str = DEFAULT_NAME, versions: bool | None = None) -> str:
    """Write ``df`` as the snapshot of ``run_date`` (rerun = replace); return its
    path. ``versions`` is that of :func:`tessera.sources.parquet.write_parquet`."""
    return write_parquet(df, snapshot_path(dest_dir, run_date, name), versions=versions)


def read_snapshots(
    spark: SparkSession,
    dest_dir: str,
    name: str = DEFAULT_NAME,
    dates: Iterable[date] | None = None,
) -> DataFrame:
    """Snapshots below ``dest_dir`` read at once, with a ``snapshot_date``
    column taken from each file's path.

    ``dates`` reads only those runs: the folders are named in the scan, so the
    others are never listed or opened. Of a snapshot in versions the current one
    is read. The date is cut out of the path with plain string functions (no
    pattern engine per row).
    """
    root = str(dest_dir).rstrip("/")
    if dates is None:
        fs, pattern = hadoop_path(spark, f"{root}/*/{name}")
        paths = [s.getPath().toString() for s in fs.globStatus(pattern) or []]
        if not paths:
            raise FileNotFoundError(f"no snapshot {name} below {root}")
    else:
        paths = [snapshot_path(root, d, name) for d in dates]
        if not paths:
            raise ValueError("dates is empty")
    df = spark.read.parquet(*[current_version(spark, p) for p in paths])
    # .../{YYYY-MM-DD}/{name}/part-....parquet -> YYYY-MM-DD
    run_folder = F.substring_index(F.substring_index(F.col("_metadata.file_path"), f"/{name}/", 1), "/", -1)
    return df.withColumn("snapshot_date", F.to_date(run_folder))


def require_object_store(dest_dir: str, scheme: str = "gs") -> str:
    """The explicit object-store switch of the jobs (``gcs=True``): the
    destination must be a ``{scheme}://`` URI. Nothing is guessed from the
    path otherwise, and access itself comes from the session's Hadoop file
    system settings (:func:`tessera.session.object_store_conf`)."""
    if not str(dest_dir).startswith(f"{scheme}://"):
        raise ValueError(f"an object-store destination must be a {scheme}:// URI, got {dest_dir!r}")
    return str(dest_dir)
