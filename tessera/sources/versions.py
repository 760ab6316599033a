"""Publishing a dataset as immutable versions behind a manifest.

For file systems on which a folder can't be renamed in one step (object
stores): every load goes to a new folder ``{path}/v-{id}``, which nobody reads
yet. Once its job has committed, one small file ``{path}/_manifest-{number}``
that names the folder is written, the next number after the last one's. A
reader takes the folder of the highest manifest that is whole, so it sees one
version or the next, never both and never a part. Manifests are created, not
replaced: of two writers with the same number one is refused and its data stays
unread. What goes after that, older versions and manifests, is no reader's
concern, and a driver lost before it only leaves folders that the next load
removes.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"_manifest-(\d{12})")
_LINE = re.compile(r"version=(v-[0-9a-f]{32})\n")
#: A version without a manifest that is older than this belongs to no running load.
ABANDONED_MS = 24 * 3600 * 1000


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of any Hadoop scheme."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(path))
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _read_text(spark: SparkSession, fs, hpath) -> str:
    stream = fs.open(hpath)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _manifests(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of the whole manifests, in order; a manifest that is
    still being written is not one yet."""
    fs, root = hadoop_path(spark, path)
    if not fs.exists(root):
        return []
    out = []
    for status in fs.listStatus(root):
        name = _NAME.fullmatch(status.getPath().getName())
        line = name and _LINE.fullmatch(_read_text(spark, fs, status.getPath()))
        if line:
            out.append((int(name[1]), line[1]))
    return sorted(out)


def current_version(spark: SparkSession, path: str) -> str:
    """The folder to read for ``path``: that of its last manifest, or ``path``
    itself if it has none (a plain dataset)."""
    path = str(path).rstrip("/")
    found = _manifests(spark, path)
    return f"{path}/{found[-1][1]}" if found else path


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as a new version folder of ``path`` and return its name; no
    reader sees it yet."""
    version = f"v-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.mode("errorifexists").parquet(f"{str(path).rstrip('/')}/{version}")
    return version


def point_to(spark: SparkSession, path: str, version: str, after: int | None = None) -> int:
    """Make ``version`` the one to read, by the manifest that follows number
    ``after`` (the last one's by default); an error if that exists already.
    Returns its number."""
    path = str(path).rstrip("/")
    found = _manifests(spark, path)
    number = (after if after is not None else found[-1][0] if found else 0) + 1
    fs, target = hadoop_path(spark, f"{path}/_manifest-{number:012d}")
    stream = fs.create(target, False)
    try:
        stream.write(bytearray(f"version={version}\n".encode()))
    finally:
        stream.close()
    return number


def remove_old(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Remove all but the ``keep`` last versions with their manifests, plain
    files of a dataset that had no versions, and folders of abandoned loads."""
    path = str(path).rstrip("/")
    found = _manifests(spark, path)
    if not found:
        return
    kept, gone = {v for _, v in found[-keep:]}, {v for _, v in found[:-keep]}
    first = found[-keep:][0][0]
    fs, root = hadoop_path(spark, path)
    now = int(time.time() * 1000)
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        manifest = _NAME.fullmatch(name)
        if manifest:
            old = int(manifest[1]) < first
        elif re.fullmatch(r"v-[0-9a-f]{32}", name):
            old = name in gone or (name not in kept and now - status.getModificationTime() > ABANDONED_MS)
        else:
            old = True
        if old and name not in kept:
            fs.delete(status.getPath(), True)


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = 1) -> str:
    """Replace the dataset at ``path`` by ``df``, for readers that go by
    :func:`current_version`. ``keep`` older versions and this one stay in all
    (1: this one alone), for readers that began before."""
    spark = df.sparkSession
    path = str(path).rstrip("/")
    before = _manifests(spark, path)
    version = write_version(df, path, partition_by)
    point_to(spark, path, version, after=before[-1][0] if before else 0)
    remove_old(spark, path, keep)
    return path
