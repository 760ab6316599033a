"""Session construction and the shared scratch folder.

Every job in the library runs on whatever ``SparkSession`` it is handed; this
module only offers a sensible builder for scripts and tests, and the one place
that decides where intermediate data may be written.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that every session of this library wants. Timestamps are compared
# and rendered in UTC (the silver rules normalise to UTC), AQE re-plans shuffles
# at run time (partition coalescing, skewed-partition splitting) and the web UI
# stays off.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # remove reliable-checkpoint files once their RDD is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def object_store_conf(options: dict[str, str]) -> dict[str, str]:
    """Session settings from Hadoop file-system options of an object store:
    ``{"fs.gs.project.id": "p"}`` becomes ``{"spark.hadoop.fs.gs.project.id": "p"}``,
    ``spark.`` settings stay. Credentials are given by the caller, never read
    from the environment here."""
    return {k if k.startswith("spark.") else f"spark.hadoop.{k}": v for k, v in options.items()}


def build_session(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with :data:`BASE_CONF` applied.

    ``conf`` may hold Hadoop file-system options (:func:`object_store_conf`).
    ``master`` is left to the launcher (``spark-submit``) when ``None``.
    ``shuffle_partitions`` is the *initial* partition count of a shuffle; AQE
    coalesces it down at run time, so on a cluster it should be sized for the
    largest shuffle, not the smallest (:func:`shuffle_partitions_for`,
    :func:`shuffles_sized_for`).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **object_store_conf(conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _master(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.master
    except Exception:  # Spark Connect has no SparkContext
        return spark.conf.get("spark.master", "") or ""


def is_local_session(spark: SparkSession) -> bool:
    """True when driver and executors share one machine (``local[...]``)."""
    return _master(spark).startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate data.

    On a cluster this is the folder the cluster names in
    ``spark.checkpoint.dir`` (shared storage every executor can reach); a
    cluster session without one is refused rather than given a folder of a
    single machine. Only a local session (a test or a laptop) without the
    setting gets a folder of our own, created and registered here.
    """
    configured = None
    try:
        configured = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        configured = None
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local_session(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder on storage every executor can reach "
                "(e.g. an object-store or HDFS path) for staged and checkpointed data"
            )
        configured = tempfile.mkdtemp(prefix="tessera-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", configured)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        # Spark works in a folder of its own below: always name that one
        configured = spark.sparkContext.getCheckpointDir() or configured
    except Exception:
        pass
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below :func:`checkpoint_dir` for one run's output."""
    return f"{checkpoint_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"


# Target bytes of one shuffle partition: large enough that task overhead is
# small, small enough that a task's sort / hash buffers rarely spill.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


# Most columns of a staged table that type inference unpivots at a time. Spark
# compiles a stage into one generated function only up to
# spark.sql.codegen.maxFields (100) columns; a wider Parquet table is unpivoted
# in chunks, each reading only its own columns.
MAX_UNPIVOT_COLUMNS = 64


def column_chunks(items: list, size: int = MAX_UNPIVOT_COLUMNS) -> list[list]:
    """``items`` in consecutive chunks of at most ``size``."""
    return [items[i : i + size] for i in range(0, len(items), size)]


def shuffle_partitions_for(shuffle_bytes: int, cores: int, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Initial shuffle partition count for a shuffle of about ``shuffle_bytes``:
    about ``target_bytes`` per partition at every size, at least two per core so
    every core has work and stragglers are short."""
    return int(max(2 * int(cores), -(-int(shuffle_bytes) // int(target_bytes))))


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of a file or folder on any Hadoop file system (local, HDFS,
    object store), read from the file system's metadata, not the data. Globs
    are summed over their matches."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(str(path))
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    matches = fs.globStatus(hpath) or []
    return int(sum(fs.getContentSummary(st.getPath()).getLength() for st in matches))


@contextmanager
def shuffles_sized_for(spark: SparkSession, path: str, expansion: float = 1.0) -> Iterator[int]:
    """Within the block, ``spark.sql.shuffle.partitions`` follows the size of
    ``path`` and the count is yielded; a count that the user has set, in the
    session or for the application, stays. The session is as before afterwards,
    so each job is sized for its own input. ``expansion`` scales the input size
    to the expected shuffle size (e.g. > 1 for decompressed text)."""
    key = "spark.sql.shuffle.partitions"
    if key in spark.conf.getAll:
        yield int(spark.conf.get(key))
        return
    spark.conf.set(key, str(shuffle_partitions_for(int(input_bytes(spark, path) * expansion), default_parallelism(spark))))
    try:
        yield int(spark.conf.get(key))
    finally:
        spark.conf.unset(key)


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Within the block the session has these settings; for jobs that run in it."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def default_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:
        return int(os.cpu_count() or 8)


# Text in one piece of a spread input.
SPREAD_BYTES = 256 * 1024 * 1024


def spread(df: DataFrame, input_size: int, piece_bytes: int = SPREAD_BYTES) -> DataFrame:
    """Round-robin the rows into pieces of about ``piece_bytes``, before per-row
    heavy work on an input whose partitions can't be split (gzip files, or text
    read with line breaks in its fields). There are at least as many pieces as
    cores while a piece has a sixteenth of that, and an input that has enough
    partitions already is left as it is."""
    pieces = spread_pieces(df.sparkSession, input_size, piece_bytes)
    return df.repartition(pieces) if pieces > df.rdd.getNumPartitions() else df


def spread_pieces(spark: SparkSession, input_size: int, piece_bytes: int = SPREAD_BYTES) -> int:
    """The number of pieces of :func:`spread`."""
    by_size = -(-int(input_size) // int(piece_bytes))
    by_cores = min(default_parallelism(spark), -(-16 * int(input_size) // int(piece_bytes)))
    return max(1, by_size, by_cores)


def remove_scratch(spark: SparkSession, path: str) -> bool:
    """Delete a folder this library created below :func:`scratch_path` (through
    the Hadoop file system, so shared storage works too). Other paths are
    refused."""
    root = f"{checkpoint_dir(spark)}/tessera/"
    if not str(path).startswith(root):
        raise ValueError(f"not a scratch path of this session: {path}")
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))
