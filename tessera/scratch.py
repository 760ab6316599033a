"""Tables between the jobs of one operator, in the shared checkpoint folder.

A table written here cuts the lineage: a lost executor re-reads it instead of
recomputing what came before, and driver and executors all reach it. An
operator's own intermediate tables go when it returns; what a returned
DataFrame still reads goes when the driver process ends.
"""

from __future__ import annotations

import atexit

from pyspark.sql import DataFrame, SparkSession

from tessera.session import remove_scratch, scratch_path, session_conf

#: Shuffle files go when the table that they were for is written, not when the
#: driver next collects its garbage: those of an operator's jobs don't add up.
WRITE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# (JVM, its file-system settings, folder): usable after the session has stopped
_KEPT: list[tuple] = []


@atexit.register
def _remove_kept() -> None:
    while _KEPT:
        jvm, conf, path = _KEPT.pop()
        try:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
        except Exception:  # the JVM is gone: the cluster's own clean-up takes the folder
            pass


def lasting_path(spark: SparkSession, name: str) -> str:
    """A fresh folder, not yet made, that goes when the driver process ends."""
    path = scratch_path(spark, name)
    context = spark.sparkContext
    _KEPT.append((context._jvm, context._jsc.hadoopConfiguration(), path))
    return path


class Scratch:
    """``with Scratch(spark) as s``: ``s.table(df)`` writes and rereads ``df``
    and drops it at the end of the block; ``s.keep(df)`` outlives the block."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        for path in self._paths:
            remove_scratch(self.spark, path)

    def table(self, df: DataFrame, name: str = "step") -> DataFrame:
        return self._written(df, self.path(name))

    def keep(self, df: DataFrame, name: str = "result") -> DataFrame:
        return self._written(df, lasting_path(self.spark, name))

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        with session_conf(self.spark, WRITE_CONF):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def path(self, name: str) -> str:
        """A fresh folder, not yet made, that goes at the end of the block."""
        self._paths.append(scratch_path(self.spark, name))
        return self._paths[-1]

    def drop(self, df_path: str) -> None:
        self._paths.remove(df_path)
        remove_scratch(self.spark, df_path)

    @property
    def last(self) -> str:
        """Path of the table written last."""
        return self._paths[-1]


#: Estimates above this are products of unknowns, not sizes.
UNKNOWN_BYTES = 1 << 56


def plan_bytes(df: DataFrame) -> int:
    """The planner's size estimate of ``df`` (file sizes for a plain scan)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shuffle_partitions(df: DataFrame, bytes_each: int) -> int:
    """Partitions for ``df``'s data at about ``bytes_each``, no fewer than the
    session's ``spark.sql.shuffle.partitions``; that number where the planner
    knows no size (it then answers with more than :data:`UNKNOWN_BYTES`)."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = plan_bytes(df)
    return least if size > UNKNOWN_BYTES else max(least, -(-size // bytes_each))
