"""tessera: Spark-native medallion pipeline over wide product-style tables.

Raw delimited snapshots are typed from the whole file and kept as Parquet
(bronze), curated to one row per key with UTC timestamps (silver), profiled
column by column in one job, checked rule by rule, and aggregated into marts.
"""

from tessera.session import (
    build_session,
    checkpoint_dir,
    scratch_path,
    shuffle_partitions_for,
    shuffles_sized_for,
)

__all__ = ["build_session", "checkpoint_dir", "scratch_path", "shuffle_partitions_for", "shuffles_sized_for"]
