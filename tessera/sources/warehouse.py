"""Warehouse tables: the plain load of silver, and partitioned, clustered marts."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tessera.functions.columns import qcol, quote_name
from tessera.sources.parquet import write_parquet


def _parts(table: str) -> list[str]:
    """The parts of a table name; a catalog and a database are optional."""
    return str(table).split(".")


def _qualified(*parts: str) -> str:
    return ".".join(map(quote_name, parts))


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """``database`` may carry a catalog (``catalog.database``)."""
    place = str(location).replace("\\", "\\\\").replace("'", "\\'") if location else None
    loc = f" LOCATION '{place}'" if place else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_qualified(*_parts(database))}{loc}")


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def _remove(spark: SparkSession, path: str) -> None:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def load_table(
    df: DataFrame,
    table: str = "raw.products",
    path: str | None = None,
    database_location: str | None = None,
) -> str:
    """Load ``df`` unchanged into a catalog table (e.g. the ``raw`` layer), named
    ``table``, ``database.table`` or ``catalog.database.table``.

    ``path`` makes it an external table below that location (shared storage
    on a cluster); without it the table lives in the session's warehouse
    folder. ``database_location`` places a database created here. A rerun
    replaces the table.

    With ``path`` every load is written to a new version folder
    ``{path}/v-{id}`` first; only when that job has committed is the table
    pointed at it, by ``ALTER TABLE ... SET LOCATION``, and the previous version
    folder removed. At every moment there is a table, whole and readable. (A
    load with other columns replaces the table's definition, which takes a drop
    and a create; :func:`load_view` has no such gap.)
    """
    spark = df.sparkSession
    parts = _parts(table)
    name = _qualified(*parts)
    if len(parts) > 1:
        ensure_database(spark, ".".join(parts[:-1]), database_location)
    if not path:
        df.write.mode("overwrite").format("parquet").saveAsTable(name)
        return table

    root = str(path).rstrip("/")
    version = f"{root}/v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(version)
    written = spark.read.parquet(version)
    previous = None
    if spark.catalog.tableExists(name):
        previous = _location(spark, name)
        if spark.table(name).dtypes == written.dtypes:
            place = version.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
            spark.catalog.refreshTable(name)
        else:
            spark.sql(f"DROP TABLE {name}")  # external: the data stays
            spark.catalog.createTable(name, path=version, source="parquet")
    else:
        spark.catalog.createTable(name, path=version, source="parquet")
    if previous and f"{root}/v-" in previous:
        _remove(spark, previous)
    return table


def layout_for_write(
    df: DataFrame,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    target_partitions: int | None = None,
) -> DataFrame:
    """Rows arranged for a partitioned, clustered write.

    A ``REBALANCE`` by the partition keys: one hash exchange that sends each
    partition value to one task (so a folder gets one file, not one per task),
    while AQE splits a value that holds a large share of all rows over several
    tasks and merges small ones up to the advisory partition size. Unlike a
    range partitioning it needs no extra pass over the input to sample bounds.
    Inside each task rows are sorted by partition and cluster keys, so the
    Parquet row groups are clustered and their min/max statistics prune well.
    """
    keys = [qcol(c) for c in (*partition_by, *cluster_by)]
    hint_args = ([target_partitions] if target_partitions else []) + [qcol(c) for c in partition_by]
    return df.hint("rebalance", *hint_args).sortWithinPartitions(*keys)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    target_partitions: int | None = None,
) -> str:
    """Write a mart partitioned by ``partition_by`` (one folder per value) and
    clustered by ``cluster_by`` inside its files; see :func:`layout_for_write`."""
    laid_out = layout_for_write(df, partition_by, cluster_by, target_partitions)
    return write_parquet(laid_out, path, partition_by=list(partition_by))


def refresh_partitions(df: DataFrame, path: str, partition_by: Sequence[str], cluster_by: Sequence[str] = ()) -> str:
    """Replace those partitions of a mart at ``path`` that ``df`` has rows of, and
    no others (their files stay as they are). Running it again gives the same.

    Spark's dynamic partition overwrite: tasks write to a staging folder, and
    when the job has committed, each new partition takes the place of the old
    one. A job that fails leaves all as it was. A partition that is to be emptied
    has no row in ``df``; remove its folder.
    """
    laid_out = layout_for_write(df, partition_by, cluster_by)
    laid_out.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*partition_by).parquet(str(path))
    return str(path)


def load_view(df: DataFrame, view: str, path: str, keep: int = 1) -> str:
    """Load ``df`` into a version table behind a view, whatever its columns.

    The rows go to ``{path}/v-{id}`` and a table ``{view}__v{id}`` over it; the
    one catalog call ``CREATE OR REPLACE VIEW`` then takes readers from the last
    version to this one, also when columns were added, dropped or changed. At
    every moment the name stands for one whole version. ``keep`` versions stay,
    this one included; older ones are dropped after the swap, with their files.
    """
    spark = df.sparkSession
    parts = _parts(view)
    if len(parts) > 1:
        ensure_database(spark, ".".join(parts[:-1]))
    tag = uuid.uuid4().hex
    location = f"{str(path).rstrip('/')}/v-{tag}"
    df.write.mode("errorifexists").parquet(location)
    table = _qualified(*parts[:-1], f"{parts[-1]}__v{tag}")
    spark.catalog.createTable(table, path=location, source="parquet", description=str(time.time_ns()))
    columns = ", ".join(quote_name(c) for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {_qualified(*parts)} AS SELECT {columns} FROM {table}")
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES{' IN ' + _qualified(*parts[:-1]) if len(parts) > 1 else ''}").collect()]
    mine = [n for n in names if re.fullmatch(re.escape(parts[-1].lower()) + "__v[0-9a-f]{32}", n.lower())]
    versions = []
    for name in mine:
        full = _qualified(*parts[:-1], name)
        made = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {full}").collect()}
        versions.append((int(made["Comment"]), full, made["Location"]))
    for _, full, folder in sorted(versions)[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        _remove(spark, folder)
    return view


def write_bucketed_table(
    df: DataFrame,
    table: str,
    buckets: int,
    bucket_by: Sequence[str],
    sort_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> str:
    """Catalog table bucketed (and sorted) on ``bucket_by``, so later joins and
    aggregations on those keys read co-partitioned data without a shuffle.

    With ``path`` the data goes to a new version folder ``{path}/v-{id}`` as a
    table under a temporary name. Once that job has committed, an existing table
    is pointed at the folder, as in :func:`load_table` (its columns and buckets
    must be the same; otherwise it is dropped and the new one renamed into its
    place). A write that fails part-way leaves the previous table whole.
    """
    spark = df.sparkSession
    parts = _parts(table)
    name = _qualified(*parts)
    if len(parts) > 1:
        ensure_database(spark, ".".join(parts[:-1]))

    def write(target: str, target_path: str | None, mode: str) -> None:
        w = df.write.format("parquet").bucketBy(buckets, *bucket_by)
        if sort_by:
            w = w.sortBy(*sort_by)
        if partition_by:
            w = w.partitionBy(*partition_by)
        (w.option("path", target_path) if target_path else w).mode(mode).saveAsTable(target)

    if not path:
        write(name, None, "overwrite")
        return table

    root, tag = str(path).rstrip("/"), uuid.uuid4().hex
    version = f"{root}/v-{tag}"
    if not spark.catalog.tableExists(name):
        write(name, version, "errorifexists")
        return table
    previous = _location(spark, name)
    staging = _qualified(*parts[:-1], f"{parts[-1]}__v{tag}")
    write(staging, version, "errorifexists")
    layout = lambda t: [tuple(r)[:2] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {t}").collect() if r["col_name"] in ("Num Buckets", "Bucket Columns", "Sort Columns")]
    if spark.table(name).dtypes == spark.table(staging).dtypes and layout(name) == layout(staging) and not partition_by:
        place = version.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
        spark.catalog.refreshTable(name)
        spark.sql(f"DROP TABLE {staging}")  # external: the data stays
    else:
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
    if f"{root}/v-" in previous:
        _remove(spark, previous)
    return table
