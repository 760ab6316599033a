"""Bronze job: raw delimited snapshot -> typed, complete Parquet copy.

No column pruning, no row filter, no deduplication: every source column, in
source order, typed from the whole file.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.projection import passthrough
from tessera.session import remove_scratch
from tessera.sources.snapshot import require_object_store, write_snapshot
from tessera.sources.tsv import read_tsv, read_tsv_staged


def bronze_transform(spark: SparkSession, source_path: str, sep: str = "\t", multiline: bool | str = True) -> DataFrame:
    """The bronze table as a DataFrame (scan + full-file typing + ``SELECT *``)."""
    return passthrough(read_tsv(spark, source_path, sep=sep, multiline=multiline))


def bronze_layer(
    spark: SparkSession,
    source_path: str,
    dest_dir: str,
    run_date: date | None = None,
    gcs: bool = False,
    sep: str = "\t",
    multiline: bool | str = True,
) -> str:
    """Write the bronze snapshot of ``run_date`` (default today) and return
    ``{dest_dir}/{YYYY-MM-DD}/products.parquet``. A rerun replaces it.

    ``gcs=True`` asks for an object-store destination (a ``gs://`` URI);
    local and remote paths otherwise go through the same writer, which creates
    folders itself. The staged text copy is removed once the snapshot is
    written. ``multiline`` is that of :func:`tessera.sources.tsv.read_tsv`.
    """
    if gcs:
        require_object_store(dest_dir)
    typed, staged = read_tsv_staged(spark, source_path, sep=sep, multiline=multiline)
    try:
        return write_snapshot(passthrough(typed), dest_dir, run_date)
    finally:
        if staged:
            remove_scratch(spark, staged)
