"""Silver job: bronze -> one curated row per key.

Logical order, as in the curation rules: scan -> drop rows without a key or
without any name -> rank rows of each key newest first -> keep rank 1 ->
normalise timestamps to UTC -> keep the curated columns -> write.

Physically: the keep-list and the two filters reach the Parquet scan (column
pruning, ``IsNotNull`` pushed down); the ranking is one shuffle by key with a
partial top-1 before it (``WindowGroupLimit``), so duplicates and hot keys are
reduced map-side.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tessera.functions.columns import qcol
from tessera.functions.nulls import DEFAULT_PLACEHOLDERS, placeholder_to_null
from tessera.functions.timezone import normalize_utc
from tessera.operators.dedup import latest_per_key
from tessera.operators.filters import any_of_present, not_null
from tessera.operators.projection import SILVER_COLUMNS, SPARSE_COLUMNS, drop_columns, keep_columns
from tessera.sources.parquet import read_parquet
from tessera.sources.snapshot import require_object_store, write_snapshot

# The defaults of the product table's curation rules.
KEY = "code"
ORDER_BY = ("last_modified_datetime",)
NAME_COLUMNS = ("product_name", "generic_name")
UTC_COLUMNS = ("created_datetime", "last_modified_datetime")


def silver_transform(
    df: DataFrame,
    key: str = KEY,
    order_by: str | Sequence[str] = ORDER_BY,
    name_columns: Sequence[str] = NAME_COLUMNS,
    keep: Sequence[str] | None = SILVER_COLUMNS,
    utc_columns: Sequence[str] = UTC_COLUMNS,
    utc_mode: str = "wall",
    placeholder_columns: Sequence[str] = (),
    placeholders: Sequence[str] = DEFAULT_PLACEHOLDERS,
    drop: Sequence[str] = SPARSE_COLUMNS,
) -> DataFrame:
    """Curate ``df`` to one row per ``key``.

    * rows with a NULL key, or with every ``name_columns`` NULL, are dropped
      *before* ranking, so a newer unusable row cannot hide an older good one;
    * of each key the first row by ``order_by`` descending (NULLs last) is
      kept - put a unique column last in ``order_by`` for a deterministic
      winner when timestamps tie;
    * ``utc_columns`` are normalised to UTC (``utc_mode``: ``"wall"`` gives
      naive UTC wall time for zoned and naive inputs, ``"flip"`` is exactly
      ``AT TIME ZONE 'UTC'``);
    * ``placeholder_columns`` get placeholder strings replaced by NULL (off by
      default, as in the curation job);
    * ``keep`` selects the output columns in order (``None`` keeps all but the
      sparse ones, ``drop``).
    """
    curated = any_of_present(not_null(df, key), name_columns)
    latest = latest_per_key(curated, key, order_by, descending=True)
    present_utc = [c for c in utc_columns if c in df.columns]
    normalized = normalize_utc(latest, present_utc, mode=utc_mode) if present_utc else latest
    if placeholder_columns:
        normalized = normalized.withColumns(
            {c: placeholder_to_null(qcol(c), placeholders) for c in placeholder_columns}
        )
    return keep_columns(normalized, keep) if keep is not None else drop_columns(normalized, drop)


def silver_layer(
    spark: SparkSession,
    bronze_path: str,
    dest_dir: str,
    run_date: date | None = None,
    gcs: bool = False,
    **options,
) -> str:
    """Read a bronze snapshot, curate it and write the silver snapshot of
    ``run_date``; return ``{dest_dir}/{YYYY-MM-DD}/products.parquet``.
    ``gcs=True`` asks for a ``gs://`` destination, as in :func:`bronze_layer`."""
    if gcs:
        require_object_store(dest_dir)
    curated = silver_transform(read_parquet(spark, str(bronze_path)), **options)
    return write_snapshot(curated, str(dest_dir), run_date)
