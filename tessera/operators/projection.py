"""Projections: passthrough, keep-lists, drop-lists, aliasing, rename and cast.

All of these are pure projections; Catalyst collapses them into the scan's
``ReadSchema`` so only the kept columns are ever read from Parquet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tessera.functions.columns import qcol

# The curated column set of the product table, in output order.
SILVER_COLUMNS = (
    "code",
    "product_name",
    "generic_name",
    "created_datetime",
    "last_modified_datetime",
    "countries_tags",
    "brands",
    "categories_tags",
    "categories",
    "main_category",
    "completeness",
    "quantity",
    "product_quantity",
)

# The sparse or placeholder-filled columns the curation spec drops.
SPARSE_COLUMNS = (
    "nova_group",
    "nutriscore_grade",
    "nutriscore_score",
    "environmental_score_grade",
    "environmental_score_score",
    "pnns_groups_1",
    "pnns_groups_2",
    "cities",
    "states",
    "brand_owner",
)


def passthrough(df: DataFrame) -> DataFrame:
    """``SELECT *``: every column, same order, same types."""
    return df.select(*[qcol(c) for c in df.columns])


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep ``columns`` in the given order (names may hold any character)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the input: {missing}")
    return df.select(*[qcol(c) for c in columns])


def drop_columns(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """Drop ``columns``; names absent from the input are ignored unless ``strict``."""
    if strict:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"columns not in the input: {missing}")
    drop = set(columns)
    return df.select(*[qcol(c) for c in df.columns if c not in drop])


def rename_cast(
    df: DataFrame, spec: Mapping[str, tuple[str, str | None]], safe: bool = False
) -> DataFrame:
    """Staging step: ``{old: (new, type or None)}``; other columns pass through.

    A value that does not fit its new type is an error (ANSI ``CAST``). With
    ``safe`` it becomes NULL instead (``try_cast``). Names not in ``df`` are an
    error too.
    """
    missing = [c for c in spec if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the input: {missing}")
    out = []
    for c in df.columns:
        new, type_name = spec.get(c, (c, None))
        col = qcol(c)
        if type_name is not None:
            col = col.try_cast(type_name) if safe else col.cast(type_name)
        out.append(col.alias(new))
    return df.select(*out)
