"""Mart jobs over the silver table: the categorical and temporal dashboard
tiles, and the partitioned, clustered product fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import qcol
from tessera.functions.dates import truncate_period
from tessera.functions.multivalue import values_of
from tessera.functions.nulls import DEFAULT_PLACEHOLDERS, placeholder_to_null
from tessera.operators.aggregates import counts_by_period
from tessera.operators.topk import top_n_other
from tessera.sources.warehouse import write_partitioned


def multivalue_mart(
    df: DataFrame,
    column: str = "countries_tags",
    n: int = 10,
    label: str = "label",
    count_col: str = "products",
    sep: str = ",",
    drop_empty: bool = True,
) -> DataFrame:
    """Products per element of a multi-value field (e.g. per country), the
    ``n`` largest kept and the rest folded into ``Other``."""
    elements = df.select(F.explode(values_of(df, column, sep=sep, trim=True, drop_empty=drop_empty)).alias("_element"))
    return top_n_other(elements, "_element", n, label=label, count_col=count_col)


def category_mart(
    df: DataFrame,
    column: str = "main_category",
    n: int = 10,
    label: str = "label",
    count_col: str = "products",
    placeholders: Sequence[str] = DEFAULT_PLACEHOLDERS,
    nulls: str = "other",
) -> DataFrame:
    """Products per category, top ``n`` + Other. Placeholders count as missing,
    and missing takes none of the ``n`` places; ``nulls`` as in :func:`top_n_other`."""
    values = df.select(placeholder_to_null(qcol(column), placeholders).alias("_value"))
    return top_n_other(values, "_value", n, label=label, count_col=count_col, nulls=nulls)


def additions_mart(df: DataFrame, column: str = "created_datetime", unit: str = "day") -> DataFrame:
    """Products added per day / week / month."""
    return counts_by_period(df, column, unit, alias="period", count_col="products")


def product_fact(df: DataFrame, date_column: str = "created_datetime") -> DataFrame:
    """Silver rows with the date keys a partitioned fact table is laid out by."""
    return df.withColumns(
        {
            "created_date": truncate_period(date_column, "day"),
            "created_month": truncate_period(date_column, "month"),
        }
    )


def write_product_fact(
    df: DataFrame,
    path: str,
    date_column: str = "created_datetime",
    partition_by: Sequence[str] = ("created_month",),
    cluster_by: Sequence[str] = ("main_category",),
) -> str:
    """Write the fact table partitioned by month and clustered by category;
    a filter on ``created_month`` later prunes whole folders."""
    return write_partitioned(product_fact(df, date_column), path, partition_by, cluster_by)
