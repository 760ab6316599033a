"""Column references by name, for any name a source file may carry."""

from __future__ import annotations

from itertools import count, islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quote_name(name: str) -> str:
    """Back-quote a column name so dots, spaces and quotes are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    """``F.col`` for an arbitrary column name (a dynamic, quoted column list)."""
    return F.col(quote_name(name))


def fresh_names(df: DataFrame, n: int) -> list[str]:
    """``n`` names for helper columns that no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    return list(islice((name for i in count() if (name := f"_helper{i}") not in taken), n))


def resolve(df: DataFrame, name: str) -> str:
    """The column of ``df`` that SQL takes ``name`` for: the exact name, else
    the only one that differs in case alone."""
    if name in df.columns:
        return name
    alike = [c for c in df.columns if c.lower() == name.lower()]
    if len(alike) != 1:
        raise ValueError(f"{'ambiguous' if alike else 'no such'} column: {name}")
    return alike[0]


def has_map(dtype: T.DataType) -> bool:
    """Maps can be neither grouped nor hashed, also inside arrays and structs."""
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(has_map(f.dataType) for f in dtype.fields)
    return False


def map_free(col: Column, dtype: T.DataType) -> Column:
    """``col`` with every map, at any depth, as its entries sorted by key: equal
    maps become equal values that can be grouped."""
    if not has_map(dtype):
        return col
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: map_free(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [map_free(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    entry = lambda e: F.struct(map_free(e["key"], dtype.keyType).alias("key"), map_free(e["value"], dtype.valueType).alias("value"))
    return F.array_sort(F.transform(F.map_entries(col), entry), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
