"""All columns of a table as typed ``(slot, value)`` rows, in one pass.

Every column belongs to a value *domain* by a lossless, one-to-one encoding
(integers, booleans, dates and timestamps become ``bigint``: the value itself,
epoch days or epoch microseconds; ``float`` widens to ``double``; text stays
text; maps become their sorted entries; other types keep their own domain). A
row is unpivoted into one row per column: its slot, and one value column per
domain, of which only its own can be set. The input, however it was made, runs
once whatever the number of columns and domains; no value is cast to text, so
-0.0/0.0 and NaN are grouped as SQL groups them.

A table wider than :data:`WIDE_COLUMNS` is unpivoted in chunks of columns, each
reading only its own, so that every stage stays within whole-stage code
generation. A columnar scan is read by the chunks as it is; any other wide input
is run once, into a table of the shared folder.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import has_map, map_free, qcol
from tessera.functions.timezone import ntz_from_micros, ntz_micros
from tessera.scratch import Scratch
from tessera.session import column_chunks

_INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
_OWN_DOMAIN = (T.DecimalType, T.BinaryType, T.ArrayType, T.StructType)
SLOT = "slot"
#: Columns unpivoted at a time.
WIDE_COLUMNS = 80


def encode(col: Column, dtype: T.DataType) -> Column:
    """``col`` in its domain: equal encodings <=> equal values."""
    if isinstance(dtype, (*_INTEGRAL, T.BooleanType)):
        return col.cast("bigint")
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("bigint")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_micros(col)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col.cast("double")
    if has_map(dtype):
        return map_free(col, dtype)
    if isinstance(dtype, (T.StringType, *_OWN_DOMAIN)):
        return col
    return col.cast("string")


def decode_text(value: Column, dtype: T.DataType) -> Column:
    """The text of an encoded value, as a cast of the value it stands for."""
    if isinstance(dtype, T.DateType):
        value = F.date_from_unix_date(value.cast("int"))
    elif isinstance(dtype, T.TimestampType):
        value = F.timestamp_micros(value)
    elif isinstance(dtype, T.TimestampNTZType):
        value = ntz_from_micros(value)
    elif isinstance(dtype, T.BooleanType):
        value = value.cast("boolean")
    elif isinstance(dtype, T.FloatType):
        value = value.cast("float")
    return value.cast("string")


def _key(dtype: T.DataType) -> str:
    """Types that differ only in which nested values may be null are one domain."""
    return re.sub(r'"(containsNull|nullable|valueContainsNull)":(true|false)', r'"\1":true', dtype.json())


def texts(home: dict[int, str], types: Sequence[T.DataType]) -> Column:
    """The text of each row's value, whose slot ``i`` is of ``types[i]``: one case
    for each type, however many columns there are."""
    kinds: dict[tuple[str, str], list[int]] = {}
    for i, dtype in enumerate(types):
        kinds.setdefault((home[i], dtype.json()), []).append(i)
    text = F.lit(None).cast("string")
    for (value, _), slots in kinds.items():
        text = F.when(F.col(SLOT).isin(slots), decode_text(F.col(value), types[slots[0]])).otherwise(text)
    return text


def _columnar_scan(df: DataFrame) -> bool:
    """Whether ``df`` is columns of Parquet or ORC files, read as they are."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.child()
    return bool(re.match(r"Relation(V2)?\b.* (parquet|orc)\b", plan.toString().split("\n")[0]))


def typed_rows(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str], dict[int, str]]:
    """``df`` unpivoted: (rows with ``slot`` and the value columns, the names of
    the value columns, the value column of each slot). Slot ``i`` is ``columns[i]``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    encoded = [encode(qcol(c), types[c]) for c in columns]
    plain = df.select(*[e.alias(f"_v{i}") for i, e in enumerate(encoded)])
    if len(columns) > WIDE_COLUMNS and not _columnar_scan(df):
        with Scratch(df.sparkSession) as scratch:
            plain = scratch.keep(plain, "columns")
    names: dict[str, str] = {}
    home = {i: names.setdefault(_key(f.dataType), f"v{len(names)}") for i, f in enumerate(plain.schema.fields)}
    kinds = {home[i]: f.dataType for i, f in enumerate(plain.schema.fields)}
    cells = [
        F.struct(F.lit(i).alias(SLOT), *[(F.col(f"_v{i}") if home[i] == v else F.lit(None).cast(kind)).alias(v) for v, kind in kinds.items()])
        for i in range(len(columns))
    ]
    parts = [plain.select(F.inline(F.array(*chunk))) for chunk in column_chunks(cells, WIDE_COLUMNS)]
    return reduce(DataFrame.unionAll, parts), list(kinds), home


def lookup(values: Sequence) -> Column:
    """The literal at each row's slot."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col(SLOT) + 1)
