"""UTC normalisation of timestamps (SQL ``ts AT TIME ZONE 'UTC'``).

Spark has two timestamp types and the SQL operator maps one onto the other:

* zoned instant (``timestamp``, LTZ)  ->  naive UTC wall time (``timestamp_ntz``)
* naive wall time (``timestamp_ntz``) ->  the instant that wall time denotes in UTC

Both directions are computed through epoch microseconds, so the result does not
depend on ``spark.sql.session.timeZone`` and has no daylight-saving overlap
ambiguity (a cast through the session zone would have one).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import qcol


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())


def ntz_micros(col: Column) -> Column:
    """Microseconds since the epoch of a naive timestamp read as UTC."""
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), col)


def ntz_from_micros(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, _epoch_ntz())


def instant_to_utc_wall(col: Column) -> Column:
    """LTZ instant -> naive UTC wall time (``timestamp_ntz``)."""
    return ntz_from_micros(F.unix_micros(col))


def utc_wall_to_instant(col: Column) -> Column:
    """Naive wall time read as UTC -> LTZ instant (``timestamp``)."""
    return F.timestamp_micros(ntz_micros(col))


def at_time_zone_utc(col: Column, dtype: T.DataType) -> Column:
    """``col AT TIME ZONE 'UTC'``: flips the timestamp type, as in SQL."""
    if isinstance(dtype, T.TimestampType):
        return instant_to_utc_wall(col)
    if isinstance(dtype, T.TimestampNTZType):
        return utc_wall_to_instant(col)
    raise TypeError(f"AT TIME ZONE needs a timestamp column, got {dtype.simpleString()}")


def to_utc_wall(col: Column, dtype: T.DataType) -> Column:
    """Always a naive UTC wall time: instants are converted, naive values are
    taken to be UTC already and kept."""
    if isinstance(dtype, T.TimestampType):
        return instant_to_utc_wall(col)
    if isinstance(dtype, T.TimestampNTZType):
        return col
    raise TypeError(f"UTC normalisation needs a timestamp column, got {dtype.simpleString()}")


def normalize_utc(df: DataFrame, columns: list[str], mode: str = "wall") -> DataFrame:
    """Normalise ``columns`` of ``df`` to UTC, keeping their names and positions.

    ``mode="flip"`` is exactly ``AT TIME ZONE 'UTC'`` (the type flips);
    ``mode="wall"`` yields ``timestamp_ntz`` UTC wall time for both input kinds,
    which is the same instant and a type that reads the same in every session.
    """
    if mode not in ("wall", "flip"):
        raise ValueError("mode must be 'wall' or 'flip'")
    fn = to_utc_wall if mode == "wall" else at_time_zone_utc
    types = {f.name: f.dataType for f in df.schema.fields}
    replaced = {c: fn(qcol(c), types[c]) for c in columns}
    return df.withColumns(replaced)
