"""Schema description: ``DESCRIBE`` as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# SQL type names in the form the profile report uses for them.
_SQL_NAMES: list[tuple[type, str]] = [
    (T.StringType, "VARCHAR"),
    (T.LongType, "BIGINT"),
    (T.IntegerType, "INTEGER"),
    (T.ShortType, "SMALLINT"),
    (T.ByteType, "TINYINT"),
    (T.DoubleType, "DOUBLE"),
    (T.FloatType, "FLOAT"),
    (T.BooleanType, "BOOLEAN"),
    (T.DateType, "DATE"),
    (T.TimestampNTZType, "TIMESTAMP"),
    (T.TimestampType, "TIMESTAMP WITH TIME ZONE"),
    (T.BinaryType, "BLOB"),
]


def sql_type_name(dtype: T.DataType) -> str:
    """SQL name of a Spark type (``bigint`` -> ``BIGINT``, ``array<float>`` -> ``FLOAT[]``)."""
    if isinstance(dtype, T.ArrayType):
        return sql_type_name(dtype.elementType) + "[]"
    if isinstance(dtype, T.DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    for cls, name in _SQL_NAMES:
        if isinstance(dtype, cls):
            return name
    return dtype.simpleString().upper()


DESCRIBE_SCHEMA = T.StructType(
    [
        T.StructField("position", T.IntegerType(), False),
        T.StructField("column", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("spark_type", T.StringType(), False),
        T.StructField("nullable", T.BooleanType(), False),
    ]
)


def describe(df: DataFrame) -> DataFrame:
    """One row per column: position, name, SQL type, Spark type, nullability.

    Built from the schema the driver already holds (no scan of the data).
    """
    rows = [
        (i, f.name, sql_type_name(f.dataType), f.dataType.simpleString(), bool(f.nullable))
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(rows, DESCRIBE_SCHEMA)
