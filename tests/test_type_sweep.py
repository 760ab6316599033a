"""Every column-taking operator runs on every column type of the test tables
(one representative column per type), so no text literal or function meets a
type it cannot take under ANSI mode."""

from __future__ import annotations

from pyspark.sql import types as T

from compare import TABLES
from tessera.operators.aggregates import (
    counts_by_period,
    counts_by_periods,
    element_frequency,
    key_cardinality,
    numeric_range,
    population,
    value_frequencies,
    value_frequency,
)
from tessera.operators.dedup import latest_per_key, row_number_per_key
from tessera.operators.quality import output_checks, range_check, reconciliation
from tessera.operators.topk import sort_asc, top_k, top_n_other
from tessera.plans.marts import additions_mart, category_mart, multivalue_mart
from tessera.plans.silver import silver_transform
from tessera.functions.multivalue import unnest
from tessera.functions.timezone import normalize_utc

SF = "/root/testdata/sf0.001"


def _representatives(spark):
    seen = {}
    for t in TABLES:
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        for f in df.schema.fields:
            seen.setdefault(f.dataType.simpleString(), (t, f.name))
    return seen


def _ops(df, c):
    dtype = df.schema[c].dataType
    other = [x for x in df.columns if x != c][:1] or [c]
    ops = {
        "value_frequency": lambda: value_frequency(df, c),
        "value_frequencies": lambda: value_frequencies(df, [c, other[0]], top=3),
        "top_n_other": lambda: top_n_other(df, c, 3),
        "category_mart": lambda: category_mart(df, c, n=3),
        "multivalue_mart": lambda: multivalue_mart(df, c, n=3),
        "element_frequency": lambda: element_frequency(df, c),
        "unnest": lambda: unnest(df, c),
        "population": lambda: population(df, [c]),
        "top_k": lambda: top_k(df, c, 3),
        "sort_asc": lambda: sort_asc(df, c),
        "row_number": lambda: row_number_per_key(df, c, other),
        "latest": lambda: latest_per_key(df, c, other),
        "silver": lambda: silver_transform(df, key=c, order_by=other, name_columns=other, keep=None, utc_columns=()),
        "output_checks": lambda: output_checks(df, c, other),
        "reconciliation": lambda: reconciliation(df, c, other),
        "key_card": lambda: key_cardinality(df, c),
    }
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        ops["counts_by_period"] = lambda: counts_by_period(df, c, "week")
        ops["counts_by_periods"] = lambda: counts_by_periods(df, c)
        ops["additions_mart"] = lambda: additions_mart(df, c, "month")
        if not isinstance(dtype, T.DateType):
            ops["normalize_utc"] = lambda: normalize_utc(df, [c], "flip")
    if isinstance(dtype, T.NumericType):
        ops["numeric_range"] = lambda: numeric_range(df, c, 4)
        ops["range_check"] = lambda: range_check(df, c, 0, 1)
    return ops


def test_operators_accept_every_column_type(spark):
    failures = []
    for type_name, (table, column) in sorted(_representatives(spark).items()):
        df = spark.read.parquet(f"{SF}/{table}.parquet")
        for name, build in _ops(df, column).items():
            try:
                build().write.format("noop").mode("overwrite").save()
            except Exception as exc:  # collect them all, report at once
                failures.append(f"{table}.{column} ({type_name}) {name}: {str(exc).splitlines()[0][:120]}")
    assert not failures, "\n".join(failures)
