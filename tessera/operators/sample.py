"""A sample of exactly n rows, the same for the same keys and seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import fresh_names, has_map, map_free, qcol, resolve

#: Bits of a row's priority, and those that one histogram tells apart.
BITS = 60
STEP = 12


def priority(columns: Sequence[Column], seed: int) -> Column:
    """60 bits of the MD5 of ``{seed}|{key}|...``, the first hexadecimal digits
    as a number; a NULL key is the text ``NULL``."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("NULL")) for c in columns])
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def _cut(priorities: DataFrame, name: str, n: int) -> tuple[int, int]:
    """(the n-th smallest priority, how many are below it). Each round counts
    the rows by the next bits of those that may still be it: at most 4096 counts
    come to the driver, never rows."""
    prefix, below, shift = 0, 0, BITS
    while shift:
        shift -= STEP
        inside = priorities.where(F.shiftright(name, shift + STEP) == prefix)
        counts = {r[0]: r[1] for r in inside.groupBy(F.shiftright(name, shift).alias("b")).agg(F.count("*")).collect()}
        for bucket in sorted(counts):
            if below + counts[bucket] >= n:
                prefix = bucket
                break
            below += counts[bucket]
    return prefix, below


def sample_rows(df: DataFrame, n: int, keys: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows of ``df``: those of the smallest
    :func:`priority` of ``keys`` (default: all columns), which any engine that
    has MD5 draws alike if the keys are unique.

    The n-th smallest priority is found by histograms, then one filter takes the
    rows; no task gathers or sorts them, and ``df`` runs once a histogram (five)
    and once for the result, so an expensive input should be a table. Of rows
    with the very same priority as the last one as many are taken as are
    missing, the first by all their columns.
    """
    if n <= 0:
        return df.where("false")
    names = [resolve(df, c) for c in (keys if keys is not None else df.columns)]
    types = {f.name: f.dataType for f in df.schema.fields}
    column = lambda c: F.to_json(F.struct(map_free(qcol(c), types[c]))) if has_map(types[c]) or types[c].typeName() in ("array", "struct") else qcol(c)
    name, many, upto = fresh_names(df, 3)
    ranked = df.withColumn(name, priority([column(c) for c in names], seed))
    if df.count() <= n:
        return df
    last, below = _cut(ranked.select(name), name, n)
    inside = ranked.where(F.col(name) < last).drop(name)
    ties = ranked.where(F.col(name) == last).drop(name)
    # equal rows once with their number, then as many of them as there is room for
    whole = F.struct(*[map_free(qcol(c), types[c]).alias(f"c{i}") for i, c in enumerate(df.columns)])
    first = ties.groupBy(whole.alias(name)).agg(F.count("*").alias(many), F.first(F.struct(*[qcol(c) for c in df.columns])).alias("row"))
    taken = first.orderBy(name).limit(n - below).select("row", many, name)
    rows = taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.col(many), F.lit(n - below).cast("long")))).alias(upto), name)
    rows = rows.orderBy(name, upto).limit(n - below).select("row.*")
    return inside.unionByName(rows)
