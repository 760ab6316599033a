"""Column profile, describe and the JSON report."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import types as T

from tessera.operators.profile import column_stats, profile
from tessera.plans.profile_job import profile_dataset, save_profile
from tessera.sources.schema import describe, sql_type_name


def _records(df):
    return [r.asDict() for r in df.collect()]


def test_profile_values_in_column_order(spark):
    rows = [("a", 1, 0.5), ("b", None, 0.5), (None, None, 1.5), ("a", 3, None)]
    df = spark.createDataFrame(rows, "s string, i long, d double")
    out = _records(profile(df))
    assert out == [
        {"column": "s", "type": "VARCHAR", "null_rate": 0.25, "distinct_values": 2},
        {"column": "i", "type": "BIGINT", "null_rate": 0.5, "distinct_values": 2},
        {"column": "d", "type": "DOUBLE", "null_rate": 0.25, "distinct_values": 2},
    ]


def test_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "a string, b double")
    out = _records(profile(df))
    assert out == [
        {"column": "a", "type": "VARCHAR", "null_rate": None, "distinct_values": 0},
        {"column": "b", "type": "DOUBLE", "null_rate": None, "distinct_values": 0},
    ]


def test_all_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "a string")
    assert _records(profile(df)) == [{"column": "a", "type": "VARCHAR", "null_rate": 1.0, "distinct_values": 0}]


def test_signed_zero_and_nan_count_once(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "d double")
    assert _records(column_stats(df))[0]["distinct_values"] == 2


def test_subset_and_types(spark):
    df = spark.createDataFrame(
        [(1, "x", dt.date(2026, 1, 1), dt.datetime(2026, 1, 1), True, [1.0, 2.0])],
        "a int, b string, c date, d timestamp_ntz, e boolean, f array<float>",
    )
    types = {r["column"]: r["type"] for r in _records(profile(df))}
    assert types == {"a": "INTEGER", "b": "VARCHAR", "c": "DATE", "d": "TIMESTAMP", "e": "BOOLEAN", "f": "FLOAT[]"}
    assert [r["column"] for r in _records(profile(df, columns=["d", "a"]))] == ["d", "a"]


def test_approx_distinct_close(spark):
    df = spark.range(0, 20000).selectExpr("id % 1000 AS k")
    approx = _records(profile(df, approx=True, rsd=0.02))[0]["distinct_values"]
    assert abs(approx - 1000) <= 60


def test_sampled_profile_has_every_column(spark):
    df = spark.range(0, 5000).selectExpr("id", "id % 7 AS m")
    out = _records(profile(df, sample_fraction=0.2, seed=1))
    assert [r["column"] for r in out] == ["id", "m"]
    assert out[1]["distinct_values"] == 7


def test_describe(spark):
    df = spark.createDataFrame([], "code string, n bigint, t timestamp, x decimal(10,2)")
    rows = [(r.column, r.type, r.spark_type) for r in describe(df).orderBy("position").collect()]
    assert rows == [
        ("code", "VARCHAR", "string"),
        ("n", "BIGINT", "bigint"),
        ("t", "TIMESTAMP WITH TIME ZONE", "timestamp"),
        ("x", "DECIMAL(10,2)", "decimal(10,2)"),
    ]
    assert sql_type_name(T.ArrayType(T.StringType())) == "VARCHAR[]"


def _report_files(out):
    return [os.path.join(out, f) for f in sorted(os.listdir(out)) if not f.startswith((".", "_"))]


_EXPECTED_REPORT = [
    {"column": "code", "type": "VARCHAR", "null_rate": 0.0, "distinct_values": 2},
    {"column": "name", "type": "VARCHAR", "null_rate": 0.3333, "distinct_values": 2},
    {"column": "score", "type": "DOUBLE", "null_rate": 0.3333, "distinct_values": 2},
]


def test_profile_job_on_tsv_and_report(spark, workdir):
    src = os.path.join(workdir, "p.tsv")
    with open(src, "w") as fh:
        fh.write("code\tname\tscore\n0001\tA\t0.5\n0002\t\t0.8\n0002\tB\t\n")
    prof = profile_dataset(spark, src)

    # default: one file holding one JSON array, records in column order
    out = save_profile(prof, os.path.join(workdir, "report"))
    files = [f for f in _report_files(out) if os.path.getsize(f) > 0]
    assert len(files) == 1
    with open(files[0]) as fh:
        assert json.load(fh) == _EXPECTED_REPORT
    back = spark.read.option("multiLine", True).json(out)
    assert sorted(back.columns) == ["column", "distinct_values", "null_rate", "type"]
    assert back.count() == 3

    # JSON lines
    out = save_profile(prof, os.path.join(workdir, "report-lines"), layout="lines")
    lines = []
    for f in _report_files(out):
        with open(f) as fh:
            lines += [json.loads(x) for x in fh if x.strip()]
    assert lines == _EXPECTED_REPORT


def test_report_of_empty_table_keeps_null_rates(spark, workdir):
    empty = spark.createDataFrame([], "a string, b double")
    out = save_profile(profile(empty), os.path.join(workdir, "empty-report"))
    files = [f for f in _report_files(out) if os.path.getsize(f) > 0]
    with open(files[0]) as fh:
        assert json.load(fh) == [
            {"column": "a", "type": "VARCHAR", "null_rate": None, "distinct_values": 0},
            {"column": "b", "type": "DOUBLE", "null_rate": None, "distinct_values": 0},
        ]


def test_profile_is_one_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = profile(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1  # whatever the columns' domains
    assert "Generate inline" in plan  # the unpivot


def test_every_domain_counts_like_python(spark):
    """Distinct and NULL counts over the encodings of every column type."""
    from decimal import Decimal

    schema = T.StructType(
        [
            T.StructField("b", T.BooleanType()),
            T.StructField("s", T.ShortType()),
            T.StructField("i", T.IntegerType()),
            T.StructField("f", T.FloatType()),
            T.StructField("d", T.DateType()),
            T.StructField("ts", T.TimestampType()),
            T.StructField("ntz", T.TimestampNTZType()),
            T.StructField("dec", T.DecimalType(10, 2)),
            T.StructField("bin", T.BinaryType()),
            T.StructField("arr", T.ArrayType(T.FloatType())),
            T.StructField("m", T.MapType(T.StringType(), T.LongType())),
            T.StructField("st", T.StructType([T.StructField("k", T.MapType(T.StringType(), T.LongType()))])),
        ]
    )
    t0 = dt.datetime(2026, 1, 1, 10, 0, 0)
    rows = [
        (True, 1, 1, 0.0, dt.date(2026, 1, 1), t0, t0, Decimal("1.50"), b"a", [1.0, 2.0], {"a": 1}, ({"a": 1},)),
        (False, 1, 2, -0.0, dt.date(2026, 1, 2), t0, t0, Decimal("1.5"), b"a", [1.0, 2.0], {"a": 1}, ({"a": 1},)),
        (True, 2, 1, float("nan"), dt.date(2026, 1, 1), t0 + dt.timedelta(microseconds=1), t0,
         Decimal("2.00"), b"b", [2.0, 1.0], {"b": 1}, ({"b": 2},)),
        (None, None, None, None, None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r["column"]: (r["null_rate"], r["distinct_values"]) for r in profile(df).collect()}
    expected_distinct = {"b": 2, "s": 2, "i": 2, "f": 2, "d": 2, "ts": 2, "ntz": 1, "dec": 2, "bin": 2,
                         "arr": 2, "m": 2, "st": 2}
    for name, n in expected_distinct.items():
        assert got[name] == (0.25, n), name


def test_profile_command_writes_report_and_removes_staged_text(spark, workdir):
    from tessera.__main__ import main
    from tessera.session import checkpoint_dir

    src = os.path.join(workdir, "cli.tsv")
    with open(src, "w") as fh:
        fh.write("code\tname\tscore\n0001\tA\t0.5\n0002\t\t0.8\n0002\tB\t\n")
    staged_root = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "tessera")
    before = {d for d in os.listdir(staged_root) if d.startswith("staged-text-")} if os.path.isdir(staged_root) else set()
    out = os.path.join(workdir, "cli-report")
    main(["profile", src, "--out", out, "--layout", "array"])
    files = [f for f in _report_files(out) if os.path.getsize(f) > 0]
    with open(files[0]) as fh:
        assert json.load(fh) == _EXPECTED_REPORT
    after = {d for d in os.listdir(staged_root) if d.startswith("staged-text-")}
    assert after == before


def test_profile_of_every_driver_table_matches_sql(spark):
    """Exact profile of each test table (text, arrays, timestamps, ...) against
    one DuckDB query per column."""
    from compare import TABLES, compare, duckdb_connection

    from tessera.queries import _profile_sql

    sf = "/root/testdata/sf0.001"
    con = duckdb_connection(sf)
    for name in TABLES:
        df = spark.read.parquet(f"{sf}/{name}.parquet")
        assert compare(profile(df), con, _profile_sql(name, tuple(df.columns))) is None, name


def test_profile_records_round_like_python(spark, workdir):
    from tessera.operators.profile import profile_records

    # 20,000 rows with 3 NULLs: 1 - 19997/20000 sits at a decimal tie
    df = spark.range(0, 20000).selectExpr("CASE WHEN id < 3 THEN NULL ELSE id END AS v", "id % 7 AS w")
    records = profile_records(df)
    assert records[0] == {"column": "v", "type": "BIGINT", "null_rate": round(1 - 19997 / 20000, 4),
                          "distinct_values": 19997}
    assert records[1] == {"column": "w", "type": "BIGINT", "null_rate": 0.0, "distinct_values": 7}
    empty = profile_records(spark.createDataFrame([], "a string"))
    assert empty == [{"column": "a", "type": "VARCHAR", "null_rate": None, "distinct_values": 0}]

    out = save_profile(records, os.path.join(workdir, "reports", "profile_report.json"))
    with open(out) as fh:
        text = fh.read()
    assert json.loads(text) == records and text.startswith("[\n  {")


def test_profile_dataset_as_records(spark, workdir):
    src = os.path.join(workdir, "r.tsv")
    with open(src, "w") as fh:
        fh.write("code\tname\tscore\n0001\tA\t0.5\n0002\t\t0.8\n0002\tB\t\n")
    assert profile_dataset(spark, src, as_records=True) == _EXPECTED_REPORT


def test_wide_table_and_its_inference(spark):
    """250 columns in one profile pass; inference splits its unpivot."""
    from pyspark.sql import functions as F

    from tessera.sources.inference import infer_types

    base = spark.range(0, 50).select(F.col("id"), (F.col("id") % 7).cast("string").alias("s"))
    wide = base.select(*[(F.col("id") + i).alias(f"n{i}") for i in range(125)],
                       *[F.concat(F.col("s"), F.lit(f"-{i}")).alias(f"t{i}") for i in range(125)])
    rows = profile(wide).collect()
    assert [r["column"] for r in rows] == wide.columns
    assert all(r["distinct_values"] == 50 for r in rows[:125]) and all(r["distinct_values"] == 7 for r in rows[125:])
    text = wide.select(*[F.col(c).cast("string").alias(c) for c in wide.columns])
    types = infer_types(text)
    assert all(types[f"n{i}"] == "bigint" for i in range(125)) and all(types[f"t{i}"] == "string" for i in range(125))


def test_wide_frequencies_are_counted_in_chunks(spark, workdir):
    """More columns than one unpivot takes: a Parquet scan is read by each chunk,
    any other input is run once; the counts are those of each column alone."""
    from pyspark.sql import functions as F

    from tessera.operators.aggregates import value_frequencies
    from tessera.operators.unpivot import typed_rows

    made = spark.range(60).select(*[((F.col("id") % (i + 2)) if i % 2 else F.concat(F.lit("t"), F.col("id") % (i + 2))).alias(f"c{i}") for i in range(90)])
    made.write.parquet(f"{workdir}/wide")
    stored = spark.read.parquet(f"{workdir}/wide")
    for df in (stored, made.distinct()):
        plan = typed_rows(df, df.columns)[0]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 2 and "Aggregate" not in plan
        rows = value_frequencies(df, df.columns).collect()
        for i in (0, 1, 79, 80, 89):
            got = {r["value"]: r["cnt"] for r in rows if r["column"] == f"c{i}"}
            source = df.groupBy(F.col(f"c{i}").cast("string").alias("v")).count().collect()
            assert got == {r["v"]: r["count"] for r in source}


def test_profile_counts_match_brute_force(spark):
    import math

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    row = st.tuples(
        st.one_of(st.none(), st.integers(min_value=-3, max_value=3)),
        st.one_of(st.none(), st.sampled_from([0.0, -0.0, 1.5, float("nan"), -2.25])),
        st.one_of(st.none(), st.sampled_from(["", "a", "A", "a ", "é"])),
    )

    def key(v):  # SQL grouping: NaN is one value, -0.0 equals 0.0
        if isinstance(v, float):
            return "nan" if math.isnan(v) else v + 0.0
        return v

    @settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(row, min_size=0, max_size=40))
    def check(rows):
        df = spark.createDataFrame(rows, "i int, d double, s string")
        got = {r["column"]: (r["total_rows"], r["non_null_rows"], r["distinct_values"])
               for r in column_stats(df).collect()}
        for pos, name in enumerate(["i", "d", "s"]):
            present = [x[pos] for x in rows if x[pos] is not None]
            assert got[name] == (len(rows), len(present), len({key(v) for v in present})), name

    check()


def test_profiled_join_runs_once(spark):
    """Whatever the columns' domains and number, the input is in the plan once,
    and the final aggregation isn't merged into one task."""
    left = spark.range(50).selectExpr("id AS k", "id * 0.5D AS d", "cast(id AS string) AS s", "current_date() AS day")
    wide = left.select("*", *[left["s"].alias(f"t{i}") for i in range(70)])
    right = spark.range(50).selectExpr("id AS k", "array(id) AS a")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = wide.join(right, "k")
        plan = profile(joined)._jdf.queryExecution().executedPlan().toString()
        rows = {r["column"]: r["distinct_values"] for r in profile(joined).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1
    assert "Coalesce 1" not in plan
    assert rows["k"] == rows["d"] == rows["s"] == rows["a"] == rows["t69"] == 50 and rows["day"] == 1


def test_maps_are_compared_by_their_entries(spark):
    """Microseconds count, the order of the entries doesn't; also inside arrays."""
    stamps = [f"map('x', timestamp_micros({i}), 'y', timestamp_micros(0))" for i in range(5)]
    same = "map('y', timestamp_micros(0), 'x', timestamp_micros(3))"
    df = spark.sql(" UNION ALL ".join(f"SELECT {m} AS m, array({m}) AS a, named_struct('f', {m}) AS s" for m in [*stamps, same]) + " UNION ALL SELECT null, null, null")
    assert {r["column"]: (r["distinct_values"], r["null_rate"]) for r in profile(df).collect()} == {c: (5, round(1 / 7, 4)) for c in "mas"}


def test_columns_by_name_in_any_case(spark):
    import pytest

    df = spark.createDataFrame([(1, 2)], "Code int, a int")
    assert [r["column"] for r in profile(df, ["code", "A"]).collect()] == ["Code", "a"]
    with pytest.raises(ValueError, match="no such column"):
        profile(df, ["none"])


def test_sample_of_more_rows_than_the_table_is_the_full_profile(spark, workdir):
    path = os.path.join(workdir, "p.parquet")
    spark.range(300).selectExpr("id", "id % 7 AS w", "nullif(id % 3, 0) AS n").write.parquet(path)
    full = profile(spark.read.parquet(path)).collect()
    assert profile_dataset(spark, path, fmt="parquet", sample_rows=300).collect() == full
    assert profile_dataset(spark, path, fmt="parquet", sample_rows=10**6).collect() == full
    part = {r["column"]: r for r in profile_dataset(spark, path, fmt="parquet", sample_rows=60).collect()}
    assert 10 < part["id"]["distinct_values"] < 150 and part["w"]["distinct_values"] <= 7
