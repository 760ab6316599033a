"""Silver job: curation rules, latest row per key, UTC."""

from __future__ import annotations

import datetime as dt
import os
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.timezone import at_time_zone_utc, normalize_utc
from tessera.operators.dedup import latest_per_key, row_number_per_key
from tessera.plans.silver import silver_layer, silver_transform

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("generic_name", T.StringType()),
        T.StructField("created_datetime", T.TimestampNTZType()),
        T.StructField("last_modified_datetime", T.TimestampNTZType()),
        T.StructField("countries_tags", T.StringType()),
        T.StructField("brands", T.StringType()),
        T.StructField("categories_tags", T.StringType()),
        T.StructField("categories", T.StringType()),
        T.StructField("main_category", T.StringType()),
        T.StructField("completeness", T.DoubleType()),
        T.StructField("quantity", T.StringType()),
        T.StructField("product_quantity", T.DoubleType()),
    ]
)

D = dt.datetime
ROWS = [
    ("0001", "Product A", None, D(2026, 1, 1), D(2026, 1, 2), "en:france", "BrandA", "en:dog-food", "Dog food", "dog-food", 0.8, "1kg", 1.0),
    ("0001", "Product A (older)", None, D(2026, 1, 1), D(2025, 12, 1), "en:france", "BrandA", "en:dog-food", "Dog food", "dog-food", 0.5, "1kg", 1.0),
    ("0002", None, None, D(2026, 1, 1), D(2026, 1, 1), "en:germany", "BrandB", "en:cat-food", "Cat food", "cat-food", 0.6, "500g", 0.5),
    (None, "No Code Product", None, D(2026, 1, 1), D(2026, 1, 1), "en:spain", "BrandC", "en:cat-food", "Cat food", "cat-food", 0.7, "2kg", 2.0),
]


@pytest.fixture()
def bronze_path(spark, workdir):
    path = os.path.join(workdir, "test_bronze.parquet")
    spark.createDataFrame(ROWS, BRONZE_SCHEMA).write.mode("overwrite").parquet(path)
    return path


def _silver(spark, bronze_path, workdir):
    return silver_layer(spark, bronze_path, os.path.join(workdir, "test_silver"), run_date=date(2026, 7, 1))


def test_path_layout(spark, bronze_path, workdir):
    dest = _silver(spark, bronze_path, workdir)
    assert dest == os.path.join(workdir, "test_silver", "2026-07-01", "products.parquet")
    dest2 = silver_layer(spark, bronze_path, os.path.join(workdir, "test_silver") + "/", run_date=date(2026, 7, 1))
    assert dest2 == dest


def test_drops_null_code_rows(spark, bronze_path, workdir):
    codes = [r.code for r in spark.read.parquet(_silver(spark, bronze_path, workdir)).collect()]
    assert None not in codes


def test_drops_rows_with_no_usable_name(spark, bronze_path, workdir):
    out = spark.read.parquet(_silver(spark, bronze_path, workdir))
    assert out.where(F.col("code") == "0002").count() == 0


def test_keeps_most_recent(spark, bronze_path, workdir):
    out = spark.read.parquet(_silver(spark, bronze_path, workdir))
    rows = [tuple(r) for r in out.where(F.col("code") == "0001").select("code", "product_name", "completeness").collect()]
    assert rows == [("0001", "Product A", 0.8)]


def test_output_row_count_and_columns(spark, bronze_path, workdir):
    out = spark.read.parquet(_silver(spark, bronze_path, workdir))
    assert out.count() == 1
    assert out.columns == [f.name for f in BRONZE_SCHEMA.fields]


def test_newer_nameless_row_does_not_hide_older_good_row(spark):
    rows = [
        ("0003", "Good", None, D(2026, 1, 1), D(2026, 1, 1)),
        ("0003", None, None, D(2026, 1, 1), D(2026, 6, 1)),
    ]
    df = spark.createDataFrame(rows, "code string, product_name string, generic_name string, "
                                     "created_datetime timestamp_ntz, last_modified_datetime timestamp_ntz")
    out = silver_transform(df, keep=None).collect()
    assert [(r.code, r.product_name) for r in out] == [("0003", "Good")]


def test_generic_name_alone_is_enough(spark):
    rows = [("0004", None, "kibble", D(2026, 1, 1), D(2026, 1, 1))]
    df = spark.createDataFrame(rows, "code string, product_name string, generic_name string, "
                                     "created_datetime timestamp_ntz, last_modified_datetime timestamp_ntz")
    assert silver_transform(df, keep=None).count() == 1


def test_ties_and_null_order_values(spark):
    rows = [
        ("k", D(2026, 1, 1), 1),
        ("k", D(2026, 1, 1), 3),
        ("k", None, 9),
        ("j", None, 1),
        ("j", None, 2),
    ]
    df = spark.createDataFrame(rows, "code string, last_modified_datetime timestamp_ntz, id long")
    latest = {r.code: r.id for r in latest_per_key(df, "code", ("last_modified_datetime", "id")).collect()}
    # NULL timestamps lose to any real one; equal timestamps go to the higher id
    assert latest == {"k": 3, "j": 2}
    ranked = row_number_per_key(df, "code", ("last_modified_datetime", "id"))
    assert ranked.schema["rn"].dataType == T.LongType()
    assert sorted((r.code, r.id, r.rn) for r in ranked.collect()) == [
        ("j", 1, 2), ("j", 2, 1), ("k", 1, 2), ("k", 3, 1), ("k", 9, 3)
    ]


def test_utc_both_directions_and_dst_overlap(spark):
    # 2025-11-02 06:30Z is 01:30 in New York during the repeated hour.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        instant = dt.datetime(2025, 11, 2, 6, 30, tzinfo=dt.timezone.utc)
        df = spark.createDataFrame([(instant, dt.datetime(2025, 11, 2, 6, 30))], "z timestamp, n timestamp_ntz")
        out = df.select(
            at_time_zone_utc(F.col("z"), T.TimestampType()).alias("z_utc"),
            F.unix_micros(at_time_zone_utc(F.col("n"), T.TimestampNTZType())).alias("n_us"),
        )
        assert out.schema["z_utc"].dataType == T.TimestampNTZType()
        row = out.collect()[0]
        assert row.z_utc == dt.datetime(2025, 11, 2, 6, 30)
        assert row.n_us == int(instant.timestamp() * 1_000_000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_zoned_bronze_is_normalised_to_utc_wall_time(spark):
    rows = [("0001", "A", None, dt.datetime(2026, 1, 1, 12, 0, tzinfo=dt.timezone(dt.timedelta(hours=8))),
             dt.datetime(2026, 1, 2, tzinfo=dt.timezone.utc))]
    df = spark.createDataFrame(rows, "code string, product_name string, generic_name string, "
                                     "created_datetime timestamp, last_modified_datetime timestamp")
    out = silver_transform(df, keep=None)
    assert out.schema["created_datetime"].dataType == T.TimestampNTZType()
    assert out.collect()[0].created_datetime == dt.datetime(2026, 1, 1, 4, 0)
    flipped = normalize_utc(df, ["created_datetime"], mode="flip")
    assert flipped.schema["created_datetime"].dataType == T.TimestampNTZType()
    naive = spark.createDataFrame([(dt.datetime(2026, 1, 1),)], "t timestamp_ntz")
    assert normalize_utc(naive, ["t"], mode="flip").schema["t"].dataType == T.TimestampType()
    assert normalize_utc(naive, ["t"], mode="wall").schema["t"].dataType == T.TimestampNTZType()


def test_plan_prunes_pushes_and_limits_before_shuffle(spark, bronze_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    df = silver_transform(spark.read.parquet(bronze_path), keep=("code", "completeness"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "WindowGroupLimit" in plan
    assert "IsNotNull(code)" in plan
    # only the needed columns are read
    assert "ReadSchema: struct<code:string,product_name:string,generic_name:string," \
           "last_modified_datetime:timestamp_ntz,completeness:double>" in plan


def test_row_number_in_pieces_equals_plain_window(spark):
    # one hot key holding most rows, many ties on the order column, a NULL key
    rows = [("hot", i % 7, i) for i in range(3000)] + [("cold", i % 3, i) for i in range(50)] + \
           [(None, 1, i) for i in range(40)] + [("x", None, 1), ("x", None, 2), ("x", 5, 3)]
    df = spark.createDataFrame(rows, "k string, t int, id long")
    plain = row_number_per_key(df, "k", ("t", "id"), strategy="window")
    pieces = row_number_per_key(df, "k", ("t", "id"), strategy="pieces", pieces=30)
    def canon(d):
        return sorted((repr(tuple(r)) for r in d.collect()))

    assert canon(pieces) == canon(plain)
    # with ties left unbroken the numbering is still a permutation 1..n per key
    loose = row_number_per_key(df, "k", "t", strategy="pieces", pieces=30)
    per_key = {}
    for r in loose.collect():
        per_key.setdefault(r.k, []).append(r.rn)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in per_key.values())
    # and a row with a smaller t never gets a smaller number (descending order)
    hot = sorted((r.rn, r.t) for r in loose.collect() if r.k == "hot")  # noqa: C414
    assert all(a[1] >= b[1] for a, b in zip(hot, hot[1:]))


def test_both_strategies_number_ties_alike(spark):
    rows = [("hot", i % 7, i % 5) for i in range(900)] + [(None, 1, 0)] * 30 + [("same", 2, 2)] * 200
    df = spark.createDataFrame(rows, "k string, t int, v int")
    # ties are decided by the row, rows that are the same are interchangeable
    window = sorted(repr(tuple(r)) for r in row_number_per_key(df, "k", "t").collect())
    pieces = sorted(repr(tuple(r)) for r in row_number_per_key(df, "k", "t", strategy="pieces", pieces=25).collect())
    assert window == pieces


@pytest.mark.parametrize("strategy", ["window", "pieces"])
def test_numbering_keeps_every_column(spark, strategy):
    names = ["_h", "_piece", "_local", "_k0", "_p", "_offset", "_helper0", "_HELPER1", "slot"]
    rows = [(i % 3, i, {"a": i, "b": 2}, [{"x": i}], *[f"{n}{i}" for n in names]) for i in range(200)]
    schema = "k int, id long, m map<string,int>, n array<map<string,int>>, " + ", ".join(f"`{n}` string" for n in names)
    df = spark.createDataFrame(rows, schema)
    got = row_number_per_key(df, "k", "id", descending=False, strategy=strategy, **({"pieces": 12} if strategy == "pieces" else {}))
    assert got.columns == [*df.columns, "rn"]
    assert sorted(tuple(r) for r in got.select("id", "rn").collect()) == [(i, i // 3 + 1) for i in range(200)]
    by_id = {r["id"]: tuple(r) for r in df.collect()}
    assert all(tuple(r)[:-1] == by_id[r["id"]] for r in got.collect())


def test_pieces_bound_the_rows_of_a_task(spark):
    df = spark.range(4000).selectExpr("0 AS k", "id % 2 AS t", "'same' AS v")  # one key, two different rows
    numbered = row_number_per_key(df, "k", "t", strategy="pieces", pieces=40)
    assert sorted(r["rn"] for r in numbered.collect()) == list(range(1, 4001))
    read = [p for p in numbered.inputFiles() if "pieces-" in p]
    sizes = [r["n"] for r in spark.read.parquet(*read).groupBy("_helper2").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 20 and max(sizes) < 400


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="strategy"):
        row_number_per_key(spark.range(1), "id", "id", strategy="auto")


def test_silver_matches_brute_force(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    row = st.tuples(
        st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
        st.one_of(st.none(), st.sampled_from(["n1", "n2"])),
        st.one_of(st.none(), st.sampled_from(["g1"])),
        st.one_of(st.none(), st.integers(min_value=0, max_value=4)),
    )

    @settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(row, min_size=0, max_size=30))
    def check(rows):
        data = [(c, n, g, None if t is None else D(2026, 1, 1 + t), i) for i, (c, n, g, t) in enumerate(rows)]
        df = spark.createDataFrame(data, "code string, product_name string, generic_name string, "
                                         "last_modified_datetime timestamp_ntz, id long")
        got = silver_transform(df, order_by=("last_modified_datetime", "id"), keep=("code", "id"), utc_columns=())
        best = {}
        for c, n, g, t, i in data:
            if c is None or (n is None and g is None):
                continue
            rank = (t is not None, t or D(1970, 1, 1), i)  # newest first, NULL last, id breaks ties
            if c not in best or rank > best[c][0]:
                best[c] = (rank, i)
        assert sorted((r.code, r.id) for r in got.collect()) == sorted((c, v[1]) for c, v in best.items())

    check()


def test_row_numbers_match_brute_force_on_every_path(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    row = st.tuples(st.one_of(st.none(), st.sampled_from(["h", "x", "y"])), st.one_of(st.none(), st.integers(0, 3)))

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(row, min_size=0, max_size=60), st.sampled_from([None, 1, 9]))
    def check(rows, pieces):
        data = [(k, t, i) for i, (k, t) in enumerate(rows)]
        df = spark.createDataFrame(data, "k string, t int, id long")
        got = {r.id: r.rn for r in row_number_per_key(df, "k", ("t", "id"), strategy="pieces" if pieces else "window", pieces=pieces).collect()}
        expected = {}
        for k in {r[0] for r in data}:
            group = [r for r in data if r[0] == k]
            # descending, NULL order values last
            group.sort(key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0, r[2]), reverse=True)
            expected.update({r[2]: n + 1 for n, r in enumerate(group)})
        assert got == expected

    check()


def test_utc_conversions_match_python(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    micros = st.integers(min_value=-2_000_000_000_000_000, max_value=4_000_000_000_000_000)
    epoch = dt.datetime(1970, 1, 1)

    @settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(micros, min_size=1, max_size=20))
    def check(values):
        previous = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # a zone with DST
        try:
            df = spark.createDataFrame([(m,) for m in values], "us long").select(
                "us", F.timestamp_micros("us").alias("instant")
            )
            wall = at_time_zone_utc(F.col("instant"), T.TimestampType())
            back = at_time_zone_utc(wall, T.TimestampNTZType())
            rows = df.select("us", wall.alias("wall"), F.unix_micros(back).alias("back")).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", previous)
        for r in rows:
            assert r.wall == epoch + dt.timedelta(microseconds=r.us)  # naive UTC wall time
            assert r.back == r.us  # and back to the same instant

    check()
