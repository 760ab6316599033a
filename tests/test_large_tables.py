"""Exact samples, mergeable profiles, heavy hitters, footers, refreshed partitions, views."""

from __future__ import annotations

import glob
import hashlib
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators.heavy_hitters import heavy_hitters
from tessera.operators.mergeable import ERROR, merged_profile, profile_state
from tessera.operators.profile import column_stats, profile
from tessera.operators.sample import sample_rows
from tessera.operators.topk import top_n_other
from tessera.sources import footers, warehouse
from tessera.sources.footers import footer_stats
from tessera.sources.warehouse import load_view, refresh_partitions, write_partitioned


def drawn(keys, n, seed):
    return sorted(keys, key=lambda k: hashlib.md5(f"{seed}|{k}".encode()).hexdigest()[:15])[:n]


@pytest.mark.parametrize("n", [0, 1, 7, 99, 100, 500])
def test_sample_has_the_rows_of_the_smallest_digests(spark, n):
    df = spark.range(100).repartition(5)
    assert sorted(r.id for r in sample_rows(df, n, ["id"], seed=3).collect()) == sorted(drawn(range(100), n, 3))


def test_sample_of_repeated_rows_is_exact_at_the_cut(spark):
    rows = [(1, "a", {"k": 1}, [None])] * 40 + [(2, None, None, None)] * 30 + [(3, "b", {"x": 2, "y": 3}, [1])] * 5
    df = spark.createDataFrame(rows, "i int, `odd name` string, m map<string,int>, l array<int>").repartition(4)
    for n in (1, 39, 44, 71, 74):
        for keys in (None, ["i"]):
            got = sample_rows(df, n, keys).collect()
            assert len(got) == n and {str(r) for r in got} <= {str(r) for r in df.collect()}
    whole = Counter(r.i for r in sample_rows(df, 74).collect())
    assert sum((Counter({1: 40, 2: 30, 3: 5}) - whole).values()) == 1


def test_sample_gathers_no_rows_in_one_task(spark):
    df = spark.range(0, 1000, 1, 8)
    plan = sample_rows(df, 600, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in plan and sample_rows(df, 600, ["id"]).rdd.getNumPartitions() > 8 - 1


def test_profile_of_a_sample_as_large_as_the_table_is_the_profile(spark):
    df = spark.range(50).withColumn("v", F.col("id") % 7)
    assert profile(df, sample_rows=50).collect() == profile(df).collect()
    assert {r["distinct_values"] for r in profile(df, columns=["id"], sample_rows=20).collect()} == {20}


def test_merged_profiles_count_exactly_and_estimate_within_the_error(spark):
    parts = [spark.range(0, 6000), spark.range(4000, 9000), spark.range(0)]
    parts = [p.select(F.col("id").cast("int" if i else "long").alias("id"), F.nullif(F.col("id") % 10, F.lit(3)).alias("v"), F.concat(F.lit("t"), F.col("id") % 500).alias("t")) for i, p in enumerate(parts)]
    states = [profile_state(p) for p in parts]
    merged = {r["column"]: r for r in merged_profile(states[0].unionByName(states[1]).unionByName(states[2])).collect()}
    assert [(merged[c].total_rows, merged[c].non_null_rows) for c in ("id", "v", "t")] == [(11000, 11000), (11000, 9900), (11000, 11000)]
    for c, exact in (("id", 9000), ("v", 9), ("t", 500)):
        assert abs(merged[c].distinct_values - exact) <= max(1, 4 * ERROR * exact)
    assert merged["id"].type in ("BIGINT", "INTEGER") and merged["v"].null_rate == 0.1
    alone = {r["column"]: (r["total_rows"], r["non_null_rows"]) for r in column_stats(parts[0]).collect()}
    assert {r["column"]: (r["total_rows"], r["non_null_rows"]) for r in states[0].collect()} == alone


def skewed(spark, rows=20_000, seed=1):
    rng = random.Random(seed)
    values = [None if rng.random() < 0.05 else int(rng.paretovariate(0.8)) for _ in range(rows)]
    return spark.createDataFrame([(v,) for v in values], "v long").repartition(6)


def test_heavy_hitters_equal_the_full_count(spark):
    df = skewed(spark)
    want = sorted(map(tuple, top_n_other(df, "v", 5, nulls="other").collect()))
    proved = heavy_hitters(df, "v", 5, kept=1024)
    assert proved.exact_by_summary and sorted(map(tuple, proved.rows.collect())) == want
    assert sorted(map(tuple, heavy_hitters(df, "v", 5).rows.collect())) == want


def test_heavy_hitters_count_all_where_the_summary_proves_nothing(spark):
    df = spark.range(3000).select((F.col("id") % 1500).alias("v"))  # all alike
    found = heavy_hitters(df, "v", 4, kept=64)
    assert not found.exact_by_summary
    assert sorted(map(tuple, found.rows.collect())) == sorted(map(tuple, top_n_other(df, "v", 4, nulls="other").collect()))


def test_heavy_hitters_of_few_values_text_and_nulls(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("Other",)] * 2 + [(None,)] * 4, "v string")
    assert sorted(map(tuple, heavy_hitters(df, "v", 5).rows.collect())) == [("Other", 2), ("Other", 4), ("a", 3)]
    assert heavy_hitters(df.where("false"), "v", 5).rows.count() == 0
    assert [tuple(r) for r in heavy_hitters(df.where("v is null"), "v", 5).rows.collect()] == [("Other", 4)]


def test_footer_stats_open_footers_only(spark, workdir):
    df = spark.range(1000).select(F.nullif(F.col("id"), F.lit(5)).alias("k"), (F.col("id") / 4).alias("d"), F.lit("x").alias("s"), F.expr("date '2026-01-01'").alias("day"))
    df.repartition(3).write.parquet(f"{workdir}/t")
    with footers.session_conf(spark, footers.PUSHED):
        plan = footers._aggregate(spark, f"{workdir}/t", None)[0]._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan and "MIN(k)" in plan
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    got = {r["column"]: tuple(r)[1:] for r in footer_stats(spark, f"{workdir}/t").collect()}
    assert got == {"k": (1000, 999, "0", "999"), "d": (1000, 1000, None, None), "s": (1000, 1000, None, None), "day": (1000, 1000, "2026-01-01", "2026-01-01")}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    df.where("false").write.parquet(f"{workdir}/empty")
    assert {tuple(r)[1:] for r in footer_stats(spark, f"{workdir}/empty").collect()} == {(0, 0, None, None)}


def test_refreshing_a_partition_leaves_the_files_of_the_others(spark, workdir):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("part"))
    path = write_partitioned(df, f"{workdir}/mart", ["part"])
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/part=*/*.parquet")}
    before = files()
    for _ in range(2):
        refresh_partitions(df.where("part = 2").withColumn("id", F.col("id") + 1000), path, ["part"])
    after = files()
    assert {f for f in before if "part=2" not in f} == {f for f in after if "part=2" not in f}
    assert all(after[f] == t for f, t in before.items() if "part=2" not in f)
    assert sorted(r.id for r in spark.read.parquet(path).where("part = 2").collect()) == [i + 1000 for i in range(2, 100, 4)]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        refresh_partitions(df.where("part = 1").withColumn("id", F.expr("1 / (id - id)")), path, ["part"])
    assert spark.read.parquet(path).count() == 100
    refresh_partitions(df.where("part = 3").withColumn("part", F.lit(9)), path, ["part"])  # a new one is added
    assert spark.read.parquet(path).count() == 125


def test_a_view_is_there_between_every_two_statements(spark, workdir, monkeypatch):
    name, path = "swap_view", f"{workdir}/views"
    load_view(spark.range(3), name, path)
    seen = []
    run = type(spark).sql

    def watched(self, text, *args, **kwargs):
        out = run(self, text, *args, **kwargs)
        seen.append((self.table(name).columns, self.table(name).count()))
        return out

    monkeypatch.setattr(type(spark), "sql", watched)
    monkeypatch.setattr(warehouse, "_remove", lambda s, p, f=warehouse._remove: (f(s, p), seen.append((s.table(name).columns, s.table(name).count()))))
    load_view(spark.range(5).selectExpr("id AS `a b`", "'x' AS t"), name, path)
    assert len(seen) >= 4 and set(map(str, seen)) <= {str((["id"], 3)), str((["a b", "t"], 5))}
    monkeypatch.undo()
    assert spark.table(name).columns == ["a b", "t"] and len(glob.glob(f"{path}/v-*")) == 1
    load_view(spark.range(2), name, path, keep=2)
    assert spark.table(name).count() == 2 and len(glob.glob(f"{path}/v-*")) == 2
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        load_view(spark.range(2).selectExpr("1 / (id - 1) AS z"), name, path)
    assert spark.table(name).count() == 2
    for t in spark.catalog.listTables():
        if t.name.startswith(name):
            spark.sql(f"DROP {'VIEW' if t.name == name else 'TABLE'} {t.name}")
