"""Components against a plain search, and the plans of joins with a hot key."""

from __future__ import annotations

import random

import pytest

from tessera.llm import components as C
from tessera.llm.exact_dedup import exact_duplicates
from tessera.scratch import Scratch


def brute(edges):
    near = {}
    for u, v in edges:
        if u is not None and v is not None and u != v:
            near.setdefault(u, set()).add(v)
            near.setdefault(v, set()).add(u)
    out = {}
    for start in sorted(near):
        todo = [] if start in out else [start]
        while todo:
            node = todo.pop()
            if node not in out:
                out[node] = start
                todo += near[node]
    return out


def test_matches_plain_search(spark):
    rng = random.Random(5)
    edges = [(rng.randint(-60, 60), rng.randint(-60, 60)) for _ in range(70)] + [(100 + i, 101 + i) for i in range(40)] + [(-99, i) for i in range(200, 260)] + [(None, 1), (3, 3)]
    with Scratch(spark) as scratch:
        got = {r["node"]: r["component"] for r in C.connected_components(spark.createDataFrame(edges, "u long, v long"), scratch).collect()}
    assert got == brute(edges)


@pytest.fixture()
def small_pieces(spark):
    """Thresholds of a few bytes, so that the planner sees skew in small tables."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_digest_that_very_many_rows_hold_is_split(spark, small_pieces):
    docs = spark.range(0, 20000, 1, 8).selectExpr("id AS doc_id", "if(id % 3 > 0, 'hot', concat('pair ', id div 12)) AS text")
    found = exact_duplicates(docs)
    assert "skew=true" in plan_of(found)
    hot = found.where("group_size > 1000").agg({"keep_id": "max", "group_size": "min", "*": "count"}).first()
    assert sorted(hot) == [1, 13333, 13333]
