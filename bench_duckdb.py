"""Single-node comparison point: the registered queries' SQL on embedded DuckDB.

The original pipeline hands its SQL to an in-process DuckDB, so timing the same
queries' SQL there, on the same tables and threads, is the closest
single-node baseline for ``bench.py``. Queries without SQL, and the ones whose
Spark version also writes and re-reads files, are timed as SQL only.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tessera.queries import REGISTRY

    con = duckdb.connect()
    con.execute(f"SET threads = {cpus}")
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    timings = {}
    for name, (_, sql) in REGISTRY.items():
        if sql is None:
            continue
        start = time.perf_counter()
        con.execute(sql).fetchall()
        timings[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "duckdb_sql_time", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": os.path.basename(sf_dir).removeprefix("sf")}))


if __name__ == "__main__":
    main()
