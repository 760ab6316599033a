"""Runs the key-sensitive operators on events with one user holding a third of
all rows, and prints, per operator, the largest number of shuffle records any
reduce task read (from Spark's event log in a scratch folder).

    python tests/skew/run_skewed.py <sf_dir> <scratch_dir>
"""

from __future__ import annotations

import glob
import json
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)


def main(sf_dir: str, scratch: str) -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    events_log = os.path.join(scratch, "eventlog")
    os.makedirs(events_log, exist_ok=True)
    spark = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", events_log)
        .config("spark.eventLog.compress", "false")
        # keep all 16 reduce tasks visible
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from tessera.operators.aggregates import value_frequencies
    from tessera.operators.dedup import row_number_per_key
    from tessera.operators.profile import profile
    from tessera.operators.quality import reconciliation
    from tessera.operators.topk import top_n_other
    from tessera.plans.silver import silver_transform

    skewed = os.path.join(scratch, "events-skewed")
    (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
        .repartition(16)  # a cluster scan has many splits
        .write.mode("overwrite")
        .parquet(skewed)
    )
    df = spark.read.parquet(skewed)
    total = df.count()
    hot = df.where("user_id = 0").count()

    def run(label, build):
        spark.sparkContext.setJobGroup(label, label)
        build().write.format("noop").mode("overwrite").save()

    run(
        "silver",
        lambda: silver_transform(
            df, key="user_id", order_by=("ts", "event_id"), name_columns=("event_type", "props"),
            keep=("user_id", "event_id", "ts"), utc_columns=(),
        ),
    )
    run("top_n_other", lambda: top_n_other(df, "user_id", 5))
    run("value_frequencies", lambda: value_frequencies(df, ["user_id", "event_type"], top=5))
    run("profile", lambda: profile(df.select("user_id", "event_type")))
    run("reconciliation", lambda: reconciliation(df, "user_id", ["event_type", "props"]))
    run("row_number_pieces", lambda: row_number_per_key(df, "user_id", ("ts", "event_id"), strategy="pieces", pieces=48))
    run("row_number_window", lambda: row_number_per_key(df, "user_id", ("ts", "event_id"), strategy="window"))
    spark.stop()

    log = [f for f in glob.glob(events_log + "/**/*", recursive=True) if os.path.isfile(f) and "events_" in f]
    group_of, largest = {}, {}
    for path in log:
        for line in open(path):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e["Stage IDs"]:
                    group_of[sid] = g
            elif e["Event"] == "SparkListenerTaskEnd":
                read = ((e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                g = group_of.get(e["Stage ID"])
                if g:
                    largest[g] = max(largest.get(g, 0), read)
    print(json.dumps({"rows": total, "hot_rows": hot, "largest_task_read": largest}))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
