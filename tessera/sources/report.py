"""JSON report sink for column profiles."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYOUTS = ("array", "lines")


def write_profile_json(profile: DataFrame, out_dir: str, layout: str = "array") -> str:
    """Write a profile (one row per profiled column) as a JSON report in ``out_dir``.

    ``layout="array"`` writes one file holding a single JSON array of records,
    in source column order (the report format of the profiling job);
    ``"lines"`` writes one JSON record per line. Either way NULL rates stay an
    explicit ``null``.

    A profile has one row per *column*, so it is bounded by the schema width:
    gathering it into one record or one output file is safe at any data size.
    Read an array report back with ``spark.read.option("multiLine", True).json``.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    fields = [c for c in profile.columns if c != "position"]
    if layout == "lines":
        ordered = profile.orderBy("position") if "position" in profile.columns else profile
        (
            ordered.select(*fields)
            .coalesce(1)
            .write.mode("overwrite")
            .option("ignoreNullFields", False)
            .json(out_dir)
        )
        return out_dir

    if "position" in profile.columns:
        keyed = profile
    else:  # a profile keeps its rows in column order within its one partition
        keyed = profile.coalesce(1).withColumn("position", F.monotonically_increasing_id())
    records = F.sort_array(F.collect_list(F.struct("position", *fields)))
    report = keyed.agg(
        F.to_json(
            F.transform(records, lambda r: r.dropFields("position")),
            {"ignoreNullFields": "false"},
        ).alias("value")
    )
    report.coalesce(1).write.mode("overwrite").text(out_dir)
    return out_dir


def write_profile_records(spark: SparkSession, records: list[dict], out_path: str) -> str:
    """Write profile records (a list bounded by the schema width) as one JSON
    array file, indented by two, at ``out_path`` on any Hadoop file system;
    parent folders are created, an existing file is replaced."""
    text = json.dumps(records, indent=2)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(str(out_path))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.create(path, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return str(out_path)
