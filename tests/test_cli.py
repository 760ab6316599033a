"""The command line end to end: raw gzip TSV -> bronze -> silver, and the
profile report, on the curation fixture written as text."""

from __future__ import annotations

import gzip
import json
import os
from datetime import date

from tessera.__main__ import main

# The curation fixture.
HEADER = [
    "code", "product_name", "generic_name", "created_datetime", "last_modified_datetime", "countries_tags",
    "brands", "categories_tags", "categories", "main_category", "completeness", "quantity", "product_quantity",
]
ROWS = [
    ["0001", "Product A", "", "2026-01-01 00:00:00", "2026-01-02 00:00:00", "en:france", "BrandA",
     "en:dog-food", "Dog food", "dog-food", "0.8", "1kg", "1.0"],
    ["0001", "Product A (older)", "", "2026-01-01 00:00:00", "2025-12-01 00:00:00", "en:france", "BrandA",
     "en:dog-food", "Dog food", "dog-food", "0.5", "1kg", "1.0"],
    ["0002", "", "", "2026-01-01 00:00:00", "2026-01-01 00:00:00", "en:germany", "BrandB",
     "en:cat-food", "Cat food", "cat-food", "0.6", "500g", "0.5"],
    ["", "No Code Product", "", "2026-01-01 00:00:00", "2026-01-01 00:00:00", "en:spain", "BrandC",
     "en:cat-food", "Cat food", "cat-food", "0.7", "2kg", "2.0"],
]


def _last_line(capsys) -> str:
    return capsys.readouterr().out.strip().splitlines()[-1]


def test_bronze_then_silver_then_profile(spark, workdir, capsys):
    src = os.path.join(workdir, "products.csv.gz")
    with gzip.open(src, "wt") as fh:
        fh.write("\n".join("\t".join(r) for r in [HEADER, *ROWS]) + "\n")

    main(["bronze", src, "--dest-dir", os.path.join(workdir, "bronze") + "/"])
    bronze_path = _last_line(capsys)
    assert bronze_path == os.path.join(workdir, "bronze", date.today().isoformat(), "products.parquet")
    bronze = spark.read.parquet(bronze_path)
    assert bronze.columns == HEADER and bronze.count() == 4
    types = dict(bronze.dtypes)
    assert types["code"] == "string" and types["completeness"] == "double"
    assert types["created_datetime"] == "timestamp_ntz" and types["generic_name"] == "string"

    main(["silver", bronze_path, "--dest-dir", os.path.join(workdir, "silver")])
    silver = spark.read.parquet(_last_line(capsys))
    assert [(r.code, r.product_name, r.completeness) for r in silver.collect()] == [("0001", "Product A", 0.8)]

    out = os.path.join(workdir, "profile_report.json")
    main(["profile", src, "--out", out])
    assert _last_line(capsys) == out
    with open(out) as fh:  # one file, an indented JSON array
        report = json.load(fh)
    assert [r["column"] for r in report] == HEADER
    by_name = {r["column"]: r for r in report}
    assert by_name["code"] == {"column": "code", "type": "VARCHAR", "null_rate": 0.25, "distinct_values": 2}
    assert by_name["generic_name"]["null_rate"] == 1.0


def test_profile_of_a_column_subset(spark, workdir, capsys):
    src = os.path.join(workdir, "subset.tsv")
    with open(src, "w") as fh:
        fh.write("\n".join("\t".join(r) for r in [HEADER, *ROWS]) + "\n")
    out = os.path.join(workdir, "subset_report.json")
    main(["profile", src, "--out", out, "--columns", "brands,code"])
    with open(_last_line(capsys)) as fh:
        report = json.load(fh)
    assert [r["column"] for r in report] == ["brands", "code"]


def test_gcs_switch_requires_a_gs_destination(spark, workdir):
    import pytest

    src = os.path.join(workdir, "g.tsv")
    with open(src, "w") as fh:
        fh.write("a\n1\n")
    with pytest.raises(ValueError, match="gs://"):
        main(["bronze", src, "--dest-dir", os.path.join(workdir, "bronze"), "--gcs"])
    with pytest.raises(ValueError, match="gs://"):
        main(["silver", os.path.join(workdir, "none.parquet"), "--dest-dir", "s3a://b/silver", "--gcs"])
