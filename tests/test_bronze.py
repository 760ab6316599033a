"""Bronze job: delimited snapshot -> complete, typed Parquet copy."""

from __future__ import annotations

import gzip
import os
from datetime import date

import pytest
from pyspark.sql import types as T

from tessera.plans.bronze import bronze_layer, bronze_transform
from tessera.sources.inference import infer_types
from tessera.sources.snapshot import snapshot_path

# The two-row sample and the rows and types it must give.
SAMPLE = "code\tproduct_name\tcompleteness\n0001\tProduct A\t0.5\n0002\tProduct B\t0.8\n"


def _write(path: str, text: str, gz: bool = False) -> str:
    if gz:
        with gzip.open(path, "wt") as fh:
            fh.write(text)
    else:
        with open(path, "w") as fh:
            fh.write(text)
    return path


@pytest.mark.parametrize("gz", [False, True])
def test_snapshot_holds_the_typed_sample(spark, workdir, gz):
    src = _write(os.path.join(workdir, "products.csv" + ".gz" * gz), SAMPLE, gz=gz)
    dest = bronze_layer(spark, src, os.path.join(workdir, "bronze"), run_date=date(2026, 7, 1))
    assert dest == os.path.join(workdir, "bronze", "2026-07-01", "products.parquet")
    back = spark.read.parquet(dest)
    assert [(f.name, f.dataType.simpleString()) for f in back.schema.fields] == [
        ("code", "string"), ("product_name", "string"), ("completeness", "double")
    ]
    assert sorted(tuple(r) for r in back.collect()) == [("0001", "Product A", 0.5), ("0002", "Product B", 0.8)]


@pytest.mark.parametrize("gz", [False, True])
def test_line_breaks_inside_quoted_fields(spark, workdir, gz):
    text = 'id\ttext\n1\t"a\nb ""c""\t\n\nd"\n2\te\n'
    src = _write(os.path.join(workdir, "lines.tsv" + ".gz" * gz), text, gz=gz)
    rows = bronze_transform(spark, src).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 'a\nb "c"\t\n\nd'), (2, "e")]


@pytest.mark.parametrize("line", ["1\t2\t3", "1"])
@pytest.mark.parametrize("multiline", [False, True])
def test_ragged_rows_are_an_error(spark, workdir, line, multiline):
    src = _write(os.path.join(workdir, "ragged.tsv"), f"a\tb\n0\t0\n{line}\n")
    dest = os.path.join(workdir, "bronze")
    with pytest.raises(Exception, match="MALFORMED"):
        bronze_layer(spark, src, dest, run_date=date(2026, 7, 1), multiline=multiline)
    assert not os.path.exists(os.path.join(dest, "2026-07-01", "products.parquet"))


def test_splittable_text_is_not_copied(spark, workdir):
    from tessera.sources.tsv import read_tsv_staged

    src = _write(os.path.join(workdir, "plain.tsv"), SAMPLE)
    df, staged = read_tsv_staged(spark, src, multiline=False)
    assert staged is None and sorted(tuple(r) for r in df.collect()) == [("0001", "Product A", 0.5), ("0002", "Product B", 0.8)]


def test_rerun_same_date_replaces(spark, workdir):
    src = _write(os.path.join(workdir, "products.csv"), SAMPLE)
    dest_dir = os.path.join(workdir, "bronze")
    bronze_layer(spark, src, dest_dir, run_date=date(2026, 7, 1))
    dest = bronze_layer(spark, src, dest_dir, run_date=date(2026, 7, 1))
    assert spark.read.parquet(dest).count() == 2


def test_snapshot_path_layout():
    assert snapshot_path("gs://bucket/bronze/", date(2026, 7, 1)) == "gs://bucket/bronze/2026-07-01/products.parquet"
    assert snapshot_path("gs://bucket/bronze", date(2026, 7, 1)) == "gs://bucket/bronze/2026-07-01/products.parquet"
    assert "//2026" not in snapshot_path("data/bronze/", date(2026, 7, 1))
    assert snapshot_path("data/bronze").endswith(f"/{date.today().isoformat()}/products.parquet")


def test_header_only_file(spark, workdir):
    src = _write(os.path.join(workdir, "empty.tsv"), "a\tb\n")
    df = bronze_transform(spark, src)
    assert df.count() == 0
    assert [f.dataType for f in df.schema.fields] == [T.StringType(), T.StringType()]


def test_empty_and_quoted_empty_read_as_null(spark, workdir):
    src = _write(os.path.join(workdir, "nulls.tsv"), 'a\tb\n1\t\n2\t""\n')
    rows = bronze_transform(spark, src).orderBy("a").collect()
    assert [r["b"] for r in rows] == [None, None]


# (values, expected Spark type) - the inference table of the survey, with the
# documented difference (times stay text).
VECTORS = [
    (["1", "2"], "bigint"),
    (["01", "2"], "string"),
    (["00.5", "1.5"], "string"),
    (["3017620422003", "5"], "bigint"),
    (["9223372036854775808", "1"], "double"),
    (["true", "false"], "boolean"),
    (["t", "f"], "boolean"),
    (["yes", "no"], "boolean"),
    (["1.5", "2"], "double"),
    (["1e3", "2"], "double"),
    (["NaN", "1.5"], "double"),
    (["inf", "1.0"], "string"),
    (["5", "1d"], "string"),
    (["-5", "+5"], "string"),
    ([" 1", "2"], "bigint"),
    (["2026-01-01", "2026-02-03"], "date"),
    (["2026-01-01 00:00:00", "2026-01-02 10:11:12"], "timestamp_ntz"),
    (["2026-01-01T00:00:00Z", "2026-01-02T00:00:00Z"], "timestamp"),
    (["10:00:00", "11:00:00"], "string"),
    (["01/02/2026", "02/02/2026"], "date:d/M/y"),
    (["13/02/2026", "1/2/2026"], "date:d/M/y"),
    (["02/13/2026", "01/02/2026"], "date:M/d/y"),
    (["13/02/2026", "02/13/2026"], "string"),
    (["31/02/2026"], "string"),
    (["2026/01/01", "2026/12/31"], "date:y/M/d"),
    (["2026/01/01", "2026-01-01"], "string"),
    (["a", "1"], "string"),
    ([None, None], "string"),
    (["2026-13-01", "2026-01-01"], "string"),
    (["1.", ".5"], "double"),
    (["-01", "2"], "bigint"),
    (["y", "n"], "string"),
    (["0.50", "1"], "double"),
]


@pytest.mark.parametrize("values,expected", VECTORS)
def test_inference_vectors(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert infer_types(df) == {"v": expected}


def test_inference_of_whole_file_not_a_sample(spark, workdir):
    # the only non-integer value is on the last line of a long file
    lines = ["n"] + [str(i) for i in range(1, 5000)] + ["x"]
    src = _write(os.path.join(workdir, "long.tsv"), "\n".join(lines) + "\n")
    assert bronze_transform(spark, src).schema["n"].dataType == T.StringType()


def test_column_names_with_special_characters(spark, workdir):
    src = _write(os.path.join(workdir, "odd.tsv"), "a.b\tc d\te`f\n1\tx\t2.5\n")
    df = bronze_transform(spark, src)
    assert df.columns == ["a.b", "c d", "e`f"]
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "string", "double"]


def test_staged_copy_removed_after_bronze_write(spark, workdir):
    import glob

    from tessera.session import checkpoint_dir, remove_scratch
    from tessera.sources.tsv import read_tsv_staged

    root = checkpoint_dir(spark).removeprefix("file:") + "/tessera"
    src0 = _write(os.path.join(workdir, "p0.csv"), SAMPLE)
    _, staged = read_tsv_staged(spark, src0)
    assert os.path.isdir(staged.removeprefix("file:"))
    remove_scratch(spark, staged)
    assert not os.path.exists(staged.removeprefix("file:"))
    before = set(glob.glob(root + "/staged-text-*"))
    src = _write(os.path.join(workdir, "products.csv"), SAMPLE)
    bronze_layer(spark, src, os.path.join(workdir, "bronze"), run_date=date(2026, 7, 1))
    assert set(glob.glob(root + "/staged-text-*")) == before
    with pytest.raises(ValueError):
        remove_scratch(spark, workdir)


def test_gated_checks_equal_plain_pattern_and_cast(spark):
    """The gates in front of the patterns only skip values that cannot match."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st
    from pyspark.sql import functions as F

    from tessera.sources.inference import TYPE_LATTICE, try_type, value_checks

    alphabet = st.sampled_from(list("0123456789 -+.:eEnNaTZtrufalsyoFx/"))
    values = st.lists(st.text(alphabet, min_size=0, max_size=22), min_size=1, max_size=400)
    samples = [
        "2026-01-01", "2026-1-1 10:00", "2026-01-01T00:00:00Z", "2026-01-01 00:00:00+02:00",
        " 12 ", "-0", "1e5", "e5", ".", "-", "NaN", "nan", "Yes", "f", "9223372036854775808",
        "2026-13-01", "1.", ".5", "", "   ", "13/02/2026", "2/13/2026", "2026/1/31", "2026/31/1",
    ]

    @settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
    @given(values)
    def check(batch):
        df = spark.createDataFrame([(x,) for x in batch + samples], "v string")
        v = F.col("v")
        gated = value_checks(v)
        cols = []
        for type_name, pattern in TYPE_LATTICE:
            plain = v.rlike(f"^(?:{pattern})$") & try_type(v, type_name).isNotNull()
            cols.append(F.count_if(gated[type_name] != plain).alias(type_name))
        row = df.agg(*cols).first()
        assert all(row[t] == 0 for t, _ in TYPE_LATTICE), row

    check()


def test_failed_rerun_keeps_previous_snapshot(spark, workdir):
    from pyspark.sql import functions as F

    from tessera.sources.snapshot import write_snapshot

    run = date(2026, 7, 1)
    path = write_snapshot(spark.range(0, 5), workdir + "/snap/", run)
    assert path == workdir + "/snap/2026-07-01/products.parquet"
    failing = spark.range(0, 5).withColumn("x", F.when(F.col("id") == 3, F.raise_error(F.lit("boom"))))
    with pytest.raises(Exception, match="boom"):
        write_snapshot(failing, workdir + "/snap", run)
    assert spark.read.parquet(path).count() == 5
    # a successful rerun replaces it
    write_snapshot(spark.range(0, 2), workdir + "/snap", run)
    assert spark.read.parquet(path).count() == 2


def test_failed_rename_keeps_previous_snapshot(spark, workdir, monkeypatch):
    from tessera.sources import parquet as P

    path = P.write_parquet(spark.range(5), workdir + "/swap/x.parquet")

    class Failing:
        """A file system on which the new folder can't be moved in."""

        def __init__(self, fs):
            self.fs = fs

        def rename(self, a, b):
            return False if "__writing-" in a.toString() else self.fs.rename(a, b)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    real = P._fs
    monkeypatch.setattr(P, "_fs", lambda s, p: (Failing(real(s, p)[0]), real(s, p)[1]))
    with pytest.raises(OSError, match="could not move"):
        P.write_parquet(spark.range(2), path)
    assert spark.read.parquet(path).count() == 5
    monkeypatch.undo()
    P.write_parquet(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2
    assert [d for d in os.listdir(workdir + "/swap") if "__before" in d] == []


def test_store_without_renames_is_written_in_place(spark, workdir, monkeypatch):
    from tessera.sources import parquet as P

    monkeypatch.setattr(P, "RENAMES", ())
    path = P.write_parquet(spark.range(5), workdir + "/store/x.parquet")
    assert spark.read.parquet(path).count() == 5
    P.write_parquet(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
    assert os.listdir(workdir + "/store") == ["x.parquet"]


def test_read_snapshots_all_or_chosen_dates(spark, workdir):
    from pyspark.sql import functions as F

    from tessera.sources.snapshot import read_snapshots, write_snapshot

    root = workdir + "/hist"
    for day, n in ((1, 3), (2, 5), (3, 7)):
        write_snapshot(spark.range(0, n), root, date(2026, 7, day))
    counts = {r[0]: r[1] for r in read_snapshots(spark, root).groupBy("snapshot_date").count().collect()}
    assert counts == {date(2026, 7, 1): 3, date(2026, 7, 2): 5, date(2026, 7, 3): 7}
    some = read_snapshots(spark, root, dates=[date(2026, 7, 3)])
    assert some.agg(F.count(F.lit(1)), F.min("snapshot_date")).first() == (7, date(2026, 7, 3))
