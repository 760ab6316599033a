"""Profile job: type, NULL rate and distinct count of every column of a source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.profile import profile, profile_records
from tessera.operators.sample import sample_rows as exact_sample
from tessera.session import remove_scratch
from tessera.sources.parquet import read_parquet
from tessera.sources.report import write_profile_json, write_profile_records
from tessera.sources.tsv import read_tsv, read_tsv_staged

DEFAULT_REPORT_DIR = "data/bronze/profile_report.json"


def _source(spark: SparkSession, path: str, fmt: str, sep: str, multiline: bool | str) -> DataFrame:
    if fmt == "tsv":
        return read_tsv(spark, path, sep=sep, multiline=multiline)
    if fmt == "parquet":
        return read_parquet(spark, path)
    raise ValueError("fmt must be 'tsv' or 'parquet'")


def profile_dataset(
    spark: SparkSession,
    path: str,
    fmt: str = "tsv",
    columns: Sequence[str] | None = None,
    sample_rows: int | None = None,
    approx: bool = False,
    sep: str = "\t",
    as_records: bool = False,
    multiline: bool | str = True,
) -> DataFrame | list[dict]:
    """Profile a delimited file (typed from the whole file) or a Parquet dataset.

    Full scan by default; ``sample_rows`` profiles a sample of exactly that many
    rows (:func:`tessera.operators.sample.sample_rows`) instead; ``approx`` uses approximate distinct counts; ``multiline``
    is that of :func:`tessera.sources.tsv.read_tsv`. Returns a
    DataFrame, or with ``as_records`` the list of records
    (:func:`tessera.operators.profile.profile_records`).
    """
    if as_records:  # eager: the staged text copy can be removed right after
        staged = None
        if fmt == "tsv":
            df, staged = read_tsv_staged(spark, path, sep=sep, multiline=multiline)
        else:
            df = _source(spark, path, fmt, sep, multiline)
        try:
            src = exact_sample(df, sample_rows) if sample_rows else df
            return profile_records(src, columns=columns, approx=approx)
        finally:
            if staged:
                remove_scratch(spark, staged)
    df = _source(spark, path, fmt, sep, multiline)
    return profile(df, columns=columns, approx=approx, sample_rows=sample_rows)


def save_profile(
    profile_data: DataFrame | list[dict], out_dir: str = DEFAULT_REPORT_DIR, layout: str = "array"
) -> str:
    """Write the profile as a JSON report and return its path.

    A DataFrame is written by Spark into the folder ``out_dir`` (one JSON
    array by default, or ``layout="lines"``); a list of records is written as
    the single file ``out_dir``, one JSON array indented by two.
    """
    if isinstance(profile_data, DataFrame):
        return write_profile_json(profile_data, out_dir, layout=layout)
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("no active Spark session to write the report with")
    return write_profile_records(spark, list(profile_data), out_dir)


def profile_job(
    spark: SparkSession,
    path: str,
    out_dir: str = DEFAULT_REPORT_DIR,
    fmt: str = "tsv",
    columns: Sequence[str] | None = None,
    sample_rows: int | None = None,
    approx: bool = False,
    sep: str = "\t",
    layout: str = "file",
    multiline: bool | str = True,
) -> str:
    """Profile a source and write the JSON report; return the report path.

    ``layout="file"`` (the default) writes ``out_dir`` as one file holding an
    indented JSON array of records (:func:`save_profile` of
    :func:`tessera.operators.profile.profile_records`); ``"array"`` and
    ``"lines"`` write a report folder with Spark's JSON writer. For a
    delimited source the staged Parquet copy of the text (see
    :func:`tessera.sources.tsv.read_tsv`) is removed once the report is
    written, as the bronze job does.
    """
    staged = None
    if fmt == "tsv":
        df, staged = read_tsv_staged(spark, path, sep=sep, multiline=multiline)
    else:
        df = _source(spark, path, fmt, sep, multiline)
    try:
        if layout == "file":
            src = exact_sample(df, sample_rows) if sample_rows else df
            return write_profile_records(spark, profile_records(src, columns=columns, approx=approx), out_dir)
        prof = profile(df, columns=columns, approx=approx, sample_rows=sample_rows)
        return write_profile_json(prof, out_dir, layout=layout)
    finally:
        if staged:
            remove_scratch(spark, staged)
