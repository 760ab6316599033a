"""Delimited text sources (tab-separated, optionally gzip-compressed)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import qcol
from tessera.scratch import lasting_path
from tessera.session import scratch_path, spread, spread_pieces
from tessera.sources.inference import apply_types, infer_types
from tessera.sources.records import stage_record_table


#: Files that Spark decompresses, each in one task.
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


def read_text_table(
    spark: SparkSession,
    path: str,
    sep: str = "\t",
    header: bool = True,
    multiline: bool = True,
) -> DataFrame:
    """Scan a delimited file (or folder / glob) with every column as text, by
    Spark's own reader.

    Empty and quoted-empty fields read as NULL; a doubled quote inside a quoted
    field is a literal quote. ``.gz`` files are decompressed in place. A row with
    more or fewer fields than the header is an error, when the data is read.

    ``multiline`` (the default) keeps line breaks inside quoted fields. A plain
    file is then one task, as a gzip file always is. :func:`read_tsv` splits it
    (:mod:`tessera.sources.records`).
    """
    return (
        spark.read.option("sep", sep)
        .option("header", header)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "FAILFAST")
        .option("columnPruning", False)  # every row is checked in full
        .csv(path)
    )


def text_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, bytes) of the files behind a file, folder or glob, from metadata."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(str(path))
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for status in fs.globStatus(hpath) or []:
        files = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        out += [(f.getPath().getName(), f.getLen()) for f in files if f.isFile()]
    return out


def estimated_text_bytes(files: list[tuple[str, int]]) -> int:
    """Bytes of text: gzip files count ten times their size (a typical ratio)."""
    return sum(size * (10 if name.endswith(".gz") else 1) for name, size in files)


def read_tsv_staged(
    spark: SparkSession,
    path: str,
    sep: str = "\t",
    header: bool = True,
    multiline: bool | str = True,
    lasting: bool = False,
) -> tuple[DataFrame, str | None]:
    """:func:`read_tsv` (``multiline`` as there), also returning the staged table's path (or ``None``) so
    a job can remove it once its output is written."""
    text = read_text_table(spark, path, sep=sep, header=header, multiline=bool(multiline))
    files = text_files(spark, path)
    if not multiline and not any(name.endswith(".gz") for name, _ in files):
        # splittable text: typed and read again in place, one pass over all columns
        return apply_types(text, infer_types(text, chunk_columns=None)), None
    names, size = list(text.columns), estimated_text_bytes(files)
    staged_path = lasting_path(spark, "staged-text") if lasting else scratch_path(spark, "staged-text")
    if multiline is True and files and not any(name.endswith(COMPRESSED) for name, _ in files):
        staged = stage_record_table(spark, path, staged_path, len(names), spread_pieces(spark, size), sep=sep, header=header)
    else:
        positional = [qcol(c).alias(f"_c{i}") for i, c in enumerate(names)]
        spread(text.select(*positional), size).write.parquet(staged_path)
        staged = spark.read.parquet(staged_path)
    text = staged.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)])
    return apply_types(text, infer_types(text)), staged_path


def read_tsv(
    spark: SparkSession,
    path: str,
    sep: str = "\t",
    header: bool = True,
    multiline: bool | str = True,
) -> DataFrame:
    """Scan a delimited file and type every column from the whole file.

    By default quoted fields may hold line breaks. Plain text is then split
    like any other: records are told by the quotes before them
    (:mod:`tessera.sources.records`), for which a quote must stand in quoted
    fields only. ``multiline="whole"`` reads each plain file in one task instead,
    where a quote inside an unquoted field is a character like others.
    ``multiline=False`` says that no field holds a line break.

    Compressed text and text with line breaks in fields is read and parsed once, spread over the cluster by size and written as a Parquet
    table in the shared checkpoint folder (columnar, under positional column
    names so any source name is safe); inference and the typed result both read
    that copy, and a lost executor recomputes from it. The result is lazy, so
    the copy stays until the driver process ends; jobs that write their output
    use :func:`read_tsv_staged` and remove it then. Splittable text isn't copied.
    """
    return read_tsv_staged(spark, path, sep=sep, header=header, multiline=multiline, lasting=True)[0]
