"""Records of plain delimited text with line breaks in quoted fields, in parallel.

A line break ends a record where an even number of quotes stands before it in
the file (a quote inside a quoted field is doubled, so it doesn't change that).
The quotes of every split are counted; the parity of the splits before one says
whether it begins inside a quoted field. Knowing that, every task puts the lines
of its own splits together to records. Only what crosses a split, the end of a
record at its start and the start of one at its end, is joined afterwards, two
pieces to a split at most. No line is shuffled for that, and the text isn't
read by one task. The text is read twice: for its quotes, and for its records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
#: What a piece is: a whole record, the end of one that began in an earlier
#: split, a split that lies in one record, the start of one that goes on.
WHOLE, END, INNER, START = 0, 1, 2, 3
_PIECE = pa.schema([("file", pa.string()), ("split", pa.int64()), ("kind", pa.int32()), ("header", pa.bool_()), ("record", pa.string())])
_PIECE_DDL = "file string, split long, kind int, header boolean, record string"


def _lines(spark: SparkSession, path: str, tasks: int | None) -> DataFrame:
    """(file, split, seq, line): seq is increasing within a split. The splits of
    the files are read by at most ``tasks`` tasks, each whole by one."""
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line")
    )
    return lines.coalesce(tasks) if tasks else lines


def _inside_at_start(lines: DataFrame) -> DataFrame:
    """(file, split, inside): whether a split begins in a quoted field. One row
    to a split; a file's splits are ordered in one task."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit(QUOTE), F.lit("")))
    odd = lines.groupBy("file", "split").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return odd.select("file", "split", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (file, split, inside, line, seq) in the order of their lines."""
    at, held, inside, whole, header, line_before = None, [], False, True, False, -1

    def piece(kind: int, texts: list[str]) -> pa.RecordBatch:
        n = len(texts)
        first = [header and i == 0 for i in range(n)]
        columns = [[at[0]] * n, [at[1]] * n, [kind] * n, first, texts]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE)], schema=_PIECE)

    def rest() -> Iterator[pa.RecordBatch]:
        if held:  # the split's last record goes on in the next one
            yield piece(START if whole else INNER, ["\n".join(held)])

    for batch in batches:
        files, splits, starts_inside, lines = (batch.column(i) for i in range(4))
        odd = np.asarray(pc.count_substring(lines, QUOTE)) % 2 == 1
        split, seq = np.asarray(splits), np.asarray(batch.column(4))
        file = np.asarray(files.dictionary_encode().indices)
        cuts = np.flatnonzero(np.concatenate(([True], (split[1:] != split[:-1]) | (file[1:] != file[:-1])))).tolist() if len(split) else []
        for a, b in zip(cuts, [*cuts[1:], len(split)]):
            now = (files[a].as_py(), int(split[a]))
            if now != at:
                yield from rest()
                at, held, inside = now, [], starts_inside[a].as_py()
                whole, header = not inside, now[1] == 0
                line_before = -1
            order = np.concatenate(([line_before], seq[a:b]))
            if (order[1:] <= order[:-1]).any():
                raise RuntimeError(f"the lines of {now} don't follow each other")
            line_before = int(order[-1])
            texts = lines[a:b].to_pylist()
            state = np.logical_xor.accumulate(np.concatenate(([inside], odd[a:b])))[1:]  # after each line
            done, begin = [], 0
            for end in np.flatnonzero(~state).tolist():
                record = "\n".join([*held, *texts[begin : end + 1]])
                begin, held = end + 1, []
                if whole:
                    done.append(record)
                else:  # the end of a record of an earlier split
                    yield piece(END, [record])
                    whole = True
            if done:
                yield piece(WHOLE, done)
                header = False
            held += texts[begin:]
            inside = bool(state[-1])
    yield from rest()


def read_pieces(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """(file, split, kind, header, record): the whole records of every split, and
    the pieces of those that cross one. What is sent to all tasks is a row to
    each split that begins inside a quoted field."""
    lines = _lines(spark, path, tasks)
    inside = F.broadcast(_inside_at_start(lines).where("inside"))  # so the lines stay where they were read, in their order
    known = lines.join(inside, ["file", "split"], "left")
    return known.select("file", "split", F.coalesce("inside", F.lit(False)).alias("inside"), "line", "seq").mapInArrow(_pieces, _PIECE_DDL)


def crossing_records(pieces: DataFrame) -> DataFrame:
    """(record, header) of the pieces that are no whole records; a quoted field
    that the file doesn't close is an error."""
    # a record's pieces: its start, splits inside it, and its end, which follow each other in the file
    order = Window.partitionBy("file").orderBy("split", "kind")
    number = F.sum((F.col("kind") == START).cast("long")).over(order)
    crossing = pieces.withColumn("number", number).groupBy("file", "number")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("split", "kind", "record"))), lambda x: x["record"])
    last = F.max_by("kind", F.struct("split", "kind"))
    crossing = crossing.agg(F.array_join(texts, "\n").alias("record"), F.bool_or("header").alias("header"), last.alias("last"), F.first("file").alias("f"))
    open_ended = F.raise_error(F.concat(F.lit("MALFORMED: a quoted field is never closed in "), F.col("f")))
    return crossing.select(F.when(F.col("last") == END, F.col("record")).otherwise(open_ended).alias("record"), "header")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, header): the records of plain text files, without their last
    line break; ``header`` marks the first one of each file. Blank lines between
    records are dropped; a quoted field that the file doesn't close is an error."""
    pieces = read_pieces(spark, path)
    whole = pieces.where(F.col("kind") == WHOLE).select("record", "header")
    records = whole.unionByName(crossing_records(pieces.where(F.col("kind") != WHOLE)))
    return records.select(_clean("record").alias("record"), "header").where(F.col("record") != "")


def _clean(record: str) -> Column:
    return F.regexp_replace(record, "\r$", "")


def _parsed(record: Column, fields: int, sep: str) -> Column:
    """A struct of the text fields _c0, _c1, ... of a record; another number of
    fields is an error when the data is read."""
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(fields)])
    # every field is asked for, so that each record is checked in full
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "mode": "FAILFAST", "columnPruning": "false", "maxColumns": str(max(20480, fields + 1))}
    return F.from_csv(record, schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)


def read_record_table(spark: SparkSession, path: str, names: list[str], sep: str = "\t", header: bool = True) -> DataFrame:
    """The records parsed into text columns ``names``; a record with more or
    fewer fields is an error when the data is read."""
    records = read_records(spark, path)
    if header:
        records = records.where(~F.col("header"))
    fields = records.select(_parsed(F.col("record"), len(names), sep).alias("r"))
    return fields.select(*[F.col(f"r._c{i}").alias(n) for i, n in enumerate(names)])


def stage_record_table(spark: SparkSession, path: str, staged_path: str, fields: int, tasks: int, sep: str = "\t", header: bool = True) -> DataFrame:
    """The parsed records as columns _c0, _c1, ..., written below ``staged_path``
    and read again, both by at most ``tasks`` tasks. Records are put together
    once: pieces of those that cross a split are written beside the others and
    joined from there."""
    crosses, names = F.col("kind") != WHOLE, [f"_c{i}" for i in range(fields)]
    pieces = read_pieces(spark, path, tasks).withColumn("text", _clean("record"))
    kept = pieces.where(crosses | ((F.col("text") != "") & ~(F.col("header") & F.lit(header))))
    parsed = kept.select(F.when(~crosses, _parsed(F.col("text"), fields, sep)).alias("r"), "file", "split", "kind", "header", F.when(crosses, F.col("record")).alias("record"))
    parsed.select(*[f"r.{n}" for n in names], "file", "split", "kind", "header", "record").write.parquet(staged_path + "/read")
    pieces = spark.read.parquet(staged_path + "/read").where(crosses).select("file", "split", "kind", "header", "record").coalesce(tasks)
    joined = crossing_records(pieces).select(_clean("record").alias("text"), "header").where((F.col("text") != "") & ~(F.col("header") & F.lit(header)))
    joined = joined.select(_parsed(F.col("text"), fields, sep).alias("r")).select(*[f"r.{n}" for n in names], F.lit(WHOLE).alias("kind"))
    joined.write.parquet(staged_path + "/joined")
    ddl = ", ".join([*(f"{n} string" for n in names), "kind int"])
    return spark.read.schema(ddl).parquet(staged_path + "/read", staged_path + "/joined").where(~crosses).select(*names).coalesce(tasks)
