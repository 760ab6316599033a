"""Plain text with line breaks in quoted fields, read in several tasks."""

from __future__ import annotations

import os
import random

import pyarrow as pa
import pytest

from tessera.session import session_conf
from tessera.sources import records
from tessera.sources.records import read_record_table, read_records
from tessera.sources.tsv import read_tsv


def write(path, text):
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def quoted(value):
    if value is None:
        return ""
    return '"' + value.replace('"', '""') + '"' if any(c in value for c in '"\t\n\r') else value


def split_every(spark, size):
    return session_conf(spark, {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"})


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_rows_that_were_written_whatever_the_splits(spark, workdir, seed):
    rng = random.Random(seed)
    alphabet = ["a", "é", '"', '""', "\n", "\n\n", "\t", "x" * 40, "line\n" * 9, ","]
    rows = [(f"k{i}", "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 8))) or None, rng.choice([None, "z", '"q"\n'])) for i in range(rng.randint(1, 25))]
    text = "key\ttext\tlast\n" + "".join("\t".join(map(quoted, r)) + "\n" for r in rows)
    path = write(os.path.join(workdir, "t.tsv"), text if seed % 2 else text[:-1])
    for size in (11, 60, 100_000):
        with split_every(spark, size):
            df = read_record_table(spark, path, ["key", "text", "last"])
            assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, rows)), size
    assert sorted(map(str, read_tsv(spark, path, multiline="whole").collect())) == sorted(map(str, read_tsv(spark, path).collect()))


def test_several_files_tasks_and_line_ends(spark, workdir):
    folder = os.path.join(workdir, "in")
    os.mkdir(folder)
    write(f"{folder}/a.tsv", 'id\ttext\r\n1\t"a\r\nb"\r\n\r\n2\tc\r\n')
    write(f"{folder}/b.tsv", "id\ttext\n" + "".join(f'{i}\t"{"y" * 30}\n{i}"\n' for i in range(3, 20)))
    with split_every(spark, 100):
        assert spark.read.text(folder).rdd.getNumPartitions() > 5
        rows = sorted(tuple(r) for r in read_tsv(spark, folder).collect())
    assert rows == [(1, "a\r\nb"), (2, "c")] + [(i, "y" * 30 + f"\n{i}") for i in range(3, 20)]


def test_a_record_over_many_splits(spark, workdir):
    path = write(os.path.join(workdir, "t.tsv"), 'id\ttext\n1\t"' + "long line\n" * 100 + '"\n2\tb\n')
    with split_every(spark, 64):
        assert sorted((r[0], len(r[1])) for r in read_record_table(spark, path, ["id", "text"]).collect()) == [("1", 1000), ("2", 1)]
        assert read_records(spark, path).where("header").count() == 1


@pytest.mark.parametrize("line", ["1\t2\t3", "1", '1\t"open'])
def test_rows_that_do_not_fit_are_an_error(spark, workdir, line):
    path = write(os.path.join(workdir, "t.tsv"), "a\tb\n" + "0\t0\n" * 20 + line + "\n" + "0\t0\n" * 20)
    with split_every(spark, 40), pytest.raises(Exception, match="MALFORMED"):
        read_record_table(spark, path, ["a", "b"]).collect()


def test_header_only(spark, workdir):
    df = read_tsv(spark, write(os.path.join(workdir, "t.tsv"), "a\tb\n"))
    assert df.columns == ["a", "b"] and df.count() == 0


def test_many_splits_are_read_by_few_tasks_and_no_line_is_shuffled(spark, workdir):
    rows = [(i, f"line {i}\n" * (i % 5) + "end" * (i % 40)) for i in range(400)]
    path = write(os.path.join(workdir, "t.tsv"), "id\ttext\n" + "".join(f"{i}\t{quoted(t)}\n" for i, t in rows))
    with split_every(spark, 64), session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert spark.read.text(path).rdd.getNumPartitions() > 100
        pieces = records.read_pieces(spark, path, 2)
        assert pieces.rdd.getNumPartitions() == 2
        plan = pieces._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        df = read_tsv(spark, path)
        assert df.rdd.getNumPartitions() <= 2
        assert sorted((r[0], r[1] or "") for r in df.collect()) == rows


def test_lines_out_of_order_are_an_error():
    batch = pa.RecordBatch.from_pydict({"file": ["f"] * 3, "split": [0] * 3, "inside": [False] * 3, "line": ["a", "b", "c"], "seq": [1, 3, 2]})
    with pytest.raises(RuntimeError, match="follow"):
        list(records._pieces(iter([batch])))
