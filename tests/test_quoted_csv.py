"""CSV with quoted line feeds read in many tasks, against Spark's one-task reader and Python's csv module."""
import csv
import io
import random

import pytest

from conftest import SF_SMALL
from tessera.sources.files import read_csv
from tessera.sources.quoted_csv import records, still_quoted
from tessera.sources.sinks import write_csv


@pytest.fixture()
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _same_as_one_task(spark, path, many=True):
    got = read_csv(spark, path, na_tokens=(), infer=False, split_quoted=True)
    want = read_csv(spark, path, na_tokens=(), infer=False)
    assert got.columns == want.columns
    assert _rows(got) == _rows(want)
    if many:
        assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 3
    return got


def test_random_files_in_small_ranges(spark, tmpdir_path, small_splits):
    rnd = random.Random(21)
    for case in range(6):
        pieces = ["a", "b c", '"', "\n", ",", "\n\n", '""', "é", "x" * 40, ""]
        rows = [["".join(rnd.choices(pieces, k=rnd.randint(0, 6))) or "v" for _ in range(3)] for _ in range(60)]
        out = io.StringIO()
        w = csv.writer(out, lineterminator="\n" if case % 2 else "\r\n", quoting=csv.QUOTE_ALL if case % 3 else csv.QUOTE_MINIMAL)
        # the one-task reader takes the first line end it meets for the file's
        name = "na\nme" if case % 2 else "name"
        w.writerows([["k", name, "z"], *rows])
        path = f"{tmpdir_path}/r{case}.csv"
        with open(path, "w", newline="", encoding="utf-8") as f:
            f.write(out.getvalue())
        got = _same_as_one_task(spark, path)
        assert got.columns == ["k", name, "z"]
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows))


def test_record_over_many_ranges_and_stray_quotes(spark, tmpdir_path, small_splits):
    text = ('id,note\n1,"' + "line\n" * 200 + 'end"\n2,5" pipe\n3,"a ""quoted"" word"\n\n4,"open" junk\n5,x\n' + "6,plain line\n" * 30
            + '7,"' + "y" * 500 + '\n"\n8,last')
    path = f"{tmpdir_path}/long.csv"
    with open(path, "w", newline="") as f:
        f.write(text)
    got = {r.id: r.note for r in _same_as_one_task(spark, path).collect()}
    assert got["1"] == "line\n" * 200 + "end" and got["2"] == '5" pipe' and got["8"] == "last"


def test_several_files_one_header_each(spark, tmpdir_path, small_splits):
    for name, body in (("a", 'k,v\n1,"x\ny"\n'), ("b", "k,v\n"), ("c", 'k,v\n2,"' + "z\n" * 90 + '"')):
        with open(f"{tmpdir_path}/{name}.csv", "w", newline="") as f:
            f.write(body)
    paths = [f"{tmpdir_path}/{n}.csv" for n in "abc"]
    got = read_csv(spark, paths, split_quoted=True)
    assert _rows(got) == [(1, "x\ny"), (2, "z\n" * 90)]
    assert records(spark, paths).where("first").count() == 3


def test_documents_equal_one_task_reader(spark, tmpdir_path, small_splits):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    path = write_csv(d.coalesce(1), tmpdir_path + "/", "docs")
    _same_as_one_task(spark, path)
    assert _rows(read_csv(spark, path, split_quoted=True)) == _rows(read_csv(spark, path))


def test_states_of_a_line():
    assert still_quoted('a,"b', False) and not still_quoted('a,"b"', False) and still_quoted('a,"b""', False)
    assert not still_quoted('a"b,c', False) and not still_quoted('b",c', True) and still_quoted('b","c', True)
    assert still_quoted("plain", True) and not still_quoted("", False) and still_quoted("", True)
