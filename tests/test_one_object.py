"""One real object from many tasks, read by Spark and by DuckDB."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.sources import one_object
from tessera.sources.one_object import write_one_csv, write_one_json_docs

ODD = ['q"x', "a,b", "line\nfeed", " pad ", "é😀", "\\", "x" * 5000]


@pytest.fixture()
def frame(spark):
    rows = spark.range(0, 400, 1, 7).withColumn("s", F.element_at(F.array(*map(F.lit, ODD)), (F.col("id") % len(ODD) + 1).cast("int")))
    return rows.withColumnRenamed("s", 'odd, "name"')


def test_csv_is_one_file_in_order(spark, tmpdir_path, frame, monkeypatch):
    monkeypatch.setattr(one_object._copy, "__defaults__", (1000,))  # many ranges a part
    out = write_one_csv(frame, f"{tmpdir_path}/o/", "report.v1.xlsx")
    assert out.endswith("/o/report.csv") and os.path.isfile(out)
    assert os.listdir(os.path.dirname(out)) == ["report.csv"]
    got = duckdb.sql(f"SELECT * FROM read_csv('{out}', header=true, quote='\"', escape='\"', all_varchar=true, parallel=false)")
    assert got.columns == frame.columns
    assert [tuple(r) for r in got.fetchall()] == [(str(i), ODD[i % len(ODD)]) for i in range(400)]


def test_older_objects_are_replaced_and_empty_frames_written(spark, tmpdir_path, frame):
    path = f"{tmpdir_path}/p/"
    frame.write.csv(path + "t.csv")  # a folder of parts of that name
    write_one_csv(frame.limit(5), path, "t")
    assert spark.read.text(write_one_csv(frame.where("false"), path, "t")).collect() == [('id,"odd, ""name"""',)]
    assert os.path.getsize(write_one_json_docs(frame.where("false").select(F.struct("id").alias("doc")), path, "e")) == 0
    assert sorted(os.listdir(path)) == ["e.dict", "t.csv"]


def test_json_documents(spark, tmpdir_path):
    docs = spark.range(0, 50, 1, 5).select(F.struct("id", F.lit(None).cast("string").alias("n")).alias("doc"))
    out = write_one_json_docs(docs, f"{tmpdir_path}/j/", "meta.json")
    with open(out) as f:
        assert f.read() == "".join(f'{{"id":{i},"n":null}}\n' for i in range(50))


def test_failed_write_leaves_the_older_object(spark, tmpdir_path, frame):
    out = write_one_csv(frame.select("id"), f"{tmpdir_path}/f/", "x")
    before = open(out).read()
    with pytest.raises(Exception):
        write_one_csv(frame.select(F.raise_error(F.lit("no")).alias("id")), f"{tmpdir_path}/f/", "x")
    assert open(out).read() == before and os.listdir(os.path.dirname(out)) == ["x.csv"]


def test_parts_are_ordered_by_number():
    names = ["part-100000-u-c000.csv", "part-99999-u-c001.csv", "part-99999-u-c000.csv", "part-00002-u.txt"]
    assert sorted(names, key=one_object._number) == ["part-00002-u.txt", "part-99999-u-c000.csv", "part-99999-u-c001.csv", "part-100000-u-c000.csv"]
    with pytest.raises(ValueError, match="not a part"):
        one_object._number("part-00001-u-c000.csv.gz")


def test_documents_of_one_partition_are_written_by_many_tasks(spark, tmpdir_path):
    from tessera.sources.files import read_json_docs
    from tessera.sources.sinks import write_docs_apart
    target = write_docs_apart(spark.range(0, 40, 1, 1).selectExpr("concat('{\n\"k\": ', id, '}') AS value"), f"{tmpdir_path}/apart.dict")
    names = [n for n in os.listdir(target) if n.startswith("part-")]
    assert len(names) == 40 and len({n.split("-")[1] for n in names}) > 1 and "_SUCCESS" in os.listdir(target)
    got = read_json_docs(spark, target).selectExpr("variant_get(doc, '$.k', 'int') AS k").collect()
    assert sorted(r.k for r in got) == list(range(40))
