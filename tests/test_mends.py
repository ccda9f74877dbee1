"""Conflicting types under a glob, stray responses, results of another type, deletes that leave files alone."""
import json
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import types as T

from tessera.operators.enrich import enrich
from tessera.operators.responses import flatten_geocode, flatten_places, malformed_responses
from tessera.session import error_condition
from tessera.sources import tables
from tessera.sources.files import read_many
from tessera.sources.tables import delete_where, drop_table, finish_delete


def test_conflicting_types_keep_every_column(spark, tmpdir_path):
    spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string").coalesce(1).write.parquet(f"{tmpdir_path}/pq/one.parquet")
    spark.createDataFrame([("q", 2), ("r", 3)], "a string, c int").coalesce(1).write.parquet(f"{tmpdir_path}/pq/two.parquet")
    spark.createDataFrame([(5, "z")], "a int, b string").coalesce(1).write.parquet(f"{tmpdir_path}/pq/three.parquet")
    want = {("1", "x", None), ("2", "y", None), ("5", "z", None), ("q", None, 2), ("r", None, 3)}
    for paths in ([f"{tmpdir_path}/pq/*.parquet"], [f"{tmpdir_path}/pq/{n}.parquet" for n in ("one", "two", "three")]):
        df = read_many(spark, paths)
        assert set(df.columns) == {"a", "b", "c"}
        assert {(r.a, r.b, r.c) for r in df.collect()} == want
    plan = read_many(spark, [f"{tmpdir_path}/pq/*.parquet"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") + plan.count("Scan parquet") >= 2


PLACE = {"name": "Cafe", "rating": 4.5, "geometry": {"location": {"lat": 3.0, "lng": 4.0}}, "types": ["cafe"]}


@pytest.mark.parametrize("stray", ['{"error_message": "quota"}', "3", '"text"', "{broken"])
def test_a_stray_response_changes_nothing_for_others(spark, stray):
    df = spark.createDataFrame([(1.0, 2.0, json.dumps([PLACE])), (1.0, 2.0, stray), (1.0, 2.0, None), (1.0, 2.0, "[]")],
                               "la double, lo double, response string")
    rows = flatten_places(df, "response", "la", "lo").collect()
    assert [(r["name"], r["rating"], r["places_lat"], r["cafe"]) for r in rows] == [("Cafe", 4.5, 3.0, 1)]
    assert malformed_responses(df, "response") == 1


def test_a_stray_element_keeps_its_rank_and_the_others(spark):
    address = {"formatted_address": "1 Main St", "extra": 7, "types": ["premise"]}
    df = spark.createDataFrame([(json.dumps([address, "gone", address]),), (json.dumps([address]),)], "response string")
    rows = flatten_geocode(df, "response").collect()
    assert sorted((r.address_rank, r.extra) for r in rows) == [(0, 7), (0, 7), (2, 7)]
    assert malformed_responses(df, "response") == 1


def test_a_result_of_another_type_is_a_failed_row(spark):
    def service(rec):
        return {"v": "many" if rec["k"] == 2 else rec["k"] * 10, "t": "ok"}

    seen = Observation()
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    got = {r.k: r for r in enrich(df, ["k"], service, T.StructType.fromDDL("v int, t string"), observation=seen).collect()}
    assert (got[1].v, got[1].t, got[3].v) == (10, "ok", 30) and got[1].error is None
    assert got[2].v is None and got[2].t is None and got[2].error.startswith("Arrow")
    assert seen.get["skipped"] == 1


def _files(spark, name):
    return set(spark.table(name).inputFiles())


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_delete_rewrites_touched_files_only(spark, kind):
    name = f"t_delete_{kind}"
    drop_table(spark, name)
    df = spark.range(1000).selectExpr("id", "IF(id % 7 = 0, NULL, id % 5) AS k", "CONCAT('p ', CAST(id % 2 AS STRING), IF(id % 2 = 1, '+%é', '')) AS p")
    df.repartitionByRange(4, "id").write.format(kind).partitionBy("p").saveAsTable(name)
    before = _files(spark, name)
    delete_where(spark, name, "id < 100 AND k = 3")
    left = {r.id for r in spark.table(name).collect()}
    assert left == {i for i in range(1000) if not (i < 100 and i % 7 and i % 5 == 3)}
    after = _files(spark, name)
    assert len(before & after) == len(before) - 2 and len(after) == len(before)  # one range of ids, two partitions
    assert spark.table(name).columns == ["id", "k", "p"]
    delete_where(spark, name, "id > 5000")
    assert _files(spark, name) == after
    delete_where(spark, name, "p = 'p 0'")
    assert {r.id for r in spark.table(name).collect()} == {i for i in left if i % 2}
    drop_table(spark, name)


def test_an_interrupted_delete_is_finished(spark, monkeypatch):
    name = "t_delete_broken"
    drop_table(spark, name)
    spark.range(100).repartitionByRange(4, "id").write.saveAsTable(name)

    def lost(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "remove_files", lost)
        with pytest.raises(OSError):
            delete_where(spark, name, "id % 50 = 3")
    assert finish_delete(spark, name) == 1 and finish_delete(spark, name) == 0
    assert sorted(r.id for r in spark.table(name).collect()) == [i for i in range(100) if i % 50 != 3]
    drop_table(spark, name)


def test_error_conditions(spark):
    with pytest.raises(Exception) as e:
        spark.sql("SELECT nothing_of_that_name")
    assert error_condition(e.value).startswith("UNRESOLVED_COLUMN")
    assert error_condition(ValueError("x")) is None and os.sep
