"""Row index from footers, existence by a Bloom filter, the durable call log."""
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.enrich import enrich_logged, logged_lookup
from tessera.operators.inventory import check_objects, path_filter
from tessera.operators.reshape import with_row_index, zip_rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_index_is_dense_and_copies_nothing(spark, tmpdir_path):
    spark.range(1000).selectExpr("id", "id % 7 AS p", "'x' AS `a.b`").repartition(5).write.partitionBy("p").parquet(tmpdir_path + "/t")
    src = spark.read.parquet(tmpdir_path + "/t")
    for df in (src, src.select(F.col("id").alias("k"), "p"), src.withColumn("twice", F.col("id") * 2)):
        got = with_row_index(df, "at")
        assert "Scan ExistingRDD" not in _plan(got) and "Sort [" not in _plan(got).split("Window")[0]
        rows = got.collect()
        assert sorted(r["at"] for r in rows) == list(range(1000)) and got.columns == [*df.columns, "at"]
    where = {r.id: (r.f, r.i) for r in src.selectExpr("id", "_metadata.file_path AS f", "_metadata.row_index AS i").collect()}
    order = [r.id for r in with_row_index(src, "at").orderBy("at").collect()]
    assert order == sorted(where, key=where.get)  # by file, then by position
    assert [r.id for r in with_row_index(src, "at").orderBy("at").collect()] == order


def test_scan_index_is_used_for_whole_scans_only(spark, tmpdir_path):
    spark.range(100).repartition(3).write.parquet(tmpdir_path + "/t")
    src = spark.read.parquet(tmpdir_path + "/t")
    for df in (src.where("id % 3 = 0"), src.limit(10), src.union(src), src.groupBy("id").count(), src.withColumn("_metadata", F.lit(1)),
               src.selectExpr("explode(array(id, id)) AS id"), src.dropDuplicates(), src.sample(0.5, seed=1)):
        n = df.count()
        assert sorted(r["at"] for r in with_row_index(df, "at").collect()) == list(range(n))
    assert [r.id for r in with_row_index(src, "at", "id").orderBy("at").collect()] == list(range(100))


def test_zip_of_two_scans(spark, tmpdir_path):
    spark.range(50).coalesce(1).write.parquet(tmpdir_path + "/a")
    spark.range(30).selectExpr("id + 100 AS other").coalesce(1).write.parquet(tmpdir_path + "/b")
    out = zip_rows(spark.read.parquet(tmpdir_path + "/a"), spark.read.parquet(tmpdir_path + "/b"))
    assert "Scan ExistingRDD" not in _plan(out)
    assert sorted((r.id, r.other) for r in out.collect()) == [(i, i + 100) for i in range(30)]


def test_pruned_existence_equals_the_join(spark):
    rnd = random.Random(1)
    listing = spark.createDataFrame([(f"s3://b/{rnd.randint(0, 10**6)}",) for _ in range(500)] + [(None,)], "path string")
    known = [r.path for r in listing.collect()]
    rows = [(i, p) for i, p in enumerate(known[:200] + [None, ""] + [f"s3://b/x{i}" for i in range(5000)])]
    manifest = spark.createDataFrame(rows, "id long, path string").repartition(4)
    want = {r.id: r.exists for r in check_objects(manifest, listing).collect()}
    assert sum(want.values()) == 200
    pruned = check_objects(manifest, listing, prune_absent=True)
    assert pruned.columns == ["id", "path", "exists"]
    assert {r.id: r.exists for r in pruned.collect()} == want
    assert {r.id: r.exists for r in check_objects(manifest, listing, prune_absent=True, max_filter_bytes=8).collect()} == want
    none = check_objects(manifest, listing.where("false"), prune_absent=True)
    assert not any(r.exists for r in none.collect())
    may = path_filter(listing.where("path IS NOT NULL"))
    passed = manifest.where(may(F.col("path"))).count()
    assert 200 <= passed < 200 + 5000 * 0.05  # a small share of the absent ones
    assert path_filter(listing, max_bytes=8) is None


def test_second_run_calls_nothing(spark, tmpdir_path):
    calls = spark.sparkContext.accumulator(0)

    def service(rec):
        calls.add(1)
        assert set(rec) == {"k", "z"}
        if rec["k"] == 3:
            raise LookupError("none")
        return {"v": None if rec["k"] is None else rec["k"] * 10}

    log, schema = tmpdir_path + "/log", T.StructType.fromDDL("v int")
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, None)], "k int, z string")
    run = lambda frame, **kw: {(r.k, r.z): (r.v, r.error) for r in enrich_logged(frame, ["k", "z"], service, schema, log, **kw).collect()}
    first = run(df, max_attempts=2)
    assert calls.value == 4
    assert first == {(1, "a"): (10, None), (2, "b"): (20, None), (None, "c"): (None, None), (3, None): (None, "LookupError: none")}
    assert run(df, max_attempts=2) == first and calls.value == 5  # the failure once more
    assert run(df, max_attempts=2) == first and calls.value == 5  # and no more
    more = df.unionByName(spark.createDataFrame([(9, "n")], df.schema))
    assert run(more, max_attempts=2)[9, "n"] == (90, None) and calls.value == 6
    newest = logged_lookup(df, ["k", "z"], service, schema, log, max_attempts=2)
    assert sorted((r.k or 0, r.attempt) for r in newest.collect()) == [(0, 1), (1, 1), (2, 1), (3, 2)]
    time.sleep(0.2)
    run(df.where("k = 1"), keep_s=0.1)
    assert calls.value == 7  # expired


def test_waves_and_rate(spark, tmpdir_path):
    def service(rec):
        if rec["k"] == 77 and broken:
            raise SystemExit("the job is lost")
        return {"v": rec["k"] + 1}

    schema, df = T.StructType.fromDDL("v long"), spark.range(40).withColumnRenamed("id", "k")
    broken = False
    out = enrich_logged(df, ["k"], service, schema, tmpdir_path + "/waves", wave_keys=15, partitions=2)
    assert {r.k: r.v for r in out.collect()} == {i: i + 1 for i in range(40)}
    assert spark.read.parquet(tmpdir_path + "/waves").count() == 40
    began = time.monotonic()
    logged_lookup(df.limit(12), ["k"], service, schema, tmpdir_path + "/rate", partitions=2, calls_per_s=10.0).count()
    assert time.monotonic() - began > 0.4  # six calls of each of two tasks, five a second


def test_a_lost_wave_leaves_the_others_logged(spark, tmpdir_path):
    log, schema = tmpdir_path + "/log", T.StructType.fromDDL("v long")
    df = spark.range(60).withColumnRenamed("id", "k")
    last = df.select("k", F.pmod(F.xxhash64("k"), F.lit(3)).alias("wave")).where("wave = 2").first()["k"]

    def lost(rec):
        import os
        if rec["k"] == last and os.path.exists(flag):
            raise KeyboardInterrupt
        return {"v": rec["k"]}

    flag = tmpdir_path + "/flag"
    open(flag, "w").close()
    with pytest.raises(Exception):
        logged_lookup(df, ["k"], lost, schema, log, wave_keys=20)
    kept = spark.read.parquet(log).count()
    assert kept == df.where(F.pmod(F.xxhash64("k"), F.lit(3)) < 2).count() > 0
    import os
    os.remove(flag)
    assert logged_lookup(df, ["k"], lost, schema, log, wave_keys=20).count() == 60
