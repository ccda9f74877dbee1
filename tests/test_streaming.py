import os

from pyspark.sql import types as T

from tessera.functions.geohash import geo_encode
from tessera.streaming.ingest import parquet_batches, stream_files, write_batches


def test_stream_new_objects_through_geo_encode(spark, tmpdir_path):
    src, out, ck = (os.path.join(tmpdir_path, d) for d in ("in", "out", "ck"))
    os.makedirs(src)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("lat", T.DoubleType()),
                           T.StructField("lon", T.DoubleType())])
    spark.createDataFrame([(1, 42.6, -5.6)], schema).write.mode("overwrite").parquet(f"{src}/part1")
    stream = geo_encode(stream_files(spark, src, "parquet", schema, prefix="part"), "lat", "lon", 5)
    q = write_batches(stream, parquet_batches(out), ck, trigger_once=True)
    q.awaitTermination(120)
    spark.createDataFrame([(2, 57.64911, 10.40744)], schema).write.mode("overwrite").parquet(f"{src}/part2")
    q = write_batches(stream, parquet_batches(out), ck, trigger_once=True)
    q.awaitTermination(120)
    got = sorted((r["id"], r["GeoHash"]) for r in spark.read.parquet(f"{out}/batch=*").collect())
    assert got == [(1, "ezs42"), (2, "u4pru")]  # each object read exactly once


def test_stream_csv_objects(spark, tmpdir_path):
    src, out, ck = (os.path.join(tmpdir_path, d) for d in ("in", "out", "ck"))
    os.makedirs(src)
    with open(f"{src}/a.csv", "w") as f:
        f.write('id,note\n1,"two\nlines"\n2,plain\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType())])
    q = write_batches(stream_files(spark, src, "csv", schema), parquet_batches(out), ck, trigger_once=True)
    q.awaitTermination(120)
    got = sorted((r["id"], r["note"]) for r in spark.read.parquet(f"{out}/batch=*").collect())
    assert got == [(1, "two\nlines"), (2, "plain")]
    import pytest
    with pytest.raises(ValueError):
        stream_files(spark, src, "csv")  # file streams need a schema
