"""Registered queries of sources, tables and enrichment added later, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.enrich import enrich, enrich_logged
from tessera.operators.inventory import check_objects
from tessera.operators.reshape import with_row_index, zip_rows
from tessera.operators.responses import flatten_places, malformed_responses
from tessera.plans.registry import (_NA_SQL, _SQL_READ_MANY_CSV_HEADERS, _new_table, _scratch, _taken, profile_service, table)
from tessera.sources.files import read_many, walk_files
from tessera.sources.one_object import write_one_csv, write_one_json_docs
from tessera.sources.sinks import write_csv, write_parquet
from tessera.sources.tables import delete_where, write_table


def q_csv_split_quoted(spark, sf_dir):
    """[S2, S6, K1] whole documents (line feeds and quotes inside fields) read back by byte ranges, in many tasks."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return read_many(spark, [write_csv(d, _scratch(spark), "documents")], split_quoted=True)


_SQL_CSV_SPLIT_QUOTED = f"""
SELECT doc_id, CASE WHEN text IN {_NA_SQL} THEN NULL ELSE text END AS text,
  CASE WHEN lang IN {_NA_SQL} THEN NULL ELSE lang END AS lang,
  CASE WHEN source IN {_NA_SQL} THEN NULL ELSE source END AS source, n_chars
FROM documents
"""


def q_csv_one_object(spark, sf_dir):
    """[K1, K4, S2] whole documents, written by many tasks as one CSV object and read back from it."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return read_many(spark, [write_one_csv(d.repartition(8, "doc_id"), _scratch(spark), "documents.v1.csv")], split_quoted=True)


def q_json_one_object(spark, sf_dir):
    """[K3, K4] orders, a JSON document each, written by many tasks as one object and read back from it."""
    o = table(spark, sf_dir, "orders").select(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority").alias("doc"))
    target = write_one_json_docs(o.repartition(8, "doc"), _scratch(spark), "orders.v1.dict")
    return (spark.read.text(target).select(F.from_json("value", "o_orderkey long, o_orderstatus string, o_orderpriority string").alias("d"))
            .select("d.*"))


_SQL_JSON_ONE_OBJECT = "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders"


def q_read_many_one_scan(spark, sf_dir):
    """[S6, S2] files of three headers, two of them the same columns in another order, in one plan."""
    o, base = table(spark, sf_dir, "orders"), _scratch(spark)
    paths = [write_csv(o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey"), base, "even"),
             write_csv(o.where("o_orderkey % 2 = 1").select("o_custkey", "o_orderkey"), base, "odd"),
             write_csv(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), base, "customer")]
    return read_many(spark, paths, one_scan=True)


def q_read_many_conflicts(spark, sf_dir):
    """[S6, S3] one glob over files in which a column has two types."""
    o, base = table(spark, sf_dir, "orders"), _scratch(spark)
    write_parquet(o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey"), base, "even")
    write_parquet(o.where("o_orderkey % 2 = 1").selectExpr("concat('k', o_orderkey) AS o_orderkey", "o_orderpriority"), base, "odd")
    return read_many(spark, [base + "*.parquet"])


_SQL_READ_MANY_CONFLICTS = """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'k' END || CAST(o_orderkey AS VARCHAR) AS o_orderkey,
  CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority
FROM orders
"""


def q_list_objects(spark, sf_dir):
    """[S1] objects listed by tasks: folder, number, bytes, and whether all were modified lately."""
    base = _scratch(spark)
    (table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("line"), "o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("p"))
     .write.partitionBy("p", "o_orderstatus").text(base + "orders"))
    listed = walk_files(spark, base + "orders", "p=").where("path LIKE '%.txt'")
    recent = F.col("modificationTime") > F.current_timestamp() - F.expr("INTERVAL 1 DAY")
    return listed.groupBy(F.regexp_extract("path", "p=([^/]+)/", 1).alias("p"), F.regexp_extract("path", "o_orderstatus=([^/]+)/", 1).alias("status")).agg(
        (F.count(F.lit(1)) > 0).alias("found"), F.sum("length").alias("bytes"), F.every(recent).alias("recent"))


_SQL_LIST_OBJECTS = """
SELECT substr(o_orderpriority, 1, 1) AS p, o_orderstatus AS status, true AS found,
  CAST(sum(length(CAST(o_orderkey AS VARCHAR)) + 1) AS BIGINT) AS bytes, true AS recent
FROM orders GROUP BY ALL
"""


def q_scan_row_index(spark, sf_dir):
    """[P10] rows of a Parquet scan numbered by their place in the files, from the footers."""
    return with_row_index(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"))


_SQL_SCAN_ROW_INDEX = """
SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY file_row_number) - 1 AS ColumnIndex
FROM (SELECT *, row_number() OVER () AS file_row_number FROM customer)
"""


def q_zip_scans(spark, sf_dir):
    """[J1] two scans zipped by position; the longer one's surplus is dropped."""
    return zip_rows(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "part").select("p_partkey"))


_SQL_ZIP_SCANS = """
SELECT c_custkey, p_partkey FROM (SELECT c_custkey, row_number() OVER () AS i FROM customer)
JOIN (SELECT p_partkey, row_number() OVER () AS i FROM part) USING (i)
"""


def q_check_objects_pruned(spark, sf_dir):
    """[J5] a manifest of which most objects are absent, held against a listing's Bloom filter before the join."""
    manifest = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("s3://b/"), F.col("l_orderkey").cast("string")).alias("path"))
    listing = table(spark, sf_dir, "orders").where("o_orderkey % 50 = 0").select(F.concat(F.lit("s3://b/"), F.col("o_orderkey").cast("string")).alias("path"))
    return check_objects(manifest, listing, prune_absent=True)


_SQL_CHECK_OBJECTS_PRUNED = """
SELECT l_orderkey, l_linenumber, 's3://b/' || CAST(l_orderkey AS VARCHAR) AS path,
  EXISTS (SELECT 1 FROM orders WHERE o_orderkey % 50 = 0 AND o_orderkey = l_orderkey) AS "exists"
FROM lineitem
"""


def q_delete_where_files(spark, sf_dir):
    """[K7b, F8] a delete that matches rows of few files: the others keep their names."""
    name = _new_table(spark)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    write_table(o.repartitionByRange(6, "o_orderkey"), name, partition_by=["o_orderstatus"])
    first = o.agg(F.min("o_orderkey")).first()[0]
    held = spark.table(name)
    hit = {r[0] for r in held.where(F.col("o_orderkey") < first + 40).select("_metadata.file_name").distinct().collect()}
    before = {f.rsplit("/", 1)[-1] for f in held.inputFiles()}
    delete_where(spark, name, f"o_orderkey < {first + 40} AND o_custkey % 2 = 0")
    after = {f.rsplit("/", 1)[-1] for f in spark.table(name).inputFiles()}
    return _taken(spark, name).withColumn("others_kept", F.lit(before - hit == before & after - hit and len(hit) < len(before)))


_SQL_DELETE_WHERE_FILES = """
SELECT o_orderkey, o_custkey, o_orderstatus, true AS others_kept FROM orders
WHERE NOT (o_orderkey < (SELECT min(o_orderkey) FROM orders) + 40 AND o_custkey % 2 = 0)
"""


def q_flatten_places_stray(spark, sf_dir):
    """[G2] stored responses with error objects, numbers and broken texts among them, counted and left out."""
    k = F.col("s_suppkey")
    place = F.struct(F.concat(F.lit("p"), k).alias("name"), (k % 50 / 10).alias("rating"), F.array(F.lit("cafe")).alias("types"))
    answer = (F.when(k % 7 == 0, F.lit('{"error_message": "quota"}')).when(k % 7 == 1, F.lit("{broken")).when(k % 7 == 2, F.lit("3"))
              .otherwise(F.to_json(F.array(place))))
    pts = table(spark, sf_dir, "supplier").select("s_suppkey", (k % 10).alias("la"), (k % 20).alias("lo"), answer.alias("response"))
    out = flatten_places(pts, "response", "la", "lo", vocabulary=["cafe"])
    return out.select("s_suppkey", "name", "rating", "cafe", F.lit(malformed_responses(pts, "response")).cast("long").alias("malformed"))


_SQL_FLATTEN_PLACES_STRAY = """
SELECT s_suppkey, 'p' || CAST(s_suppkey AS VARCHAR) AS name, (s_suppkey % 50) / 10 AS rating, 1 AS cafe,
  (SELECT count(*) FROM supplier WHERE s_suppkey % 7 < 3) AS malformed
FROM supplier WHERE s_suppkey % 7 > 2
"""


def q_enrich_typed(spark, sf_dir):
    """[X3, C3] a service that answers some keys with text for a number: those are failures of their rows."""
    def service(rec):
        return {"score": "none" if rec["user_id"] % 5 == 0 else rec["user_id"] * 3}

    e = table(spark, sf_dir, "events").select("event_id", "user_id")
    return (enrich(e, ["user_id"], service, T.StructType.fromDDL("score long"))
            .select("event_id", "user_id", "score", F.col("error").isNotNull().alias("failed")))


_SQL_ENRICH_TYPED = """
SELECT event_id, user_id, CASE WHEN user_id % 5 <> 0 THEN user_id * 3 END AS score, user_id % 5 = 0 AS failed FROM events
"""


def q_enrich_logged(spark, sf_dir):
    """[X3, C3] events enriched through a call log: a second run over half new users calls those only."""
    log = _scratch(spark) + "calls"
    e = table(spark, sf_dir, "events").select("event_id", "user_id")
    schema = T.StructType.fromDDL("tier string, score long")
    enrich_logged(e.where("user_id % 2 = 0"), ["user_id"], profile_service, schema, log, max_attempts=1).count()
    out = enrich_logged(e, ["user_id"], profile_service, schema, log, max_attempts=1)
    twice = spark.read.parquet(log).groupBy("user_id").count().where("count > 1").count()
    return out.withColumn("called_twice", F.lit(twice).cast("long"))


_SQL_ENRICH_LOGGED = """
SELECT event_id, user_id,
  CASE WHEN user_id % 13 <> 0 THEN 'tier' || CAST(user_id % 4 AS VARCHAR) END AS tier,
  CASE WHEN user_id % 13 <> 0 THEN (user_id * 3) % 17 END AS score,
  CASE WHEN user_id % 13 = 0 THEN 'LookupError: no profile for ' || CAST(user_id AS VARCHAR) END AS error,
  0::BIGINT AS called_twice
FROM events
"""

LATEST = {
    "csv_split_quoted": (q_csv_split_quoted, _SQL_CSV_SPLIT_QUOTED),
    "csv_one_object": (q_csv_one_object, _SQL_CSV_SPLIT_QUOTED),
    "json_one_object": (q_json_one_object, _SQL_JSON_ONE_OBJECT),
    "read_many_one_scan": (q_read_many_one_scan, _SQL_READ_MANY_CSV_HEADERS),
    "read_many_conflicts": (q_read_many_conflicts, _SQL_READ_MANY_CONFLICTS),
    "list_objects": (q_list_objects, _SQL_LIST_OBJECTS),
    "scan_row_index": (q_scan_row_index, _SQL_SCAN_ROW_INDEX),
    "zip_scans": (q_zip_scans, _SQL_ZIP_SCANS),
    "check_objects_pruned": (q_check_objects_pruned, _SQL_CHECK_OBJECTS_PRUNED),
    "delete_where_files": (q_delete_where_files, _SQL_DELETE_WHERE_FILES),
    "flatten_places_stray": (q_flatten_places_stray, _SQL_FLATTEN_PLACES_STRAY),
    "enrich_typed": (q_enrich_typed, _SQL_ENRICH_TYPED),
    "enrich_logged": (q_enrich_logged, _SQL_ENRICH_LOGGED),
}
