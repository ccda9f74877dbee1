"""Registered queries over the driver tables and their DuckDB oracle SQL.

Each query reads whole tables from ``sf_dir`` and exercises one or more
operator ids from the design (ids in brackets). The driver tables hold no
coordinates, paths or NULLs, so those are derived with integer arithmetic
that both engines evaluate identically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.geohash import ALPHABET, geo_decode, geo_encode
from tessera.functions.nested import json_field, parse_doc
from tessera.functions.paths import file_format, join_path, location_text, object_stem, parse_object_path, path_levels
from tessera.operators.enrich import enrich
from tessera.operators.geojoin import places_nearby, reverse_geocode
from tessera.operators.inventory import check_objects, crawl_size
from tessera.operators.responses import flatten_geocode, flatten_places
from tessera.operators.reshape import (array_vocabulary, explode_ranked, multi_hot, union_all_by_name,
                                       with_row_index, zip_rows)
from tessera.session import cut_lineage, scratch_path
from tessera.sources.files import DEFAULT_NA, list_files, read_json_docs, read_lines, read_many
from tessera.sources.sinks import write_csv, write_docs_apart, write_json_docs, write_parquet
from tessera.sources.sheets import full_refresh, pack_sheets, prepare_full_refresh, sheet_to_table
from tessera.sources.tables import delete_where, drop_table, keep_unless, run_statement, sql_query, truncate_table, write_table
from tessera.streaming.ingest import parquet_batches, stream_files, write_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- geohash

def _customer_points(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    lat = (k * 7919 * 1009) % 180000000 - 90000000
    lon = (k * 104729 * 313) % 360000000 - 180000000
    missing = (k % 10) == 3
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(~missing, lat / 1e6).alias("lat"),
        F.when(~missing, lon / 1e6).alias("long"),
    )


def q_geo_encode(spark, sf_dir):
    """[P4, P5] geohash of derived customer coordinates, 23 characters."""
    return geo_encode(_customer_points(spark, sf_dir), "lat", "long", precision=23)


def q_geo_decode(spark, sf_dir):
    """[P6] decode the 23-character codes back to FLOAT cell centres."""
    return geo_decode(q_geo_encode(spark, sf_dir), "GeoHash")


_SQL_POINTS = """
  SELECT c_custkey,
         CAST(CASE WHEN c_custkey % 10 = 3 THEN NULL
                   ELSE ((c_custkey * 7919 * 1009) % 180000000 - 90000000) / 1e6 END AS DECIMAL(10,6)) AS lat,
         CAST(CASE WHEN c_custkey % 10 = 3 THEN NULL
                   ELSE ((c_custkey * 104729 * 313) % 360000000 - 180000000) / 1e6 END AS DECIMAL(10,6)) AS long
  FROM customer
"""


def _sql_encode(precision: int = 23) -> str:
    # Independent of the Spark recipe: whole-integer bisection in HUGEINT,
    # then bits picked out by shifts (lon on even, lat on odd positions).
    lat_bits, lon_bits = (5 * precision) // 2, (5 * precision + 1) // 2

    def bit(t):
        if t % 2 == 0:
            return f"((lo >> {lon_bits - 1 - t // 2}) & 1)"
        return f"((la >> {lat_bits - 1 - t // 2}) & 1)"

    chars = []
    for i in range(precision):
        v = " + ".join(f"({bit(5 * i + m)} << {4 - m})" for m in range(5))
        chars.append(f"substr('{ALPHABET}', CAST(1 + {v} AS INTEGER), 1)")
    return f"""
WITH pts AS ({_SQL_POINTS}),
bits AS (
  SELECT *,
    CAST(CAST(lat * 1000000 AS BIGINT) + 90000000 AS HUGEINT) * {1 << lat_bits} // 180000000 AS la,
    CAST(CAST(long * 1000000 AS BIGINT) + 180000000 AS HUGEINT) * {1 << lon_bits} // 360000000 AS lo
  FROM pts)
SELECT c_custkey, lat, long,
  CASE WHEN lat IS NULL OR long IS NULL THEN 'unknown' ELSE concat({", ".join(chars)}) END AS GeoHash
FROM bits
"""


def _sql_decode() -> str:
    n = 23
    total = 5 * n
    lat_bits, lon_bits = total // 2, (total + 1) // 2
    v = " + ".join(
        f"(CAST(instr('{ALPHABET}', substr(GeoHash, {i + 1}, 1)) - 1 AS HUGEINT) << {5 * (n - 1 - i)})"
        for i in range(n))
    la = " | ".join(f"(((v >> {total - 2 - 2 * j}) & 1) << {lat_bits - 1 - j})" for j in range(lat_bits))
    lo = " | ".join(f"(((v >> {total - 1 - 2 * j}) & 1) << {lon_bits - 1 - j})" for j in range(lon_bits))
    d = "CAST({} AS DOUBLE)"
    lat_lo_shift, lon_lo_shift = lat_bits - 30, lon_bits - 30
    lat = (f"(-90.0::DOUBLE + 180.0::DOUBLE * {d.format(f'la >> {lat_lo_shift}')} / {d.format(1 << 30)})"
           f" + 180.0::DOUBLE * {d.format(f'(la & {(1 << lat_lo_shift) - 1}) << {30 - lat_lo_shift}')} / {d.format(1 << 60)}"
           f" + 90.0::DOUBLE / {d.format(1 << lat_bits)}")
    lon = (f"(-180.0::DOUBLE + 360.0::DOUBLE * {d.format(f'lo >> {lon_lo_shift}')} / {d.format(1 << 30)})"
           f" + 360.0::DOUBLE * {d.format(f'(lo & {(1 << lon_lo_shift) - 1}) << {30 - lon_lo_shift}')} / {d.format(1 << 60)}"
           f" + 180.0::DOUBLE / {d.format(1 << lon_bits)}")
    return f"""
WITH enc AS ({_sql_encode(n)}),
iv AS (SELECT *, CASE WHEN GeoHash = 'unknown' THEN NULL ELSE {v} END AS v FROM enc),
ax AS (SELECT *, {la} AS la, {lo} AS lo FROM iv)
SELECT c_custkey, lat, long, GeoHash,
  CAST({lat} AS FLOAT) AS Latitude, CAST({lon} AS FLOAT) AS Longitude
FROM ax
"""



# ------------------------------------------------------------------ paths

def _page_objects(spark, sf_dir) -> DataFrame:
    """pages as object paths: https urls become s3:// paths, http urls bare
    ``bucket/key`` paths; size is the html length, 0 for every ninth page."""
    url = F.col("url")
    obj = (F.when(url.startswith("https://"), F.concat(F.lit("s3://"), F.substr(url, F.lit(9))))
           .otherwise(F.substr(url, F.lit(8))))
    size = F.when(F.col("page_id") % 9 == 0, F.lit(0)).otherwise(F.length("html"))
    return table(spark, sf_dir, "pages").select("page_id", obj.alias("object"), size.alias("length"))


_SQL_PAGE_OBJECTS = """
  SELECT page_id,
         CASE WHEN url LIKE 'https://%' THEN 's3://' || substr(url, 9) ELSE substr(url, 8) END AS object,
         CAST(CASE WHEN page_id % 9 = 0 THEN 0 ELSE length(html) END AS INTEGER) AS length
  FROM pages
"""


def q_parse_path(spark, sf_dir):
    """[P1] split object paths into bucket and key."""
    o = _page_objects(spark, sf_dir)
    p = parse_object_path("object")
    return o.select("page_id", "object", p["bucket"].alias("bucket"), p["key"].alias("key"))


_SQL_PARSE_PATH = f"""
WITH o AS ({_SQL_PAGE_OBJECTS}),
r AS (SELECT *, CASE WHEN object LIKE 's3://%' THEN substr(object, 6) ELSE object END AS rest FROM o)
SELECT page_id, object,
  CASE WHEN strpos(rest, '/') > 0 THEN split_part(rest, '/', 1) END AS bucket,
  CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/') + 1) END AS key
FROM r
"""


def _bucket_keys(spark, sf_dir) -> DataFrame:
    o = _page_objects(spark, sf_dir)
    return o.select("page_id", parse_object_path("object")["key"].alias("path"), "length")


def q_path_levels(spark, sf_dir):
    """[P2, P3] keys split into levels and joined back."""
    k = q_parse_path(spark, sf_dir)
    lv = path_levels("key")
    return k.select("page_id", F.size(lv).alias("n_levels"), F.get(lv, 0).alias("first_level"),
                    F.element_at(lv, -1).alias("last_level"), join_path(lv).alias("rejoined"))


_SQL_PATH_LEVELS = f"""
WITH k AS ({_SQL_PARSE_PATH}), l AS (SELECT page_id, string_split(key, '/') AS lv FROM k)
SELECT page_id, CAST(len(lv) AS INTEGER) AS n_levels, lv[1] AS first_level, lv[-1] AS last_level,
       array_to_string(lv, '/') AS rejoined
FROM l
"""


def q_crawl_size(spark, sf_dir):
    """[C1, C2, F3] size inventory by level; depth found by a small job."""
    levels_df, _ = crawl_size(_bucket_keys(spark, sf_dir), "path", "length")
    return levels_df


_SQL_CRAWL_SIZE = f"""
WITH k AS ({_SQL_PARSE_PATH}),
l AS (SELECT string_split(key, '/') AS lv, length FROM k JOIN ({_SQL_PAGE_OBJECTS}) o USING (page_id, object))
SELECT lv[1] AS "Level 0", lv[2] AS "Level 1", lv[3] AS "Level 2", length AS "Size"
FROM l WHERE length > 0
"""


def q_crawl_paths(spark, sf_dir):
    """[C1] the second output: every path, empty objects included."""
    _, paths_df = crawl_size(_bucket_keys(spark, sf_dir), "path", "length", levels=0)
    return paths_df


_SQL_CRAWL_PATHS = f"""
WITH k AS ({_SQL_PARSE_PATH}) SELECT key AS path FROM k
"""


def _document_objects(spark, sf_dir) -> DataFrame:
    sfx = F.element_at(F.array(*[F.lit(x) for x in _NAME_SUFFIXES]), (F.col("doc_id") % len(_NAME_SUFFIXES) + 1).cast("int"))
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit("."), F.col("lang"), sfx)
    return table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", "source", name).alias("object"),
                                                   name.alias("name"))


_NAME_SUFFIXES = [".csv", ".parquet", ".pq", ".parquet.snappy", ".dict", ".txt", ".json.gz", ""]
_SQL_DOCUMENT_OBJECTS = f"""
  SELECT doc_id, source || '/' || nm AS object, nm AS name FROM (
    SELECT doc_id, source, 'doc_' || CAST(doc_id AS VARCHAR) || '.' || lang ||
      ({"[" + ", ".join(repr(x) for x in _NAME_SUFFIXES) + "]"})[doc_id % {len(_NAME_SUFFIXES)} + 1] AS nm
    FROM documents)
"""


def q_object_stem(spark, sf_dir):
    """[K4] output-name stem: text before the first dot."""
    return _document_objects(spark, sf_dir).select("doc_id", "name", object_stem("name").alias("stem"))


_SQL_OBJECT_STEM = f"""
SELECT doc_id, name, split_part(name, '.', 1) AS stem FROM ({_SQL_DOCUMENT_OBJECTS})
"""


def q_file_format(spark, sf_dir):
    """[P14, F2] reader format by suffix."""
    return _document_objects(spark, sf_dir).select("doc_id", "object", file_format("object").alias("format"))


_SQL_FILE_FORMAT = f"""
SELECT doc_id, object,
  CASE WHEN object LIKE '%.csv' THEN 'csv'
       WHEN object LIKE '%.parquet' OR object LIKE '%.pq' OR object LIKE '%.parquet.snappy' THEN 'parquet'
       WHEN object LIKE '%.dict' THEN 'json'
       WHEN object LIKE '%.txt' THEN 'text' END AS format
FROM ({_SQL_DOCUMENT_OBJECTS})
"""


def q_check_objects(spark, sf_dir):
    """[J5] does each document's object exist in the (labels) listing?"""
    path = lambda c: F.concat(F.lit("docs/"), F.col(c).cast("string"), F.lit(".txt")).alias("path")
    manifest = table(spark, sf_dir, "documents").select(path("doc_id"))
    listing = table(spark, sf_dir, "labels").select(path("doc_id"))
    return check_objects(manifest, listing)


def q_check_objects_schemes(spark, sf_dir):
    """[J5, P1] existence across schemes: s3:// manifest paths against an
    s3a:// listing."""
    manifest = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("s3://corpus/docs/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"))
    listing = table(spark, sf_dir, "labels").select(
        F.concat(F.lit("s3a://corpus/docs/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"))
    return check_objects(manifest, listing, ignore_scheme=True)


_SQL_CHECK_OBJECTS_SCHEMES = """
SELECT m.path, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = m.doc_id) AS "exists"
FROM (SELECT doc_id, 's3://corpus/docs/' || CAST(doc_id AS VARCHAR) || '.txt' AS path FROM documents) m
"""

_SQL_CHECK_OBJECTS = """
SELECT m.path, EXISTS (SELECT 1 FROM labels l WHERE 'docs/' || CAST(l.doc_id AS VARCHAR) || '.txt' = m.path) AS "exists"
FROM (SELECT 'docs/' || CAST(doc_id AS VARCHAR) || '.txt' AS path FROM documents) m
"""


# ---------------------------------------------------------------- reshape

_EVENT_LABELS = ["click", "error", "purchase", "signup", "view"]


def _user_types(spark, sf_dir) -> DataFrame:
    return (table(spark, sf_dir, "events").groupBy("user_id")
            .agg(F.collect_set("event_type").alias("types")))


def q_multi_hot(spark, sf_dir):
    """[A3, F9] 0/1 columns per event type for each user."""
    return multi_hot(_user_types(spark, sf_dir), "types", vocabulary=_EVENT_LABELS)


_SQL_MULTI_HOT = "SELECT user_id, " + ", ".join(
    f"CAST(list_contains(types, '{v}') AS INTEGER) AS {v}" for v in _EVENT_LABELS) + """
FROM (SELECT user_id, list(DISTINCT event_type) AS types FROM events GROUP BY user_id)
"""


def q_array_vocabulary(spark, sf_dir):
    """[A2, U3] distinct labels across all users' type arrays."""
    return array_vocabulary(_user_types(spark, sf_dir), "types", "label")


_SQL_ARRAY_VOCABULARY = "SELECT DISTINCT event_type AS label FROM events"


def q_explode_ranked(spark, sf_dir):
    """[A1, L1] every word of every document with its 0-based rank."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ", -1).alias("token"))
    return explode_ranked(d, "token", rank="token_rank")


_SQL_EXPLODE_RANKED = """
SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS token_rank, unnest(w) AS token
FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)
"""


def q_json_flatten(spark, sf_dir):
    """[A4, P7] a typed field out of the JSON props of every event."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "event_type", json_field(parse_doc("props"), "$.k", "int").alias("k"))


_SQL_JSON_FLATTEN = "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"


def q_read_many(spark, sf_dir):
    """[S6, S3, U1, U2] customer and supplier files read as one frame by name."""
    return read_many(spark, [f"{sf_dir}/customer.parquet", f"{sf_dir}/supplier.parquet"])


_SQL_READ_MANY = "SELECT * FROM customer UNION ALL BY NAME SELECT * FROM supplier"


def q_union_by_name(spark, sf_dir):
    """[U1, U2, J2] two projections of orders with different columns."""
    o = table(spark, sf_dir, "orders")
    a = o.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")
    b = o.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return union_all_by_name([a, b])


_SQL_UNION_BY_NAME = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL BY NAME
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
"""


def q_with_row_index(spark, sf_dir):
    """[P10] dense 0-based index of suppliers by (nation, key)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_name")
    return with_row_index(s, "ColumnIndex", ["s_nationkey", "s_suppkey"])


_SQL_WITH_ROW_INDEX = """
SELECT s_suppkey, s_nationkey, s_name, row_number() OVER (ORDER BY s_nationkey, s_suppkey) - 1 AS ColumnIndex
FROM supplier
"""


def q_zip_rows(spark, sf_dir):
    """[J1] positional zip: suppliers ascending paired with suppliers descending."""
    s = table(spark, sf_dir, "supplier")
    a = s.select("s_suppkey", "s_name")
    b = s.select(F.col("s_suppkey").alias("b_suppkey"), F.col("s_nationkey").alias("b_nationkey"))
    return zip_rows(a, b, ["s_suppkey"], [F.col("b_suppkey").desc()])


_SQL_ZIP_ROWS = """
SELECT a.s_suppkey, a.s_name, b.b_suppkey, b.b_nationkey
FROM (SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_suppkey) AS i FROM supplier) a
JOIN (SELECT s_suppkey AS b_suppkey, s_nationkey AS b_nationkey,
             row_number() OVER (ORDER BY s_suppkey DESC) AS i FROM supplier) b USING (i)
"""


# ----------------------------------------------------------------- sheets

_SHEET_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


def q_sheet_to_table(spark, sf_dir):
    """[S8, A6] customers packed into sheets of <= 1000 rows, then unpacked."""
    c = table(spark, sf_dir, "customer")
    sheets = pack_sheets(c, F.call_function("div", F.col("c_custkey"), F.lit(1000)), "c_custkey", _SHEET_COLUMNS)
    return sheet_to_table(sheets, "sheet", keep=["sheet_id"])


_SQL_SHEET_TO_TABLE = """
SELECT c_custkey // 1000 AS sheet_id,
       CAST(row_number() OVER (PARTITION BY c_custkey // 1000 ORDER BY c_custkey) - 1 AS INTEGER) AS row_index,
       CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
FROM customer
"""


def q_full_refresh(spark, sf_dir):
    """[K8, O1] customer rows as text, ascending by the typed key."""
    c = table(spark, sf_dir, "customer").select(*_SHEET_COLUMNS)
    return prepare_full_refresh(c, "c_custkey")


_SQL_FULL_REFRESH = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
FROM customer ORDER BY customer.c_custkey
"""


# ----------------------------------------------------------------- tables

_DELETE_PREDICATE = ("o_orderstatus = 'F' AND "
                     "(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END) > 100000")


def q_delete_where(spark, sf_dir):
    """[K7b, F8] rows a DELETE leaves; NULL-predicate rows are kept."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return keep_unless(o, _DELETE_PREDICATE)


_SQL_DELETE_WHERE = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
WHERE NOT coalesce({_DELETE_PREDICATE}, false)
"""

_SQL_REVENUE = """
SELECT n_name, r_name, count(*) AS n_lines,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue
FROM customer
JOIN orders ON c_custkey = o_custkey
JOIN lineitem ON l_orderkey = o_orderkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
GROUP BY n_name, r_name
"""


def q_sql_query(spark, sf_dir):
    """[S7c] SQL text over catalog views: revenue by nation and region."""
    views = {t: table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem", "nation", "region")}
    return sql_query(spark, _SQL_REVENUE, views=views)


# ------------------------------------------------------------- geo joins

def _near_points(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        (F.lit(40) + ((k * 7919) % 10007) * F.lit(1e-6)).alias("lat"),
        (F.lit(-75) + ((k * 104729) % 10009) * F.lit(1e-6)).alias("long"))


def _near_places(spark, sf_dir, name, key, lat_name, lon_name) -> DataFrame:
    k = F.col(key)
    return table(spark, sf_dir, name).select(
        key,
        (F.lit(40) + ((k * 6007) % 10007) * F.lit(1e-6)).alias(lat_name),
        (F.lit(-75) + ((k * 9001) % 10009) * F.lit(1e-6)).alias(lon_name))


def q_places_nearby(spark, sf_dir):
    """[J4] parts within 25 m of each customer point."""
    pts = _near_points(spark, sf_dir)
    places = _near_places(spark, sf_dir, "part", "p_partkey", "places_lat", "places_long")
    return places_nearby(pts, places, "lat", "long", 25.0).select("c_custkey", "p_partkey")


def q_reverse_geocode(spark, sf_dir):
    """[J3, L1] the 3 nearest suppliers within 100 m of each customer point."""
    pts = _near_points(spark, sf_dir)
    addr = _near_places(spark, sf_dir, "supplier", "s_suppkey", "gmaps_lat", "gmaps_long")
    return (reverse_geocode(pts, addr, "lat", "long", "s_suppkey", k=3, max_m=100.0, point_key="c_custkey")
            .select("c_custkey", "s_suppkey", "address_rank"))


def q_reverse_geocode_outward(spark, sf_dir):
    """[J3, L1] the 2 nearest suppliers within 2 km, searched outward from 10 m."""
    pts = _near_points(spark, sf_dir)
    addr = _near_places(spark, sf_dir, "supplier", "s_suppkey", "gmaps_lat", "gmaps_long")
    return (reverse_geocode(pts, addr, "lat", "long", "s_suppkey", k=2, max_m=2000.0, point_key="c_custkey",
                            start_m=10.0)
            .select("c_custkey", "s_suppkey", "address_rank"))


_SQL_NEAR_POINTS = """SELECT c_custkey, 40 + ((c_custkey * 7919) % 10007) * CAST(1e-6 AS DOUBLE) AS lat,
       -75 + ((c_custkey * 104729) % 10009) * CAST(1e-6 AS DOUBLE) AS lon FROM customer"""


def _sql_near_places(name, key):
    return (f"SELECT {key}, 40 + (({key} * 6007) % 10007) * CAST(1e-6 AS DOUBLE) AS plat, "
            f"-75 + (({key} * 9001) % 10009) * CAST(1e-6 AS DOUBLE) AS plon FROM {name}")


_SQL_HAVERSINE = ("2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin((radians(plat) - radians(lat)) / 2), 2) + "
                  "cos(radians(lat)) * cos(radians(plat)) * pow(sin((radians(plon) - radians(lon)) / 2), 2))))")

_SQL_PLACES_NEARBY = f"""
SELECT c_custkey, p_partkey FROM ({_SQL_NEAR_POINTS}) p, ({_sql_near_places("part", "p_partkey")}) q
WHERE {_SQL_HAVERSINE} <= 25
"""

_SQL_REVERSE_GEOCODE_OUTWARD = f"""
SELECT c_custkey, s_suppkey, address_rank FROM (
  SELECT c_custkey, s_suppkey,
         CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) - 1 AS INTEGER) AS address_rank
  FROM (SELECT c_custkey, s_suppkey, {_SQL_HAVERSINE} AS d
        FROM ({_SQL_NEAR_POINTS}) p, ({_sql_near_places("supplier", "s_suppkey")}) q)
  WHERE d <= 2000)
WHERE address_rank < 2
"""

_SQL_REVERSE_GEOCODE = f"""
SELECT c_custkey, s_suppkey, address_rank FROM (
  SELECT c_custkey, s_suppkey,
         CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) - 1 AS INTEGER) AS address_rank
  FROM (SELECT c_custkey, s_suppkey, {_SQL_HAVERSINE} AS d
        FROM ({_SQL_NEAR_POINTS}) p, ({_sql_near_places("supplier", "s_suppkey")}) q)
  WHERE d <= 100)
WHERE address_rank < 3
"""


# -------------------------------------------------------------- responses

_PLACE_LABELS = ["economy", "large", "medium", "promo", "small", "standard", "first", "other"]
_ADDRESS_LABELS = ["premise", "route", "street_address"]


def _point_of(k):
    return ((F.lit(40) + ((k * 7919) % 10007) * F.lit(1e-6)).alias("lat"),
            (F.lit(-75) + ((k * 104729) % 10009) * F.lit(1e-6)).alias("long"))


def _location(k, i, step):
    return F.struct(F.struct(
        (F.lit(40) + ((k * 6007 + i * step) % 10007) * F.lit(1e-6)).alias("lat"),
        (F.lit(-75) + ((k * 9001 + i * step) % 10009) * F.lit(1e-6)).alias("lng")).alias("location"))


def q_flatten_places(spark, sf_dir):
    """[G2, U2, P7, P8, A3] stored nearby-place responses (1-3 records per
    part, some without plus code or types) flattened to one row per place."""
    k = F.col("p_partkey")

    def rec(i):
        return F.struct(
            F.concat(F.col("p_name"), F.lit(" #"), i.cast("string")).alias("name"),
            _location(k, i, 1).alias("geometry"),
            F.when((k + i) % 4 != 0, F.struct(
                F.concat(F.lit("C"), k.cast("string"), F.lit("-"), i.cast("string")).alias("compound_code"),
                F.concat(F.lit("G"), F.col("p_brand")).alias("global_code"))).alias("plus_code"),
            F.when((k + i) % 5 != 0, F.array(F.lower(F.col("p_type")),
                                             F.when(i == 0, F.lit("first")).otherwise(F.lit("other")))).alias("types"),
            F.lit("icon.png").alias("icon"), F.lit(None).cast("string").alias("photos"),
            F.lit(None).cast("string").alias("opening_hours"))

    resp = F.transform(F.sequence(F.lit(0), (F.col("p_size") % 3).cast("int")), rec)
    parts = table(spark, sf_dir, "part").select("p_partkey", *_point_of(k), resp.alias("response"))
    return flatten_places(parts, "response", "lat", "long", vocabulary=_PLACE_LABELS)


_SQL_FLATTEN_PLACES = """
WITH x AS (SELECT *, unnest(range(0, p_size % 3 + 1)) AS i FROM part)
SELECT p_partkey,
  40 + ((p_partkey * 7919) % 10007) * CAST(1e-6 AS DOUBLE) AS centroid_lat,
  -75 + ((p_partkey * 104729) % 10009) * CAST(1e-6 AS DOUBLE) AS centroid_long,
  p_name || ' #' || CAST(i AS VARCHAR) AS name,
  CASE WHEN (p_partkey + i) % 4 <> 0 THEN 'C' || CAST(p_partkey AS VARCHAR) || '-' || CAST(i AS VARCHAR) END AS compound_code,
  CASE WHEN (p_partkey + i) % 4 <> 0 THEN 'G' || p_brand END AS global_code,
  40 + ((p_partkey * 6007 + i) % 10007) * CAST(1e-6 AS DOUBLE) AS places_lat,
  -75 + ((p_partkey * 9001 + i) % 10009) * CAST(1e-6 AS DOUBLE) AS places_long,
""" + ",\n".join(
    f"  CAST((p_partkey + i) % 5 <> 0 AND lower(p_type) = '{v}' AS INTEGER) AS {v}" for v in _PLACE_LABELS[:6]) + """,
  CAST((p_partkey + i) % 5 <> 0 AND i = 0 AS INTEGER) AS first,
  CAST((p_partkey + i) % 5 <> 0 AND i <> 0 AS INTEGER) AS other
FROM x
"""


def q_flatten_geocode(spark, sf_dir):
    """[G1, A1, L1, P7, P8, A3] stored reverse-geocode responses (1-2 ranked
    addresses per supplier) flattened with their 0-based rank."""
    k = F.col("s_suppkey")

    def rec(i):
        return F.struct(
            F.concat(F.col("s_name"), F.lit(" addr "), i.cast("string")).alias("formatted_address"),
            F.concat(F.lit("P"), k.cast("string"), F.lit("-"), i.cast("string")).alias("place_id"),
            F.when((k + i) % 3 != 0, F.struct(
                F.concat(F.lit("C"), k.cast("string")).alias("compound_code"),
                F.concat(F.lit("G"), i.cast("string")).alias("global_code"))).alias("plus_code"),
            _location(k, i, 7).alias("geometry"),
            F.concat(F.lit('["'), F.col("s_name"), F.lit('"]')).alias("address_components"),
            F.when((k + i) % 4 != 0, F.array(F.lit("street_address"),
                                             F.when(i == 0, F.lit("premise")).otherwise(F.lit("route")))).alias("types"))

    resp = F.transform(F.sequence(F.lit(0), (F.col("s_nationkey") % 2).cast("int")), rec)
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", *_point_of(k), resp.alias("response"))
    return flatten_geocode(sup, "response", vocabulary=_ADDRESS_LABELS)


_SQL_FLATTEN_GEOCODE = """
WITH x AS (SELECT *, unnest(range(0, s_nationkey % 2 + 1)) AS i FROM supplier)
SELECT s_suppkey,
  40 + ((s_suppkey * 7919) % 10007) * CAST(1e-6 AS DOUBLE) AS lat,
  -75 + ((s_suppkey * 104729) % 10009) * CAST(1e-6 AS DOUBLE) AS long,
  CAST(i AS INTEGER) AS address_rank,
  s_name || ' addr ' || CAST(i AS VARCHAR) AS formatted_address,
  'P' || CAST(s_suppkey AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS place_id,
  CASE WHEN (s_suppkey + i) % 3 <> 0 THEN 'C' || CAST(s_suppkey AS VARCHAR) END AS compound_code,
  CASE WHEN (s_suppkey + i) % 3 <> 0 THEN 'G' || CAST(i AS VARCHAR) END AS global_code,
  40 + ((s_suppkey * 6007 + i * 7) % 10007) * CAST(1e-6 AS DOUBLE) AS gmaps_lat,
  -75 + ((s_suppkey * 9001 + i * 7) % 10009) * CAST(1e-6 AS DOUBLE) AS gmaps_long,
  CAST((s_suppkey + i) % 4 <> 0 AND i = 0 AS INTEGER) AS premise,
  CAST((s_suppkey + i) % 4 <> 0 AND i <> 0 AS INTEGER) AS route,
  CAST((s_suppkey + i) % 4 <> 0 AS INTEGER) AS street_address
FROM x
"""


# ----------------------------------------------------------------- enrich

def profile_service(rec: dict) -> dict:
    """Deterministic stand-in for an outside per-key service; fails for
    every 13th user so failures are exercised."""
    uid = rec["user_id"]
    if uid % 13 == 0:
        raise LookupError(f"no profile for {uid}")
    return {"tier": f"tier{uid % 4}", "score": (uid * 3) % 17}


_PROFILE_SCHEMA = "tier string, score long"


def q_enrich_lookup(spark, sf_dir):
    """[X3, C3] events enriched by one service call per distinct user."""
    from pyspark.sql import types as T
    e = table(spark, sf_dir, "events").select("event_id", "user_id")
    schema = T.StructType.fromDDL(_PROFILE_SCHEMA)
    return enrich(e, ["user_id"], profile_service, schema)


_SQL_ENRICH_LOOKUP = """
SELECT event_id, user_id,
  CASE WHEN user_id % 13 <> 0 THEN 'tier' || CAST(user_id % 4 AS VARCHAR) END AS tier,
  CASE WHEN user_id % 13 <> 0 THEN (user_id * 3) % 17 END AS score,
  CASE WHEN user_id % 13 = 0 THEN 'LookupError: no profile for ' || CAST(user_id AS VARCHAR) END AS error
FROM events
"""


# ------------------------------------------------------------- round trips

def _scratch(spark) -> str:
    return scratch_path(spark, "roundtrip") + "/"


def q_csv_round_trip(spark, sf_dir):
    """[K1, K4, S2, S6] whole documents (newlines, quotes) written as CSV and
    read back by header group with NA tokens and one-pass typing."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    target = write_csv(d, _scratch(spark), "documents.v1.xlsx")
    return read_many(spark, [target])


_NA_SQL = "(" + ", ".join("'" + t.replace("'", "''") + "'" for t in DEFAULT_NA) + ")"
_SQL_CSV_ROUND_TRIP = f"""
SELECT doc_id,
  CASE WHEN text IN {_NA_SQL} THEN NULL ELSE text END AS text,
  CASE WHEN lang IN {_NA_SQL} THEN NULL ELSE lang END AS lang,
  CASE WHEN source IN {_NA_SQL} THEN NULL ELSE source END AS source,
  n_chars
FROM documents
"""


def q_parquet_round_trip(spark, sf_dir):
    """[K2, K4, S3, S6] orders written as Parquet and read back by suffix."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderpriority")
    target = write_parquet(o, _scratch(spark), "orders.2024.parquet")
    return read_many(spark, [target])


_SQL_PARQUET_ROUND_TRIP = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
"""


def q_json_round_trip(spark, sf_dir):
    """[K3, A5, S4, A4] events as nested JSON documents, written and read back."""
    e = table(spark, sf_dir, "events")
    doc = F.struct("event_id", "user_id", "event_type", "value", F.from_json("props", "k int").alias("props"))
    target = write_json_docs(e.select(doc.alias("doc")), _scratch(spark), "events")
    back = read_json_docs(spark, target, one_per_file=False)
    return back.select(json_field("doc", "$.event_id", "bigint").alias("event_id"),
                       json_field("doc", "$.user_id", "bigint").alias("user_id"),
                       json_field("doc", "$.event_type", "string").alias("event_type"),
                       json_field("doc", "$.value", "double").alias("value"),
                       json_field("doc", "$.props.k", "int").alias("k"))


_SQL_JSON_ROUND_TRIP = """
SELECT event_id, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
"""


def q_lines_round_trip(spark, sf_dir):
    """[S5] whole document texts stored as a .txt object, read back as lines."""
    target = _scratch(spark) + "documents.txt"
    table(spark, sf_dir, "documents").select("text").write.mode("overwrite").text(target)
    return read_lines(spark, target)


_SQL_LINES_ROUND_TRIP = "SELECT unnest(string_split(text, chr(10))) AS value FROM documents"


# -------------------------------------------------------------- streaming

def q_stream_geo_encode(spark, sf_dir):
    """[S1, P5, streaming] the customer object ingested as a file stream
    (available-now trigger), geohash-encoded per micro-batch, written by an
    idempotent batch sink and read back."""
    schema = table(spark, sf_dir, "customer").schema
    stream = stream_files(spark, sf_dir, "parquet", schema, prefix="customer")
    k = F.col("c_custkey")
    pts = stream.select(
        "c_custkey",
        F.when(k % 10 != 3, ((k * 7919 * 1009) % 180000000 - 90000000) / 1e6).alias("lat"),
        F.when(k % 10 != 3, ((k * 104729 * 313) % 360000000 - 180000000) / 1e6).alias("long"))
    base = scratch_path(spark, "stream")
    q = write_batches(geo_encode(pts, "lat", "long", 23), parquet_batches(base + "/out"),
                      base + "/checkpoint", trigger_once=True)
    q.awaitTermination()
    return spark.read.parquet(base + "/out/batch=*")


# ------------------------------------------- readers of several files, types

def q_read_many_csv_headers(spark, sf_dir):
    """[S6, S2] files of three headers, two of them the same columns in another order."""
    o, base = table(spark, sf_dir, "orders"), _scratch(spark)
    paths = [write_csv(o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey"), base, "even"),
             write_csv(o.where("o_orderkey % 2 = 1").select("o_custkey", "o_orderkey"), base, "odd"),
             write_csv(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), base, "customer")]
    return read_many(spark, paths)


_SQL_READ_MANY_CSV_HEADERS = """
SELECT o_orderkey, o_custkey, NULL AS c_custkey, NULL AS c_mktsegment FROM orders
UNION ALL SELECT NULL, NULL, c_custkey, c_mktsegment FROM customer
"""


def q_read_many_parquet_glob(spark, sf_dir):
    """[S6, S3] two schemas under one glob."""
    o, base = table(spark, sf_dir, "orders"), _scratch(spark)
    write_parquet(o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey"), base, "even")
    write_parquet(o.where("o_orderkey % 2 = 1").select("o_orderkey", "o_orderpriority"), base, "odd")
    return read_many(spark, [base + "*.parquet"])


_SQL_READ_MANY_PARQUET_GLOB = """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority
FROM orders
"""


def q_json_documents(spark, sf_dir):
    """[S4, A4] one document of several lines in each file."""
    target = _scratch(spark) + "supplier.dict"
    doc = F.to_json(F.struct("s_suppkey", F.struct("s_name", "s_nationkey").alias("s")), {"pretty": "true"})
    write_docs_apart(table(spark, sf_dir, "supplier").select(doc.alias("value")), target)
    docs = read_json_docs(spark, target)
    return docs.select(json_field("doc", "$.s_suppkey", "bigint").alias("s_suppkey"),
                       json_field("doc", "$.s.s_name", "string").alias("s_name"),
                       json_field("doc", "$.s.s_nationkey", "int").alias("s_nationkey"))


_SQL_JSON_DOCUMENTS = "SELECT s_suppkey, s_name, s_nationkey FROM supplier"


def q_union_types(spark, sf_dir):
    """[U1, U2, J2] decimals of two widths, arrays, a column of nulls, names of another case."""
    o = table(spark, sf_dir, "orders")
    a = o.where("o_orderkey % 2 = 0").selectExpr("o_orderkey AS ID", "CAST(o_totalprice AS DECIMAL(19,2)) AS price", "NULL AS cust",
                                                 "array(o_orderstatus, 'x') AS tags")
    b = o.where("o_orderkey % 2 = 1").selectExpr("o_orderkey AS id", "CAST(o_totalprice AS DECIMAL(20,2)) AS price", "o_custkey AS cust",
                                                 "array(o_orderstatus, CAST(NULL AS STRING)) AS tags")
    return union_all_by_name([a, b]).select("ID", F.col("price").cast("string").alias("price"), "cust",
                                            F.array_join("tags", "+", "-").alias("tags"))


_SQL_UNION_TYPES = """
SELECT o_orderkey AS ID, CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS VARCHAR) AS price,
  CASE WHEN o_orderkey % 2 = 1 THEN o_custkey END AS cust,
  o_orderstatus || CASE WHEN o_orderkey % 2 = 0 THEN '+x' ELSE '+-' END AS tags
FROM orders
"""


def q_list_prefix(spark, sf_dir):
    """[S1] objects by a string prefix of their key."""
    base = _scratch(spark)
    table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").write.partitionBy(
        "o_orderpriority", "o_orderstatus").parquet(base + "orders")
    listed = list_files(spark, base + "orders", "o_orderpriority=1").where("path LIKE '%.parquet'")
    return (listed.select(F.regexp_extract(F.url_decode("path"), "(o_orderpriority=[^/]+)/", 1).alias("priority"),
                          F.regexp_extract("path", "(o_orderstatus=[^/]+)/", 1).alias("status")).distinct())


_SQL_LIST_PREFIX = """
SELECT DISTINCT 'o_orderpriority=' || o_orderpriority AS priority, 'o_orderstatus=' || o_orderstatus AS status
FROM orders WHERE o_orderpriority LIKE '1%'
"""


def q_location_text(spark, sf_dir):
    """[P13] keys as they are sent to a location service."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey", location_text(F.col("c_custkey") % 90, F.col("c_nationkey")).alias("location"))


_SQL_LOCATION_TEXT = """
SELECT c_custkey, CAST(c_custkey % 90 AS VARCHAR) || ',' || CAST(c_nationkey AS VARCHAR) AS location FROM customer
"""


def q_enrich_failures(spark, sf_dir):
    """[C3, X3] rows and failed rows, counted while the enriched rows are computed."""
    from pyspark.sql import Observation
    from pyspark.sql import types as T
    seen = Observation()
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_id"))

    def service(rec):
        return {} if rec["user_id"] is None else profile_service(rec)

    cut_lineage(enrich(e, ["user_id"], service, T.StructType.fromDDL(_PROFILE_SCHEMA), observation=seen))
    got = seen.get
    return spark.createDataFrame([(got["rows"], got["skipped"])], "all_rows long, failed long")


_SQL_ENRICH_FAILURES = """
SELECT count(*) AS all_rows, count(*) FILTER (WHERE event_id % 7 <> 0 AND user_id % 13 = 0) AS failed FROM events
"""


# ------------------------------------------------------------ catalog tables

def _new_table(spark) -> str:
    return scratch_path(spark, "tessera_t").rsplit("/", 1)[1].replace("-", "_")


def _taken(spark, name: str) -> DataFrame:
    """The table's rows; the table itself goes."""
    rows = cut_lineage(spark.table(name))
    drop_table(spark, name)
    return rows


def q_write_table(spark, sf_dir):
    """[K5a, K5b, K5c, F4] replaced, appended to, and a refused second creation."""
    o, name = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), _new_table(spark)
    write_table(o.limit(5), name)
    refused = 0
    try:
        write_table(o, name, "fail")
    except Exception as e:
        if "ALREADY_EXISTS" not in str(e):
            raise
        refused = 1
    write_table(o.where("o_orderstatus = 'F'"), name, "replace", partition_by=["o_orderstatus"])
    write_table(o.where("o_orderstatus <> 'F'").dropna(), name, "append", partition_by=["o_orderstatus"])
    return _taken(spark, name).withColumn("refused", F.lit(refused))


_SQL_WRITE_TABLE = """
SELECT o_orderkey, o_custkey, o_orderstatus, 1 AS refused FROM orders
WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL
"""


def q_truncate_table(spark, sf_dir):
    """[K6, K7a, F7, K7c] a truncated table keeps its definition; statements run on the catalog; a dropped table is gone."""
    o, name = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), _new_table(spark)
    write_table(o, name)
    truncate_table(spark, name)
    left = spark.table(name).count()
    write_table(o, name, "append")
    run_statement(spark, f"INSERT INTO {name} SELECT o_orderkey + 1000000000, o_custkey FROM {name}")
    rows = _taken(spark, name)
    drop_table(spark, name)  # absent by now: no error
    return rows.select("o_orderkey", "o_custkey", F.lit(left).alias("left_rows"),
                       F.lit(spark.catalog.tableExists(name)).alias("still_there"))


_SQL_TRUNCATE_TABLE = """
SELECT o_orderkey, o_custkey, 0 AS left_rows, false AS still_there FROM orders
UNION ALL SELECT o_orderkey + 1000000000, o_custkey, 0, false FROM orders
"""


def q_delete_where_table(spark, sf_dir):
    """[K7b, F8] rows deleted from a partitioned table; rows whose predicate is null stay."""
    o, name = table(spark, sf_dir, "orders"), _new_table(spark)
    cust = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("cust")
    write_table(o.select("o_orderkey", cust, "o_orderstatus"), name, partition_by=["o_orderstatus"])
    delete_where(spark, name, "cust % 3 = 0")
    return _taken(spark, name)


_SQL_DELETE_WHERE_TABLE = """
SELECT * FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS cust, o_orderstatus FROM orders)
WHERE cust IS NULL OR cust % 3 <> 0
"""


def q_full_refresh_table(spark, sf_dir):
    """[K8, O1] a table dropped and written anew, all columns text."""
    c, name = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), _new_table(spark)
    write_table(c.limit(3), name)
    full_refresh(c, name, "c_custkey")
    return _taken(spark, name)


_SQL_FULL_REFRESH_TABLE = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer
"""


def q_flatten_places_json(spark, sf_dir):
    """[G2] responses stored as JSON text: every field of the records stays."""
    k = F.col("s_suppkey")
    place = F.struct(F.concat(F.lit("p"), k).alias("name"), (k % 50 / 10).alias("rating"), k.alias("user_ratings_total"),
                     F.struct(F.struct((k % 90).cast("double").alias("lat"), (k % 180).cast("double").alias("lng")).alias("location"))
                     .alias("geometry"), F.array(F.lit("cafe")).alias("types"))
    pts = table(spark, sf_dir, "supplier").select("s_suppkey", (k % 10).alias("la"), (k % 20).alias("lo"),
                                                  F.to_json(F.array(place)).alias("response"))
    out = flatten_places(pts, "response", "la", "lo")
    return out.select("s_suppkey", "centroid_lat", "centroid_long", "name", "rating", "user_ratings_total", "places_lat",
                      "places_long", "cafe")


_SQL_FLATTEN_PLACES_JSON = """
SELECT s_suppkey, s_suppkey % 10 AS centroid_lat, s_suppkey % 20 AS centroid_long, 'p' || CAST(s_suppkey AS VARCHAR) AS name,
  (s_suppkey % 50) / 10 AS rating, s_suppkey AS user_ratings_total, CAST(s_suppkey % 90 AS DOUBLE) AS places_lat,
  CAST(s_suppkey % 180 AS DOUBLE) AS places_long, 1 AS cafe
FROM supplier
"""

_LATER = {
    "read_many_csv_headers": (q_read_many_csv_headers, _SQL_READ_MANY_CSV_HEADERS),
    "read_many_parquet_glob": (q_read_many_parquet_glob, _SQL_READ_MANY_PARQUET_GLOB),
    "json_documents": (q_json_documents, _SQL_JSON_DOCUMENTS),
    "union_types": (q_union_types, _SQL_UNION_TYPES),
    "list_prefix": (q_list_prefix, _SQL_LIST_PREFIX),
    "location_text": (q_location_text, _SQL_LOCATION_TEXT),
    "enrich_failures": (q_enrich_failures, _SQL_ENRICH_FAILURES),
    "write_table": (q_write_table, _SQL_WRITE_TABLE),
    "truncate_table": (q_truncate_table, _SQL_TRUNCATE_TABLE),
    "delete_where_table": (q_delete_where_table, _SQL_DELETE_WHERE_TABLE),
    "full_refresh_table": (q_full_refresh_table, _SQL_FULL_REFRESH_TABLE),
    "flatten_places_json": (q_flatten_places_json, _SQL_FLATTEN_PLACES_JSON),
}

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "geo_encode": q_geo_encode,
    "geo_decode": q_geo_decode,
    "parse_path": q_parse_path,
    "path_levels": q_path_levels,
    "crawl_size": q_crawl_size,
    "crawl_paths": q_crawl_paths,
    "object_stem": q_object_stem,
    "file_format": q_file_format,
    "check_objects": q_check_objects,
    "check_objects_schemes": q_check_objects_schemes,
    "multi_hot": q_multi_hot,
    "array_vocabulary": q_array_vocabulary,
    "explode_ranked": q_explode_ranked,
    "json_flatten": q_json_flatten,
    "read_many": q_read_many,
    "union_by_name": q_union_by_name,
    "with_row_index": q_with_row_index,
    "zip_rows": q_zip_rows,
    "sheet_to_table": q_sheet_to_table,
    "full_refresh": q_full_refresh,
    "delete_where": q_delete_where,
    "sql_query": q_sql_query,
    "places_nearby": q_places_nearby,
    "reverse_geocode": q_reverse_geocode,
    "reverse_geocode_outward": q_reverse_geocode_outward,
    "flatten_places": q_flatten_places,
    "flatten_geocode": q_flatten_geocode,
    "enrich_lookup": q_enrich_lookup,
    "csv_round_trip": q_csv_round_trip,
    "parquet_round_trip": q_parquet_round_trip,
    "json_round_trip": q_json_round_trip,
    "lines_round_trip": q_lines_round_trip,
    "stream_geo_encode": q_stream_geo_encode,
}

_ORACLE: dict[str, str] = {
    "geo_encode": _sql_encode(23),
    "geo_decode": _sql_decode(),
    "parse_path": _SQL_PARSE_PATH,
    "path_levels": _SQL_PATH_LEVELS,
    "crawl_size": _SQL_CRAWL_SIZE,
    "crawl_paths": _SQL_CRAWL_PATHS,
    "object_stem": _SQL_OBJECT_STEM,
    "file_format": _SQL_FILE_FORMAT,
    "check_objects": _SQL_CHECK_OBJECTS,
    "check_objects_schemes": _SQL_CHECK_OBJECTS_SCHEMES,
    "multi_hot": _SQL_MULTI_HOT,
    "array_vocabulary": _SQL_ARRAY_VOCABULARY,
    "explode_ranked": _SQL_EXPLODE_RANKED,
    "json_flatten": _SQL_JSON_FLATTEN,
    "read_many": _SQL_READ_MANY,
    "union_by_name": _SQL_UNION_BY_NAME,
    "with_row_index": _SQL_WITH_ROW_INDEX,
    "zip_rows": _SQL_ZIP_ROWS,
    "sheet_to_table": _SQL_SHEET_TO_TABLE,
    "full_refresh": _SQL_FULL_REFRESH,
    "delete_where": _SQL_DELETE_WHERE,
    "sql_query": _SQL_REVENUE,
    "places_nearby": _SQL_PLACES_NEARBY,
    "reverse_geocode": _SQL_REVERSE_GEOCODE,
    "reverse_geocode_outward": _SQL_REVERSE_GEOCODE_OUTWARD,
    "flatten_places": _SQL_FLATTEN_PLACES,
    "flatten_geocode": _SQL_FLATTEN_GEOCODE,
    "enrich_lookup": _SQL_ENRICH_LOOKUP,
    "csv_round_trip": _SQL_CSV_ROUND_TRIP,
    "parquet_round_trip": _SQL_PARQUET_ROUND_TRIP,
    "json_round_trip": _SQL_JSON_ROUND_TRIP,
    "lines_round_trip": _SQL_LINES_ROUND_TRIP,
    "stream_geo_encode": _sql_encode(23),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from tessera.plans.registry_io import LATEST
    return _QUERIES | {name: q for name, (q, _) in (_LATER | LATEST).items()}


def oracle_sql() -> dict[str, str]:
    from tessera.plans.registry_io import LATEST
    return _ORACLE | {name: sql for name, (_, sql) in (_LATER | LATEST).items()}
