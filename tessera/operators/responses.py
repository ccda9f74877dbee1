"""Flatten stored geocoding responses (G1 reverse geocode, G2 nearby places).

A response is an array of result records per point. Flattening is one
explode plus one projection: nested codes and coordinates become columns,
the ``types`` array becomes 0/1 label columns, and the bulky nested fields
are dropped. Other record fields pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.reshape import multi_hot

_LOCATION = T.StructType([T.StructField("location", T.StructType([
    T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType())]))])
_PLUS_CODE = T.StructType([T.StructField("compound_code", T.StringType()),
                           T.StructField("global_code", T.StringType())])

# Types of the fields that the flattening reads or drops, and of common ones;
# other fields of stored responses are found in the data.
GEOCODE_RESULT = T.StructType([
    T.StructField("formatted_address", T.StringType()),
    T.StructField("place_id", T.StringType()),
    T.StructField("plus_code", _PLUS_CODE),
    T.StructField("geometry", _LOCATION),
    T.StructField("address_components", T.StringType()),
    T.StructField("types", T.ArrayType(T.StringType())),
])
PLACES_RESULT = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("place_id", T.StringType()),
    T.StructField("vicinity", T.StringType()),
    T.StructField("plus_code", _PLUS_CODE),
    T.StructField("geometry", _LOCATION),
    T.StructField("photos", T.StringType()),
    T.StructField("icon", T.StringType()),
    T.StructField("opening_hours", T.StringType()),
    T.StructField("types", T.ArrayType(T.StringType())),
])

# The nested fields each flattening drops.
GEOCODE_DROP = ("plus_code", "geometry", "address_components", "types")
PLACES_DROP = ("geometry", "plus_code", "photos", "icon", "opening_hours", "types")


def _readable(t: T.DataType) -> T.DataType:
    """An inferred type as columns use it: numbers with fractions as DOUBLE, what is always null as STRING."""
    if isinstance(t, T.DecimalType):
        return T.DoubleType()
    if isinstance(t, T.NullType):
        return T.StringType()
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_readable(t.elementType))
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _readable(f.dataType)) for f in t.fields])
    return t


def _variant(df: DataFrame, col: str):
    """The column as VARIANT (text that is no JSON is NULL), or None where it holds arrays already."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.StringType):
        return F.try_parse_json(F.col(f"`{col}`"))
    return F.col(f"`{col}`") if isinstance(dt, T.VariantType) else None


def _is_record(value):
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def _records(df: DataFrame, col: str, schema: T.StructType) -> DataFrame:
    """Responses stored as JSON text or VARIANT become arrays of records.

    One aggregate over the records of all rows finds every field they have;
    fields in ``schema`` are read by its types. What is no array of records
    (an error object, a number, text that is no JSON) becomes NULL and changes
    nothing for other rows; an element that is no record is NULL in its place.
    ``malformed_responses`` counts the rows of either kind.
    """
    value = _variant(df, col)
    if value is None:
        return df
    spark = df.sparkSession
    elements = F.try_variant_get(value, "$", "array<variant>")
    each = df.select(F.explode(elements).alias("e")).where(_is_record(F.col("e")))
    found = each.agg(F.schema_of_variant_agg("e").alias("s")).first()["s"]
    fields = list(schema.fields)
    if found and found.startswith("OBJECT<"):
        t = spark.sql(f"SELECT CAST(NULL AS {found.replace('OBJECT<', 'STRUCT<')}) AS x").schema["x"].dataType
        fields += [T.StructField(f.name, _readable(f.dataType)) for f in t.fields if f.name not in schema.names]
    record = T.StructType(fields).simpleString()
    read = F.transform(elements, lambda e: F.when(_is_record(e), F.try_variant_get(e, "$", record)))
    return df.withColumn(col, read)


def malformed_responses(df: DataFrame, response: str) -> int:
    """Number of responses that are no JSON, no array, or hold an element that is no record (0 for typed arrays)."""
    value = _variant(df, response)
    if value is None:
        return 0
    elements = F.try_variant_get(value, "$", "array<variant>")
    good = elements.isNotNull() & F.forall(elements, _is_record)
    return df.where(F.col(f"`{response}`").isNotNull() & ~F.coalesce(good, F.lit(False))).count()


def _fields(df: DataFrame, rec: str) -> list[str]:
    return [f.name for f in df.schema[rec].dataType.fields]


def _flatten(df: DataFrame, col: str, schema: T.StructType, rank: str | None, drop: tuple[str, ...],
             lat_name: str, lon_name: str, vocabulary, max_labels: int | None) -> DataFrame:
    df = _records(df, col, schema)
    others = [F.col(f"`{c}`") for c in df.columns if c != col]
    gen = F.posexplode(col).alias(rank, "__rec") if rank else F.explode(col).alias("__rec")
    exploded = df.select(*others, gen).where(F.col("__rec").isNotNull())
    fields = _fields(exploded, "__rec")
    keep = [F.col("__rec")[f].alias(f) for f in fields if f not in drop]
    has = set(fields)
    extra = []
    if "plus_code" in has:
        extra += [F.col("__rec.plus_code.compound_code").alias("compound_code"),
                  F.col("__rec.plus_code.global_code").alias("global_code")]
    if "geometry" in has:
        extra += [F.col("__rec.geometry.location.lat").alias(lat_name),
                  F.col("__rec.geometry.location.lng").alias(lon_name)]
    carried = [c for c in exploded.columns if c != "__rec"]
    flat = exploded.select(*[F.col(f"`{c}`") for c in carried], *keep, *extra,
                           (F.col("__rec.types") if "types" in has else F.lit(None).cast("array<string>"))
                           .alias("__types"))
    return multi_hot(flat, "__types", vocabulary, max_labels=max_labels)


def flatten_geocode(df: DataFrame, response: str, vocabulary: list[str] | None = None,
                    max_labels: int | None = None) -> DataFrame:
    """G1: one row per address result with ``address_rank`` (0-based),
    ``compound_code``, ``global_code``, ``gmaps_lat``, ``gmaps_long`` and a 0/1
    column per type. A NULL ``plus_code`` gives NULL codes; an empty or NULL
    response adds no row. The point's own columns are carried along.
    """
    return _flatten(df, response, GEOCODE_RESULT, "address_rank", GEOCODE_DROP,
                    "gmaps_lat", "gmaps_long", vocabulary, max_labels)


def flatten_places(df: DataFrame, response: str, lat: str, long: str,
                   vocabulary: list[str] | None = None, max_labels: int | None = None) -> DataFrame:
    """One row per nearby place with the point as ``centroid_lat`` /
    ``centroid_long``, ``places_lat`` / ``places_long``, the plus codes and a
    0/1 column per type. Records may differ in fields (missing ones are NULL).
    """
    renamed = df.withColumnRenamed(lat, "centroid_lat").withColumnRenamed(long, "centroid_long")
    return _flatten(renamed, response, PLACES_RESULT, None, PLACES_DROP,
                    "places_lat", "places_long", vocabulary, max_labels)
