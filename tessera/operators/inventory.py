"""Storage inventory and existence checks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.paths import join_path, path_levels
from tessera.operators.skew import DEFAULT_HOT_ROWS, join_distinct


def max_depth(listing: DataFrame, path_col: str = "path") -> int:
    """The widest key decides the column count (one small aggregate job)."""
    row = listing.agg(F.max(F.size(path_levels(path_col))).alias("d")).first()
    return int(row["d"] or 0)


def crawl_size(listing: DataFrame, path_col: str = "path", size_col: str = "length",
               levels: int | None = None, only_full_depth: bool = False, relative_to: str | None = None
               ) -> tuple[DataFrame, DataFrame]:
    """Size inventory by path level.

    Returns ``(levels_df, paths_df)``. ``levels_df`` has ``Level 0 .. Level n-1``
    (n = deepest key unless given; shallower keys are padded with NULL) and
    ``Size``, keeping every object with ``Size > 0``; ``only_full_depth``
    also drops rows with a missing level. ``paths_df`` lists every path,
    empty objects included. Both are lazy; only the depth is computed eagerly
    when ``levels`` is not given. ``relative_to`` (a root such as
    ``s3a://bucket``) is cut from the front of each path first, so levels
    are those of the object key, as the original code splits keys.
    """
    if relative_to is not None:
        root = relative_to.rstrip("/") + "/"
        p = F.col(path_col)
        listing = listing.withColumn(
            path_col, F.when(p.startswith(root), F.substr(p, F.lit(len(root) + 1))).otherwise(p))
    n = levels if levels is not None else max_depth(listing, path_col)
    lv = path_levels(path_col)
    cols = [F.get(lv, i).alias(f"Level {i}") for i in range(n)]
    levels_df = listing.select(*cols, F.col(size_col).alias("Size")).filter(F.col("Size") > 0)
    if only_full_depth:
        levels_df = levels_df.dropna(how="any")
    paths_df = listing.select(join_path(lv).alias("path"))
    return levels_df, paths_df


def crawl_prefix(spark, root: str, prefix: str = "", only_full_depth: bool = False
                 ) -> tuple[DataFrame, DataFrame]:
    """C1 end to end: list ``root + prefix`` (S1, empty objects included) and
    inventory the keys below ``root``."""
    from tessera.sources.files import list_files
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    qualified = fs.makeQualified(path).toString()  # the form listings use, e.g. file:/x
    listing = list_files(spark, root, prefix)
    return crawl_size(listing, "path", "length", only_full_depth=only_full_depth, relative_to=qualified)


MAX_FILTER_BYTES = 32 << 20
_HASHES = 4


def _bit_places(key: Column, bits: int) -> list[Column]:
    """Places of a key in a filter of ``bits`` (a power of two): two hashes, stepped."""
    one, two = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    # added by halves of 32 bits, so that no sum leaves a long
    low = lambda c: F.shiftrightunsigned(c, 32)
    return [(low(one) + low(two).bitwiseOR(F.lit(1)) * F.lit(i)).bitwiseAND(F.lit(bits - 1)) for i in range(_HASHES)]


def path_filter(keys: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> Callable[[Column], Column] | None:
    """A Bloom filter over a frame of one text column, as a function from a key to whether it may be there (false for
    NULL). At least ten bits a key: about one of 80 absent keys passes. None where it would need more than ``max_bytes``.
    """
    spark = keys.sparkSession
    key = F.col(keys.columns[0])
    n = keys.count()
    bits = 1 << max(6, (10 * max(n, 1) - 1).bit_length())
    if bits // 8 > min(max_bytes, 1 << 29):
        return None
    at = keys.select(F.explode(F.array(*_bit_places(key, bits))).alias("p"))
    words = (at.groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("b")).toArrow())
    table = np.zeros(bits // 64, dtype=np.uint64)
    table[words.column("w").to_numpy()] = words.column("b").to_numpy().astype(np.int64).view(np.uint64)
    shared = spark.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def all_set(places: pa.Array) -> pa.Array:
        p = places.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
        bit = (shared.value[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)
        return pa.array((bit == 1).reshape(-1, _HASHES).all(axis=1))

    return lambda k: F.coalesce(k.isNotNull() & all_set(F.array(*_bit_places(k, bits))), F.lit(False))


_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*:)?/*"


def check_objects(manifest: DataFrame, listing: DataFrame, path_col: str = "path",
                  listing_path_col: str | None = None, hot_rows: int = DEFAULT_HOT_ROWS,
                  ignore_scheme: bool = False, prune_absent: bool = False,
                  max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """Every manifest row with a boolean ``exists``.

    The listing is reduced to distinct paths first (map-side partial
    aggregation), then left-joined on the path, so each manifest row appears
    exactly once however often a path is listed; a path repeated by a large
    share of the manifest is split over salt buckets (``join_distinct``).
    ``ignore_scheme`` compares paths without scheme and leading slashes, so
    ``s3://b/k``, ``s3a://b/k`` and ``b/k`` match (and ``/x`` ``file:/x``).

    ``prune_absent`` is for manifests of which most objects are absent: a
    Bloom filter over the listing's paths answers those rows where they are
    read, and only rows that may exist are joined. The filter is as large as
    the listing needs; one beyond ``max_filter_bytes`` is not built, and all
    rows are joined. The result is the same.
    """
    lp = listing_path_col or path_col

    def key(c):
        return F.regexp_replace(F.col(c), _SCHEME, "") if ignore_scheme else F.col(c)

    present = (listing.select(key(lp).alias("__k")).where(F.col("__k").isNotNull()).distinct()
               .withColumn("__present", F.lit(True)))
    keyed = manifest.withColumn("__k", key(path_col))
    columns = [F.col(f"`{c}`") for c in manifest.columns]
    may = path_filter(present.select("__k"), max_filter_bytes) if prune_absent else None
    absent = None
    if may is not None:
        keyed = keyed.withColumn("__may", may(F.col("__k")))
        absent = keyed.where(~F.col("__may")).select(*columns, F.lit(False).alias("exists"))
        keyed = keyed.where("__may").drop("__may")
    joined = join_distinct(keyed, present, ["__k"], "left", hot_rows=hot_rows)
    found = joined.select(*columns, F.coalesce(F.col("__present"), F.lit(False)).alias("exists"))
    return found if absent is None else found.unionByName(absent)
