"""Object-path and file-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.columns import as_column as _col

# The object-store scheme the reference strips, and the
# suffixes it reads (CSV; Parquet under three names) plus the two document
# kinds it writes and reads one by one (.dict JSON, .txt lines).
S3_SCHEME = "s3://"
CSV_SUFFIXES = (".csv",)
PARQUET_SUFFIXES = (".parquet", ".pq", ".parquet.snappy")
JSON_SUFFIXES = (".dict",)
TEXT_SUFFIXES = (".txt",)


def parse_object_path(c) -> Column:
    """``s3://bucket/key`` (or ``bucket/key``) -> struct<bucket, key>.

    Only the lowercase scheme is stripped; the split is at the first ``/``.
    Without any ``/`` both parts are NULL (the reference raises there).
    """
    c = _col(c)
    rest = F.when(c.startswith(S3_SCHEME), F.substr(c, F.lit(len(S3_SCHEME) + 1))).otherwise(c)
    slash = F.instr(rest, "/")
    has = slash > 0
    return F.struct(
        F.when(has, F.substring_index(rest, "/", 1)).alias("bucket"),
        F.when(has, F.substr(rest, slash + 1)).alias("key"),
    )


def path_levels(c) -> Column:
    """A key split into its ``/``-separated levels (empty levels kept)."""
    return F.split(_col(c), "/", -1)


def join_path(levels) -> Column:
    """Levels joined back into a path."""
    return F.array_join(_col(levels), "/")


def object_stem(c) -> Column:
    """K4: the output-name rule, text before the first dot."""
    return F.substring_index(_col(c), ".", 1)


def file_format(c) -> Column:
    """Reader format for an object name by suffix; NULL when unknown."""
    c = _col(c)

    def ends(suffixes):
        cond = c.endswith(suffixes[0])
        for s in suffixes[1:]:
            cond = cond | c.endswith(s)
        return cond

    return (F.when(ends(CSV_SUFFIXES), "csv")
            .when(ends(PARQUET_SUFFIXES), "parquet")
            .when(ends(JSON_SUFFIXES), "json")
            .when(ends(TEXT_SUFFIXES), "text"))


def location_text(lat, long) -> Column:
    """``"lat,long"`` text as sent to a location service."""
    return F.concat_ws(",", _col(lat).cast("string"), _col(long).cast("string"))
