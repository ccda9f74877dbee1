"""Sheet objects to tables and keyed full-refresh loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Schema of an exported sheet object (only the fields the conversion reads).
SHEET_SCHEMA = T.StructType([
    T.StructField("columns", T.ArrayType(T.StructType([T.StructField("title", T.StringType())]))),
    T.StructField("rows", T.ArrayType(T.StructType([
        T.StructField("cells", T.ArrayType(T.StructType([T.StructField("value", T.StringType())]))),
    ]))),
])


# Up to this many titles a per-title lookup is used (about 330 bytes of
# generated code each, below the 8000-byte JIT limit in total).
_DIRECT_TITLES = 20


def _sheet(df: DataFrame, col: str) -> Column:
    dt = df.schema[col].dataType
    if isinstance(dt, T.StringType):
        return F.from_json(F.col(col), SHEET_SCHEMA)
    return F.col(col)


def sheet_titles(df: DataFrame, col: str) -> list[str]:
    """Column titles over all sheets, in first-seen position order.

    Fails on a sheet that repeats a title. One aggregation per title (with
    the repeat flag carried along): one small row per output column reaches
    the driver.
    """
    s = _sheet(df, col)
    titles = s["columns"]["title"]
    repeats = F.size(titles) != F.size(F.array_distinct(titles))
    rows = (df.select(F.posexplode(titles).alias("pos", "title"), repeats.alias("rep"))
            .groupBy("title").agg(F.min("pos").alias("pos"), F.max("rep").alias("rep"))
            .collect())
    if any(r["rep"] for r in rows):
        raise ValueError("a sheet repeats a column title")
    return [r["title"] for r in sorted(rows, key=lambda r: (r["pos"], r["title"] is not None, r["title"]))]


def sheet_to_table(df: DataFrame, col: str, titles: list[str] | None = None,
                   row_index: str | None = "row_index", keep: list[str] | None = None) -> DataFrame:
    """One output row per sheet row, one STRING column per title.

    Cells match titles by position within their own sheet; an absent cell or
    value is NULL. ``keep`` carries other input columns (e.g. a sheet id)
    onto every row; ``row_index`` is the 0-based row position in the sheet.
    """
    titles = titles if titles is not None else sheet_titles(df, col)
    if len(set(titles)) != len(titles):
        raise ValueError("duplicate titles")
    s = _sheet(df, col)
    keep = keep or []
    exploded = df.select(*keep, s["columns"]["title"].alias("__titles"),
                         F.posexplode(s["rows"]).alias("__pos", "__row"))
    out = [F.col(k) for k in keep]
    if row_index:
        out.append(F.col("__pos").alias(row_index))
    cells = F.col("__row")["cells"]
    if len(titles) <= _DIRECT_TITLES:
        # a lookup per title: fastest while the generated code stays small
        for t in titles:
            i = F.array_position(F.col("__titles"), F.lit(t)).cast("int") - 1
            out.append(F.get(cells, i)["value"].alias(t))
        return exploded.select(*out)
    # wide sheets: one pass per row puts the values in title order and each
    # output column is an array element, so the generated code stays below
    # the JIT limit (a lookup per title would not)
    wanted = F.array(*[F.lit(t) for t in titles])
    values = F.transform(wanted, lambda t: F.get(cells, F.array_position(F.col("__titles"), t).cast("int") - 1)["value"])
    staged = exploded.select(*[F.col(k) for k in keep], "__pos", values.alias("__vals"))
    out = [F.col(k) for k in keep] + ([F.col("__pos").alias(row_index)] if row_index else [])
    out += [F.get(F.col("__vals"), i).alias(t) for i, t in enumerate(titles)]
    return staged.select(*out)


def pack_sheets(df: DataFrame, sheet_id: Column, order_by: str, columns: list[str]) -> DataFrame:
    """Pack a table into sheet objects, one per ``sheet_id`` value.

    Callers choose ``sheet_id`` so each sheet is bounded (a sheet is one row).
    """
    cells = F.array(*[F.struct(F.col(c).cast("string").alias("value")) for c in columns])
    titles = F.array(*[F.struct(F.lit(c).alias("title")) for c in columns])
    packed = (df.select(sheet_id.alias("sheet_id"), F.col(order_by).alias("__k"), cells.alias("cells"))
              .groupBy("sheet_id")
              .agg(F.array_sort(F.collect_list(F.struct("__k", "cells"))).alias("__rows")))
    return packed.select("sheet_id", F.struct(
        titles.alias("columns"),
        F.transform("__rows", lambda r: F.struct(r["cells"].alias("cells"))).alias("rows"),
    ).alias("sheet"))


def prepare_full_refresh(df: DataFrame, key: str, require_unique: bool = False) -> DataFrame:
    """K8 (frame part): every column as text, rows ascending by the typed key.

    Sorting before the cast keeps numeric order (9 before 10); NULL keys
    sort first; rows with equal keys keep no particular order.
    ``require_unique`` fails on a repeated key (one aggregate job).
    """
    if key not in df.columns:
        raise ValueError(f"key {key!r} not in frame")
    if require_unique:
        dup = df.groupBy(key).count().where("count > 1").limit(1).count()
        if dup:
            raise ValueError(f"key {key!r} is not unique")
    # the scan position breaks ties, so rows sharing one hot key are spread
    # over several range partitions instead of one task
    ordered = df.orderBy(F.col(key).asc_nulls_first(), F.monotonically_increasing_id())
    return ordered.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def full_refresh(df: DataFrame, target: str, key: str, jdbc: dict | None = None,
                 require_unique: bool = False) -> None:
    """K8: drop-and-recreate ``target`` with all-text columns sorted by key."""
    from tessera.sources.tables import write_table
    prepared = prepare_full_refresh(df, key, require_unique)
    write_table(prepared, target, "replace", jdbc=jdbc)
