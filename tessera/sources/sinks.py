"""File sinks (K1, K2, K3, K4).

One call writes one logical object, ``{path}{stem}{suffix}``, as a
directory of part files (one per task), so writes scale with the data;
``single_file=True`` coalesces to one part when a consumer needs that;
``one_object`` writes one real object from many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def output_name(name: str, suffix: str) -> str:
    """K4: text before the first dot of ``name`` plus the suffix."""
    return str(name).split(".")[0] + suffix


def _target(path: str, name: str, suffix: str) -> str:
    return f"{path}{output_name(name, suffix)}"


def _prep(df: DataFrame, single_file: bool) -> DataFrame:
    return df.coalesce(1) if single_file else df


def write_csv(df: DataFrame, path: str, name: str, mode: str = "overwrite", single_file: bool = False) -> str:
    """K1: CSV with a header; quotes doubled inside quoted fields."""
    target = _target(path, name, ".csv")
    (_prep(df, single_file).write.mode(mode).option("header", "true").option("escape", '"')
     # Spark trims values when writing CSV unless told not to
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(target))
    return target


def write_parquet(df: DataFrame, path: str, name: str, mode: str = "overwrite",
                  single_file: bool = False, partition_by: list[str] | None = None) -> str:
    """K2: Parquet (no index column)."""
    target = _target(path, name, ".parquet")
    w = _prep(df, single_file).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    return target


def json_lines(df: DataFrame, doc: str | Column = "doc") -> DataFrame:
    """A JSON document a row, as text."""
    c = F.col(doc) if isinstance(doc, str) else doc
    return df.select(F.to_json(c, {"ignoreNullFields": "false"}).alias("value"))


def write_json_docs(df: DataFrame, path: str, name: str, doc: str | Column = "doc",
                    mode: str = "overwrite", single_file: bool = False) -> str:
    """K3: one JSON document per row as text lines under ``{stem}.dict``; null fields are written as nulls."""
    target = _target(path, name, ".dict")
    _prep(json_lines(df, doc), single_file).write.mode(mode).text(target)
    return target


def write_docs_apart(df: DataFrame, target: str) -> str:
    """Each row of a text column as a file of its own, written and committed by many tasks.

    However few tasks read the rows: they are dealt out first, and every task
    moves its own files into place (the default committer has the driver move
    all of them, one by one); ``_SUCCESS`` tells that the folder is complete.
    """
    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    (df.repartition(tasks).write.option("maxRecordsPerFile", 1)
     .option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(target))
    return target
