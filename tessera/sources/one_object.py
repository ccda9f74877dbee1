"""One real object from many tasks (K1, K3).

``write_csv`` and ``write_json_docs`` write a folder of part files. These
write exactly ``{path}{stem}{suffix}``, one object any reader opens: the tasks
write their parts into a hidden folder beside it, and a commit step puts the
parts together in order, without one task that sees all of the data:

- where the store joins objects by itself (HDFS ``concat``), by that;
- on a file system that every executor mounts (``file:``), tasks copy ranges
  of the parts to their places in the new object. A task that is run again
  writes the same bytes to the same place.

The object takes its name by a rename when all of it is there. Stores that can
do neither are refused before anything is written. The driver holds a path
and a length for each part. Parquet has no such form here: a file's footer
holds the places of all its column chunks, so parts cannot be joined as bytes.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.sinks import json_lines, output_name
from tessera.sources.store import _path, _system, list_tree, remove_files

PIECE_BYTES = 64 << 20
CONCAT = "fs.capability.paths.concat"


def _csv_cell(text: str) -> str:
    return '"' + text.replace('"', '""') + '"' if re.search(r'[",\r\n]|^\s|\s$|^$', text) else text


def write_one_csv(df: DataFrame, path: str, name: str) -> str:
    """K1 as one object: a header, then the rows in the frame's order; an older object of the name is replaced."""
    def parts(folder: str) -> None:
        (df.write.option("header", "false").option("compression", "none").option("escape", '"').option("ignoreLeadingWhiteSpace", "false")
         .option("ignoreTrailingWhiteSpace", "false").csv(folder))

    return _write(df.sparkSession, f"{path}{output_name(name, '.csv')}", parts, ",".join(map(_csv_cell, df.columns)) + "\n")


def write_one_json_docs(df: DataFrame, path: str, name: str, doc: str | Column = "doc") -> str:
    """K3 as one object: one JSON document a line, in the frame's order; one row makes one document."""
    return _write(df.sparkSession, f"{path}{output_name(name, '.dict')}", json_lines(df, doc).write.option("compression", "none").text, "")


def _write(spark: SparkSession, target: str, write_parts, head: str) -> str:
    fs, at = _system(spark, target), _path(spark, target)
    parent, mounted = at.getParent(), _system(spark, target).getUri().getScheme() == "file"
    fs.mkdirs(parent)
    if not mounted and not fs.hasPathCapability(parent, CONCAT):
        raise ValueError(f"{fs.getUri().getScheme()}: can neither join objects nor be written in place; write a folder of parts")
    folder = f"{parent.toString().rstrip('/')}/.{at.getName()}-{uuid.uuid4().hex}"
    try:
        write_parts(f"{folder}/parts")
        found = [p for p in list_tree(spark, f"{folder}/parts") if p[1] and p[0].rsplit("/", 1)[-1].startswith("part-")]
        parts = sorted(found, key=lambda p: _number(p[0]))
        whole = f"{folder}/whole"
        out = fs.create(_path(spark, whole), True)
        out.write(bytearray(head.encode("utf-8")))
        out.close()
        if mounted:
            _copy(spark, parts, whole, len(head.encode("utf-8")))
        else:
            _concat(spark, parts, whole)
        remove_files(spark, [target])
        if not fs.rename(_path(spark, whole), at):
            raise OSError(f"could not write {target}")
    finally:
        remove_files(spark, [folder])
    return target


def _number(path: str) -> tuple[int, int]:
    """Task and file number of a part, which order the rows."""
    m = re.fullmatch(r"part-(\d+)-.*?(?:-c(\d+))?\.(?:csv|txt)", path.rsplit("/", 1)[-1])
    if not m:
        raise ValueError(f"not a part of this object: {path}")
    return int(m[1]), int(m[2] or 0)


def _concat(spark: SparkSession, parts: list[tuple[str, int, int]], whole: str, at_once: int = 500) -> None:
    fs, jvm = _system(spark, whole), spark.sparkContext._jvm
    for i in range(0, len(parts), at_once):
        some = parts[i:i + at_once]
        paths = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(some))
        for k, (p, _, _) in enumerate(some):
            paths[k] = _path(spark, p)
        fs.concat(_path(spark, whole), paths)


def _copy(spark: SparkSession, parts: list[tuple[str, int, int]], whole: str, start: int, piece: int = PIECE_BYTES) -> None:
    """Copy every part, in ranges, to its place behind ``start``."""
    local = lambda p: _path(spark, p).toUri().getPath()
    target, rows, at = local(whole), [], start
    for path, size, _ in parts:
        rows += [(local(path), first, min(piece, size - first), at + first) for first in range(0, size, piece)]
        at += size
    # what the tasks write is not in the checksum made with the header
    remove_files(spark, [f"{whole.rsplit('/', 1)[0]}/.{whole.rsplit('/', 1)[1]}.crc"])
    if not rows:
        return

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for source, first, size, to in zip(*[c.to_pylist() for c in batch.columns]):
                with open(source, "rb") as a, open(target, "r+b") as b:
                    a.seek(first)
                    b.seek(to)
                    left = size
                    while left:
                        data = a.read(min(left, 1 << 20))
                        if not data:
                            raise OSError(f"{source} is shorter than listed")
                        b.write(data)
                        left -= len(data)
                done.append(size)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], names=["bytes"])

    ranges = spark.createDataFrame(rows, "source string, first long, size long, place long")
    copied = (ranges.repartition(min(len(rows), max(spark.sparkContext.defaultParallelism, len(rows) // 4)), "place")
              .mapInArrow(copy, "bytes long").agg(F.sum("bytes")).first()[0])
    if copied != at - start:
        raise OSError(f"{copied} of {at - start} bytes were copied to {target}")
