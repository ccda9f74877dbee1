"""Single objects of a Hadoop-compatible store, handled from the driver: metadata and small texts only."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

THREADS = 32


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path with scheme, as listings and file metadata write it after decoding (``file:/x``)."""
    return _system(spark, path).makeQualified(_path(spark, path)).toString()


def _each(fn: Callable, items: Iterable) -> None:
    items = list(items)
    if items:
        with ThreadPoolExecutor(max_workers=min(THREADS, len(items))) as pool:
            list(pool.map(fn, items))


def list_tree(spark: SparkSession, path: str, only: str = "") -> list[tuple[str, int, int]]:
    """``(path, length, modification ms)`` of all objects below a folder; with ``only``, of its folders with that prefix."""
    from tessera.sources.files import statuses, walk
    fs, at = _system(spark, path), _path(spark, path)
    if not fs.exists(at):
        return []
    level = statuses(spark, fs.listStatus(at))
    if only:
        level = [s for s in level if s[1] and s[0].rsplit("/", 1)[-1].startswith(only)]
    return walk(spark, fs, level)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small object in one step: written beside and renamed."""
    fs, part = _system(spark, path), _path(spark, path + ".part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not fs.rename(part, _path(spark, path)):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def move_files(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """Rename objects; one that is gone from its old place and there at the new one counts as moved."""
    def move(pair: tuple[str, str]) -> None:
        fs, old, new = _system(spark, pair[0]), _path(spark, pair[0]), _path(spark, pair[1])
        if not fs.exists(old) and fs.exists(new):
            return
        fs.mkdirs(new.getParent())
        if not fs.rename(old, new):
            raise OSError(f"could not move {pair[0]} to {pair[1]}")

    _each(move, moves)


def remove_files(spark: SparkSession, paths: list[str]) -> None:
    """Remove objects or folders; absent ones are no error."""
    _each(lambda p: _system(spark, p).delete(_path(spark, p), True), paths)
