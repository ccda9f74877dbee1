"""Session functions shared by tests, the bench and the library."""

from __future__ import annotations

import atexit
import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings a session built by this package gets; a cluster's own
# spark-defaults win for anything already set there.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not JIT-compile methods over 8000 bytes; with this limit a
    # stage whose generated method would be larger runs without whole-stage
    # codegen (split, compilable methods) instead of in the interpreter
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # checkpoint files are removed once the frames using them are collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset
    (a local test) a scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is unset; a cluster needs a shared folder")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint): the data is written to
    the cluster file system, and the returned frame reads it back.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def error_condition(e: Exception) -> str | None:
    """The error class of an exception that Spark raised (from Python or the JVM), if it has one."""
    for source in (e, getattr(e, "java_exception", None)):
        while source is not None:
            try:
                found = source.getCondition()
            except Exception:
                found = None
            if found:
                return str(found)
            source = source.getCause() if hasattr(source, "getCause") and source is not e else None
    return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables; removed when the driver's Python ends."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{os.getpid()}-{next(_counter)}"
    if not _scratch:
        atexit.register(_remove_scratch)
    _scratch.append(path)
    return path


_scratch: list[str] = []


def _remove_scratch() -> None:
    from pyspark import SparkContext
    jvm = SparkContext._jvm
    for path in _scratch if jvm is not None else []:
        try:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(p, True)
        except Exception:  # the JVM has gone: nothing to be done from here
            return


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()
