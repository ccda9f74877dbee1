"""Incremental ingest of new objects under a prefix (Structured Streaming).

The batch readers list a prefix and read what is there; a stream does the
same continuously: the file source remembers which objects it has read (in
the query checkpoint), so each new object is read exactly once. Every
DataFrame function in this package is a projection, explode or join, so it
applies unchanged to the streaming frame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

_FORMATS = {"csv", "parquet", "json", "text"}


def stream_files(spark: SparkSession, root: str, fmt: str, schema: T.StructType | None = None,
                 prefix: str = "", max_files_per_trigger: int | None = None,
                 options: dict | None = None) -> DataFrame:
    """A streaming frame over objects whose key starts with ``root + prefix``.

    File streams need a schema up front (except text); CSV is read with a
    header, quoted newlines and doubled quotes, as the batch reader does.
    """
    if fmt not in _FORMATS:
        raise ValueError(f"fmt must be one of {sorted(_FORMATS)}")
    if schema is None and fmt != "text":
        raise ValueError("streaming file sources need a schema")
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", "true").option("multiLine", "true").option("escape", '"')
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    path = root.rstrip("/") + "/" + prefix + "*" if prefix else root
    return r.load(path)


def write_batches(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                  trigger_once: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Run ``sink(batch_df, batch_id)`` for every micro-batch.

    ``checkpoint`` must be a shared folder; with it, a restarted query
    resumes after the last committed batch. Sinks should be idempotent per
    ``batch_id`` (e.g. write to a folder named by it) for exactly-once output.
    """
    w = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if trigger_once:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def parquet_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A batch sink writing each micro-batch under ``{path}/batch={id}``
    (overwrite, so a replayed batch replaces its own output)."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")
    return sink
