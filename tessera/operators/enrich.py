"""Per-key calls to an outside service, distributed (X3), with failure
counting (C3).

The reference calls a web service once per row, sequentially, and hides
failures. Here the keys are made distinct first (so repeated keys cost one
call), the calls run in ``mapInArrow`` tasks with one client per task, a
failure becomes a row with an ``error`` text, and the lookup table is
checkpointed to the shared checkpoint folder so a retried or replayed stage
does not call the service again. Results are joined back on the keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.skew import DEFAULT_HOT_ROWS, join_distinct
from tessera.session import cut_lineage


def _lookup_fn(keys: list[str], fn: Callable, client_factory: Callable | None, out_schema: pa.Schema,
               retries: int = 0, backoff_s: float = 0.5, every_s: float = 0.0):
    import time

    due = [0.0]

    def wait():
        """At most one call of this task in ``every_s`` seconds."""
        pause = due[0] - time.monotonic()
        if pause > 0:
            time.sleep(pause)
        due[0] = max(due[0], time.monotonic()) + every_s

    def call(client, rec):
        for attempt in range(retries + 1):
            try:
                if every_s:
                    wait()
                return fn(client, rec) if client_factory else fn(rec)
            except Exception:
                if attempt == retries:
                    raise
                time.sleep(backoff_s * (2 ** attempt))

    added = [f for f in out_schema if f.name not in keys and f.name != "error"]
    nothing = [pa.nulls(1, f.type) for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = client_factory() if client_factory else None
        for batch in batches:
            results, errors = [], []
            for rec in batch.to_pylist():
                try:
                    # a value of another type than its field is a failure of this record
                    found = call(client, rec) or {}
                    results.append([pa.array([found.get(f.name)], f.type) for f in added])
                    errors.append(None)
                except Exception as e:  # kept as a row, counted by C3
                    results.append(nothing)
                    errors.append(f"{type(e).__name__}: {e}")
            # keys pass through untouched
            columns = [batch.column(k) for k in keys]
            columns += [pa.concat_arrays([r[i] for r in results]) if results else pa.array([], f.type) for i, f in enumerate(added)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(errors, pa.string())],
                                             names=[*keys, *[f.name for f in added], "error"])
    return run


def lookup_table(df: DataFrame, keys: list[str], fn: Callable, schema: T.StructType,
                 client_factory: Callable | None = None, checkpoint: bool = True,
                 partitions: int | None = None, retries: int = 0, backoff_s: float = 0.5,
                 calls_per_s: float | None = None) -> DataFrame:
    """Distinct keys -> one call each -> ``keys + schema fields + error``.

    Keys with a NULL part are still looked up once (the service decides).
    A failing call is retried ``retries`` times with exponential backoff
    before its error is recorded. The calls run in ``partitions`` tasks (as
    many as the cluster runs at once by default): a fixed number, because
    Spark would merge partitions of few bytes into one however long a call
    takes. With ``calls_per_s`` each of them makes its share of that many
    calls a second, retries included, so all together never make more.
    """
    partitions = partitions or df.sparkSession.sparkContext.defaultParallelism
    distinct = df.select(*keys).distinct().repartition(partitions, *keys)
    key_fields = [df.schema[k] for k in keys]
    out_schema = T.StructType(key_fields + list(schema.fields) + [T.StructField("error", T.StringType())])
    arrow = df.sparkSession.createDataFrame([], out_schema).toArrow().schema
    looked = distinct.mapInArrow(_lookup_fn(keys, fn, client_factory, arrow, retries, backoff_s,
                                            partitions / calls_per_s if calls_per_s else 0.0), out_schema)
    return cut_lineage(looked) if checkpoint else looked


def enrich(df: DataFrame, keys: list[str], fn: Callable, schema: T.StructType,
           client_factory: Callable | None = None, checkpoint: bool = True,
           observation: Observation | None = None, hot_rows: int = DEFAULT_HOT_ROWS,
           retries: int = 0, backoff_s: float = 0.5, partitions: int | None = None) -> DataFrame:
    """Add the service result for each row's key (NULL keys included,
    matched null-safely). A key carried by a large share of the rows is
    split over salt buckets in the join back (``join_distinct``). With
    ``observation``, the number of failed rows (C3, ``skipped``) is recorded
    when the result is computed."""
    table = lookup_table(df, keys, fn, schema, client_factory, checkpoint, partitions, retries, backoff_s)
    joined = join_distinct(df, table, keys, "left", null_safe=True, hot_rows=hot_rows)
    if observation is not None:
        joined = joined.observe(observation, F.count(F.col("error")).alias("skipped"),
                                F.count(F.lit(1)).alias("rows"))
    return joined


def logged_lookup(df: DataFrame, keys: list[str], fn: Callable, schema: T.StructType, log: str,
                  client_factory: Callable | None = None, keep_s: float | None = None, max_attempts: int = 3,
                  wave_keys: int = 100_000, partitions: int | None = None, retries: int = 0, backoff_s: float = 0.5,
                  calls_per_s: float | None = None) -> DataFrame:
    """Results of the keys of ``df`` from a call log on the shared store, after calls for those that it lacks.

    ``log`` is a Parquet folder: keys, the fields of ``schema``, ``error``,
    ``attempt`` (1, 2, ...) and ``called_at``, appended only. A key is called
    if the log has no result of it younger than ``keep_s`` seconds (of any
    age by default) and fewer than ``max_attempts`` failures since its last
    result. Keys are called in waves of about ``wave_keys``, each appended
    when it is complete, so a lost job repeats one wave at most, and a second
    run over the same keys makes no call. Returns the newest row of each key.
    """
    spark = df.sparkSession
    key_fields = [T.StructField(f.name, f.dataType) for f in (df.schema[k] for k in keys)]
    row = T.StructType([*key_fields, *schema.fields, T.StructField("error", T.StringType()),
                        T.StructField("attempt", T.IntegerType()), T.StructField("called_at", T.TimestampType())])
    rest = [f.name for f in row.fields if f.name not in keys]
    # the folder exists from the start, so that an empty log reads like any other
    spark.createDataFrame([], row).write.mode("append").parquet(log)

    def state() -> DataFrame:
        # a later row of the same time has the higher attempt
        newest = F.max(F.struct("called_at", "attempt", *[c for c in rest if c not in ("called_at", "attempt")]))
        return spark.read.schema(row).parquet(log).groupBy(*keys).agg(newest.alias("last"))

    wanted = df.select(*keys).distinct()
    known = state().select(*[F.col(k).alias(f"__l_{k}") for k in keys], "last")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__l_{k}")) for k in keys])
    fresh = F.lit(True) if keep_s is None else F.unix_micros(F.current_timestamp()) - F.unix_micros("last.called_at") < int(keep_s * 1e6)
    done = F.when(F.col("last.error").isNull(), fresh).otherwise(F.col("last.attempt") >= max_attempts)
    todo = (wanted.join(known, same, "left").where(F.col("last").isNull() | ~done)
            .select(*keys, F.when(F.col("last.error").isNotNull(), F.col("last.attempt")).otherwise(0).alias("__tried")))
    # written: the log grows while the waves run
    todo = cut_lineage(todo)
    waves = -(-todo.count() // wave_keys)
    for wave in range(waves):
        part = todo.where(F.pmod(F.xxhash64(*keys), F.lit(waves)) == wave) if waves > 1 else todo
        found = lookup_table(part, [*keys, "__tried"], _without(fn, "__tried", client_factory), schema, client_factory, False,
                             partitions, retries, backoff_s, calls_per_s)
        (found.select(*keys, *[f.name for f in schema.fields], "error", (F.col("__tried") + 1).alias("attempt"),
                      F.current_timestamp().alias("called_at")).write.mode("append").parquet(log))
    left = wanted.select(*[F.col(k).alias(f"__l_{k}") for k in keys])
    return state().join(left, same, "left_semi").select(*keys, *[F.col("last")[c].alias(c) for c in rest])


def _without(fn: Callable, field: str, client_factory: Callable | None) -> Callable:
    """The service function, without a field of ours in its record."""
    def plain(rec):
        return fn({k: v for k, v in rec.items() if k != field})

    def with_client(client, rec):
        return fn(client, {k: v for k, v in rec.items() if k != field})

    return with_client if client_factory else plain


def enrich_logged(df: DataFrame, keys: list[str], fn: Callable, schema: T.StructType, log: str,
                  observation: Observation | None = None, hot_rows: int = DEFAULT_HOT_ROWS, **lookup) -> DataFrame:
    """``enrich`` over a durable call log (``logged_lookup``): what an earlier run has called is not called again."""
    table = logged_lookup(df, keys, fn, schema, log, **lookup).drop("attempt", "called_at")
    joined = join_distinct(df, table, keys, "left", null_safe=True, hot_rows=hot_rows)
    if observation is not None:
        joined = joined.observe(observation, F.count(F.col("error")).alias("skipped"), F.count(F.lit(1)).alias("rows"))
    return joined
