"""Warehouse tables through JDBC or the Spark catalog.

SQL text meant for a remote database passes through unchanged; Spark pushes
filters and column pruning into the JDBC scan on top of it. Partitioned
reads wrap the SQL as a subquery so the read is split into
``numPartitions`` range queries instead of one connection.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import error_condition
from tessera.sources.files import literal_path, source_path
from tessera.sources.store import list_tree, move_files, qualified_path, read_text, remove_files, write_text

IF_EXISTS_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


@dataclass(frozen=True)
class JdbcPartition:
    """Range split of a JDBC read on a numeric/date column."""
    column: str
    lower: int | str | None = None
    upper: int | str | None = None
    num_partitions: int = 8


def _quote_ident(name: str) -> str:
    """Plain names as they are (databases fold their case); others in double quotes."""
    return ".".join(p if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_$]*", p) else '"' + p.replace('"', '""') + '"'
                    for p in name.split("."))


def _catalog_ident(name: str) -> str:
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


# --------------------------------------------------------------------- read

def read_query(spark: SparkSession, jdbc: dict, sql: str,
               partition: JdbcPartition | None = None) -> DataFrame:
    """Run ``sql`` on the remote database as a Spark frame.

    Without ``partition`` Spark's ``query`` option is used (one partition).
    With it, the SQL becomes ``(sql) q`` and is split on ``partition.column``;
    missing bounds are fetched with one MIN/MAX query.
    """
    reader = spark.read.format("jdbc").options(**jdbc)
    if partition is None:
        return reader.option("query", sql).load()
    sub = f"({sql}) q"
    lower, upper = partition.lower, partition.upper
    if lower is None or upper is None:
        col = _quote_ident(partition.column)
        b = (spark.read.format("jdbc").options(**jdbc)
             .option("query", f"SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM ({sql}) b").load().first())
        lower = b[0] if lower is None else lower
        upper = b[1] if upper is None else upper
        if lower is None:  # empty result: any bounds do
            lower, upper = 0, 1
    return (reader.option("dbtable", sub)
            .option("partitionColumn", partition.column)
            .option("lowerBound", str(lower)).option("upperBound", str(upper))
            .option("numPartitions", str(partition.num_partitions)).load())


def sql_query(spark: SparkSession, sql: str, args: dict | None = None,
              views: dict[str, DataFrame] | None = None) -> DataFrame:
    """S7c on catalog data: run ``sql`` with ``views`` as temp views.

    The views last for the analysis of ``sql`` only: the returned frame holds
    their plans, and session views of the same names are as before.
    """
    before = {}
    for name in views or {}:
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary:
            before[name] = spark.table(name)
    try:
        for name, df in (views or {}).items():
            df.createOrReplaceTempView(name)
        return spark.sql(sql, args=args) if args else spark.sql(sql)
    finally:
        for name in views or {}:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


# -------------------------------------------------------------------- write

def write_table(df: DataFrame, target: str, if_exists: str = "fail", jdbc: dict | None = None,
                column_types: dict[str, str] | None = None, partition_by: list[str] | None = None,
                max_connections: int = 16, batch_size: int = 10_000, index: str | None = None,
                index_order=None) -> None:
    """Write with ``fail`` / ``replace`` / ``append``.

    ``jdbc`` given: a JDBC table (``replace`` drops and recreates, as
    pandas does; ``column_types`` become ``createTableColumnTypes``). Each
    partition writes over its own connection, so at most
    ``max_connections`` partitions write at once (Spark coalesces to that
    many), in batches of ``batch_size`` rows. Otherwise a catalog table
    (``saveAsTable``), its columns cast to ``column_types``. ``index`` names a 0-based row-index column to add
    first (the pandas ``index=True`` of the original), numbered in
    ``index_order`` or scan order (P10).
    """
    if if_exists not in IF_EXISTS_MODES:
        raise ValueError(f"if_exists must be one of {sorted(IF_EXISTS_MODES)}")
    if index is not None:
        from tessera.operators.reshape import with_row_index
        df = with_row_index(df, index, index_order)
    mode = IF_EXISTS_MODES[if_exists]
    if jdbc is not None:
        w = (df.write.format("jdbc").options(**jdbc).option("dbtable", _quote_ident(target)).mode(mode)
             .option("numPartitions", str(max_connections)).option("batchsize", str(batch_size)))
        if column_types:
            w = w.option("createTableColumnTypes",
                         ", ".join(f"{_quote_ident(c)} {t}" for c, t in column_types.items()))
        if if_exists == "replace":
            w = w.option("truncate", "false")
        w.save()
        return
    if column_types:
        unknown = set(column_types) - set(df.columns)
        if unknown:
            raise ValueError(f"column_types names no column: {sorted(unknown)}")
        df = df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in column_types.items()})
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(target)


def truncate_table(spark: SparkSession, target: str, jdbc: dict | None = None) -> None:
    """K6: remove all rows, keep the table definition (a remote table gets a
    ``TRUNCATE TABLE`` statement)."""
    if jdbc is not None:
        jdbc_execute(spark, jdbc, f"TRUNCATE TABLE {_quote_ident(target)}")
        return
    if spark.catalog.tableExists(target):
        spark.sql(f"TRUNCATE TABLE {_catalog_ident(target)}")


_CONNECTION_KEYS = {"url", "driver", "dbtable", "query"}


def jdbc_execute(spark: SparkSession, jdbc: dict, stmt: str) -> int:
    """Run one statement on the remote database from the driver.

    Spark's JDBC source reads and writes tables but runs no DDL/DML, so
    statements go through ``java.sql.DriverManager`` in the driver JVM; the
    database does the work and only an update count comes back.
    """
    jvm = spark.sparkContext._jvm
    if "driver" in jdbc:
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        jvm.java.lang.Class.forName(jdbc["driver"], True, loader)
    props = jvm.java.util.Properties()
    for k, v in jdbc.items():
        if k not in _CONNECTION_KEYS:
            props.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(jdbc["url"], props)
    try:
        st = conn.createStatement()
        try:
            return int(st.executeUpdate(stmt))
        finally:
            st.close()
    finally:
        conn.close()


def drop_table(spark: SparkSession, target: str, jdbc: dict | None = None) -> None:
    """Drop a table: a catalog table if present (F7, ``IF EXISTS``), or a
    remote one."""
    if jdbc is not None:
        jdbc_execute(spark, jdbc, f"DROP TABLE {_quote_ident(target)}")
        return
    spark.sql(f"DROP TABLE IF EXISTS {_catalog_ident(target)}")


def run_statement(spark: SparkSession, stmt: str, jdbc: dict | None = None):
    """Any other statement: Spark SQL on the catalog (returns a frame),
    or passed unchanged to the remote database (returns the update count)."""
    if jdbc is not None:
        return jdbc_execute(spark, jdbc, stmt)
    return spark.sql(stmt)


def keep_unless(df: DataFrame, predicate: Column | str) -> DataFrame:
    """K7b as a frame: the rows a ``DELETE ... WHERE predicate`` leaves.

    SQL ``DELETE`` keeps rows whose predicate is NULL, hence the coalesce.
    """
    pred = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.filter(~F.coalesce(pred, F.lit(False)))


def delete_where(spark: SparkSession, target: str, predicate: Column | str,
                 jdbc: dict | None = None) -> None:
    """Delete matching rows of a table.

    Remote tables (``jdbc``, SQL text predicate) get a ``DELETE`` statement.
    Of Parquet and ORC tables only the files that hold a matching row are
    rewritten; the others keep their names. The predicate must be
    deterministic, and readers that run during the swap may see rows of old
    and new files. Other catalog tables that support ``DELETE`` get it; the
    rest are rewritten in place: kept rows go to ``<name>__kept`` first (Spark
    cannot overwrite a table it reads) and stay there if the rewrite fails.
    """
    if jdbc is not None:
        if not isinstance(predicate, str):
            raise ValueError("a remote delete needs the predicate as SQL text")
        jdbc_execute(spark, jdbc, f"DELETE FROM {_quote_ident(target)} WHERE {predicate}")
        return
    ident = _catalog_ident(target)
    place = _file_table(spark, target)
    if place is not None:
        _delete_in_files(spark, target, predicate, *place)
        return
    if isinstance(predicate, str):
        try:
            spark.sql(f"DELETE FROM {ident} WHERE {predicate}")
            return
        except Exception as e:  # sources without deletes
            if not (error_condition(e) or "").startswith("UNSUPPORTED_FEATURE"):
                raise
    staging = f"{target}__kept"
    if spark.catalog.tableExists(staging):
        raise ValueError(f"{staging} exists (rows kept by an earlier delete?); move it away first")
    keep_unless(spark.table(target), predicate).write.saveAsTable(staging)
    # the table itself stays, with its format, partitioning, properties and place; static: partitions left empty go too
    (spark.table(staging).write.option("partitionOverwriteMode", "static").insertInto(target, overwrite=True))
    spark.sql(f"DROP TABLE {_catalog_ident(staging)}")


_SELF_DESCRIBING = {"parquet", "orc"}
_DELETE_DIR = "_delete_"


def _file_table(spark: SparkSession, target: str) -> tuple[str, str, list[str]] | None:
    """Format, location and partition columns of a plain Parquet or ORC table; None for every other one."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_catalog_ident(target)}").collect()}
    columns = spark.catalog.listColumns(target)
    if (facts.get("Provider") or "").lower() not in _SELF_DESCRIBING or facts.get("Type") not in ("MANAGED", "EXTERNAL"):
        return None
    if any(c.isBucket for c in columns) or not facts.get("Location"):
        return None
    return facts["Provider"].lower(), facts["Location"], [c.name for c in columns if c.isPartition]


def _delete_in_files(spark: SparkSession, target: str, predicate: Column | str, kind: str, location: str, parts: list[str]) -> None:
    """Rewrite only the files that hold a matching row.

    Files are found by ``_metadata.file_path`` of the matching rows (filters
    reach the footers' statistics, so most are not read). What their rows
    leave is written to a folder inside the table that readers skip, together
    with a manifest of files to add and to remove; then the new files are
    moved in and the old ones removed. ``finish_delete`` carries out a
    manifest that a lost driver left behind.
    """
    finish_delete(spark, target)
    rows = spark.table(target)
    match = F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))
    touched = sorted(r[0] for r in rows.where(match).select(source_path().alias("f")).distinct().collect())
    if not touched:
        return
    root = qualified_path(spark, location)
    if not all(f.startswith(root.rstrip("/") + "/") for f in touched):
        raise ValueError(f"{target} has partitions outside {root}; delete by rewriting the partition")
    staging = f"{root.rstrip('/')}/{_DELETE_DIR}{uuid.uuid4().hex}"
    old = (spark.read.format(kind).schema(rows.schema).option("basePath", root).load([literal_path(f) for f in touched]))
    w = keep_unless(old.select(rows.columns), predicate).write.format(kind)
    (w.partitionBy(*parts) if parts else w).save(f"{staging}/rows")
    added = [f for f, _, _ in list_tree(spark, f"{staging}/rows") if not f.rsplit("/", 1)[-1].startswith(("_", "."))]
    write_text(spark, f"{staging}/manifest", json.dumps({"remove": touched, "rows": f"{staging}/rows", "add": added}))
    _carry_out(spark, staging)
    spark.catalog.refreshTable(target)


def _carry_out(spark: SparkSession, staging: str) -> None:
    """Move a manifest's files in and remove the old ones; repeating it changes nothing."""
    todo = json.loads(read_text(spark, f"{staging}/manifest"))
    root, rows = staging.rsplit("/", 1)[0], todo["rows"]
    move_files(spark, [(f, root + f[len(rows):]) for f in todo["add"]])
    remove_files(spark, todo["remove"])
    remove_files(spark, [staging])


def finish_delete(spark: SparkSession, target: str) -> int:
    """Carry out deletes of a file table that were written but not finished; gives their number."""
    place = _file_table(spark, target)
    if place is None:
        return 0
    root, done = qualified_path(spark, place[1]).rstrip("/"), 0
    for f, _, _ in list_tree(spark, root, only=_DELETE_DIR):
        if f.endswith("/manifest") and f.count("/") == root.count("/") + 2:
            _carry_out(spark, f.rsplit("/", 1)[0])
            done += 1
    if done:
        spark.catalog.refreshTable(target)
    return done
