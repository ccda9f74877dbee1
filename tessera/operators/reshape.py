"""Reshaping operators: ranked explode, vocabulary, multi-hot, unions,
row index and positional zip (A1, A2, A3, U1, U2, U3, P10, J1)."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import as_column as _col
from pyspark.sql import types as T

from tessera.session import cut_lineage


def _keep(df: DataFrame, drop: set[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns if c not in drop]


# ------------------------------------------------------------------ arrays

def explode_ranked(df: DataFrame, col: str, rank: str = "address_rank", value: str | None = None,
                   keep_source: bool = False) -> DataFrame:
    """A1: one row per array element with its 0-based position.

    Rows whose array is NULL or empty produce no row (the reference's empty
    response adds nothing).
    """
    value = value or col
    drop = set() if keep_source else {col}
    return df.select(*_keep(df, drop), F.posexplode(col).alias(rank, value))


def array_vocabulary(df: DataFrame, col: str, name: str = "label") -> DataFrame:
    """Distinct non-NULL elements of an array column, as a frame."""
    return (df.select(F.explode(col).alias(name)).where(F.col(name).isNotNull())
            .distinct())


def collect_vocabulary(df: DataFrame, col: str, max_labels: int | None = None) -> list[str]:
    """Distinct labels to the driver, sorted; fails beyond ``max_labels`` if given.

    The result decides the output schema of ``multi_hot``, so it must be
    known at plan time; it is as small as a list of columns has to be.
    """
    found = array_vocabulary(df, col)
    if max_labels is None:
        return sorted(r[0] for r in found.collect())
    # sorted top-k: one job with a per-partition limit (a bare limit would
    # run Spark's incremental take, several jobs)
    rows = found.orderBy("label").limit(max_labels + 1).collect()
    if len(rows) > max_labels:
        raise ValueError(f"more than {max_labels} distinct labels in {col}; pass vocabulary=")
    return sorted(r[0] for r in rows)


_MASK_BITS = 31
# Up to this many labels a membership test per label is used (about 190
# bytes of generated code each, below the 8000-byte JIT limit in total).
_DIRECT_LABELS = 32


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _as_text(df: DataFrame, col: str, labels: list, element: T.DataType) -> list[str]:
    """Labels as Spark writes their type as text."""
    rows = df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(labels)],
                                           T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", element)]))
    return [r["v"] for r in rows.select("i", F.col("v").cast("string").alias("v")).orderBy("i").collect()]


def multi_hot(df: DataFrame, col: str, vocabulary: list | None = None,
              max_labels: int | None = None, drop: bool = True) -> DataFrame:
    """A3: one 0/1 INT column per label.

    Up to 32 labels, each column is a membership test. Beyond that, each
    row's array is folded once into INT masks (31 labels each): an element
    sets the bit of its label's position, and every label column is a shift
    and a mask, so the generated code stays small however many labels there
    are. A NULL array, NULL elements and unknown elements give 0. A label
    equal to an existing column name is rejected. Labels that are no text
    (numbers, dates) are compared and named as Spark casts them to text; with
    ``drop=False`` the array column then stays as text.
    """
    element = df.schema[col].dataType.elementType
    if not isinstance(element, T.StringType):
        if vocabulary is not None:
            vocabulary = _as_text(df, col, list(vocabulary), element)
        df = df.withColumn(col, F.col(f"`{col}`").cast("array<string>"))
    labels = list(vocabulary) if vocabulary is not None else collect_vocabulary(df, col, max_labels)
    clash = set(labels) & (set(df.columns) - {col})
    if clash:
        raise ValueError(f"labels collide with columns: {sorted(clash)}")
    if len(set(labels)) != len(labels):
        raise ValueError("duplicate labels")
    keep = _keep(df, {col} if drop else set())
    if len(labels) <= _DIRECT_LABELS:
        # one membership test per label: fastest while the code stays small
        flags = [F.coalesce(F.array_contains(col, F.lit(v)), F.lit(False)).cast("int").alias(v)
                 for v in labels]
        return df.select(*keep, *flags)
    ref = "`" + col.replace("`", "``") + "`"
    masks = []
    for k in range(0, len(labels), _MASK_BITS):
        chunk = "array(" + ", ".join(_sql_str(v) for v in labels[k:k + _MASK_BITS]) + ")"
        pos = f"coalesce(CAST(array_position({chunk}, e) AS INT), 0)"
        masks.append(F.expr(
            f"coalesce(aggregate(coalesce({ref}, array()), 0, "
            f"(acc, e) -> CASE WHEN {pos} > 0 THEN acc | shiftleft(1, {pos} - 1) ELSE acc END), "
            f"0)"  # non-nullable: the flag code needs no null branches
        ).alias(f"__mh{k // _MASK_BITS}"))
    staged = df.select(*[F.col(f"`{c}`") for c in df.columns], *masks)
    flags = [F.shiftright(F.col(f"__mh{i // _MASK_BITS}"), i % _MASK_BITS).bitwiseAND(1).alias(v)
             for i, v in enumerate(labels)]
    return staged.select(*keep, *flags)


# ------------------------------------------------------------------ unions

_NUMERIC_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4,
                 T.FloatType: 6, T.DoubleType: 7}


def _nullable(t: T.DataType) -> T.DataType:
    """The type with every element and field nullable."""
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_nullable(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(_nullable(t.keyType), _nullable(t.valueType), True)
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in t.fields])
    return t


# digits an integer type needs as a decimal
_INTEGER_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def _common_type(types: list[T.DataType]) -> T.DataType:
    types = [_nullable(t) for t in types if not isinstance(t, T.NullType)]
    if not types:
        return T.NullType()
    first = types[0]
    if all(t == first for t in types):
        return first
    if all(type(t) in _NUMERIC_RANK or isinstance(t, T.DecimalType) for t in types):
        decimals = [t for t in types if isinstance(t, T.DecimalType)]
        if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in types):
            return T.DoubleType()
        if decimals:
            scale = max(t.scale for t in decimals)
            whole = max([t.precision - t.scale for t in decimals]
                        + [_INTEGER_DIGITS[type(t)] for t in types if not isinstance(t, T.DecimalType)])
            # beyond 38 digits no decimal holds every value: text does
            return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
        return max(types, key=lambda t: _NUMERIC_RANK[type(t)])
    return T.StringType()


def union_all_by_name(frames: list[DataFrame]) -> DataFrame:
    """Multiset union by column name; missing columns are NULL.

    Columns whose types differ are cast to one common type first (integers
    and decimals widen exactly, a float makes DOUBLE, anything else becomes
    STRING) so no implicit cast can raise. Names that differ in case only are
    one column unless ``spark.sql.caseSensitive`` is set; the first spelling
    stays.
    The unions are combined as a balanced tree to keep analysis cheap when
    there are many inputs.
    """
    if not frames:
        raise ValueError("no frames to union")
    exact = frames[0].sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    key = (lambda n: n) if exact else str.lower
    seen: dict[str, list[T.DataType]] = {}
    spelled: dict[str, str] = {}
    for f in frames:
        for fld in f.schema.fields:
            spelled.setdefault(key(fld.name), fld.name)
            seen.setdefault(key(fld.name), []).append(fld.dataType)
    target = {n: _common_type(ts) for n, ts in seen.items()}
    aligned = []
    for f in frames:
        cols = []
        for fld in f.schema.fields:
            c, t = F.col(f"`{fld.name}`"), target[key(fld.name)]
            cols.append((c if _nullable(fld.dataType) == t else c.cast(t)).alias(spelled[key(fld.name)]))
        aligned.append(f.select(*cols))
    while len(aligned) > 1:
        nxt = [a.unionByName(b, allowMissingColumns=True)
               for a, b in zip(aligned[0::2], aligned[1::2])]
        if len(aligned) % 2:
            nxt.append(aligned[-1])
        aligned = nxt
    return aligned[0]


# --------------------------------------------------------------- row index

def with_row_index(df: DataFrame, name: str = "ColumnIndex", order_by=None) -> DataFrame:
    """P10: a dense 0-based row index, computed without a single-task window.

    With ``order_by``, rows are range-partitioned and sorted by the keys (ties
    broken by the scan position), each partition numbers its rows locally,
    and the numbered rows are checkpointed to the shared checkpoint folder:
    the partition layout is then fixed (a recomputed range shuffle could
    sample different bounds) and survives executor loss. The row count of
    every earlier partition is added as an offset; the counts form a table
    with one row per partition, so joining it back is a broadcast of known
    size. Without ``order_by`` the scan order is used; a frame that only
    projects a Parquet scan is then numbered by file path and position in the
    file, from the files' row counts (footers), with no sort, no write and no
    shuffle of its rows.
    """
    if order_by is None and _projects_parquet(df):
        return _scan_index(df, name)
    tie = "__ri_tie"
    pid, local = "__ri_pid", "__ri_local"
    base = df.withColumn(tie, F.monotonically_increasing_id())
    if order_by is not None:
        keys = [_col(c) for c in (order_by if isinstance(order_by, (list, tuple)) else [order_by])]
        base = base.orderBy(*keys, F.col(tie))
    numbered = cut_lineage(base.withColumn(pid, F.spark_partition_id())
                           .withColumn(local, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    counts = numbered.groupBy(pid).agg(F.count(F.lit(1)).alias("__ri_n"))
    offsets = counts.select(
        pid,
        (F.sum("__ri_n").over(Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__ri_off"))
    out = numbered.join(F.broadcast(offsets), pid, "inner")
    idx = (F.coalesce(F.col("__ri_off"), F.lit(0)) + F.col(local)).alias(name)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], idx)


MAX_BROADCAST_FILES = 500_000


def _projects_parquet(df: DataFrame) -> bool:
    """Whether every row of the frame is one row of a Parquet scan, in a place that ``_metadata`` tells."""
    if "_metadata" in (c.lower() for c in df.columns):
        return False
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "SubqueryAlias", "View"):
        node = node.children().apply(0)
    if node.nodeName() != "LogicalRelation":
        return False
    relation = node.relation()
    return (relation.getClass().getSimpleName() == "HadoopFsRelation"
            and relation.fileFormat().getClass().getSimpleName() == "ParquetFileFormat")


def _scan_index(df: DataFrame, name: str) -> DataFrame:
    """Position in the file plus the rows of all files before it; both come with the scan."""
    at, file = "__ri_at", "__ri_file"
    placed = df.select("*", F.col("_metadata.row_index").alias(at), F.col("_metadata.file_path").alias(file))
    # reads no column, so the counts come from the footers; one row for each file
    counts = placed.groupBy(file).agg(F.count(F.lit(1)).alias("__ri_n"))
    before = F.sum("__ri_n").over(Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(file, F.coalesce(before, F.lit(0)).alias("__ri_off"))
    if len(df.inputFiles()) <= MAX_BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    return placed.join(offsets, file, "inner").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("__ri_off") + F.col(at)).alias(name))


def zip_rows(a: DataFrame, b: DataFrame, order_a=None, order_b=None,
             index: str = "ColumnIndex", keep_index: bool = False) -> DataFrame:
    """Positional inner join of two frames (surplus rows are dropped).

    Positions come from ``with_row_index`` over each frame's own order, so
    the pairing is defined even though Spark frames carry no row order.
    """
    left = with_row_index(a, index, order_a)
    right = with_row_index(b, index, order_b)
    out = left.join(right, index, "inner")
    return out if keep_index else out.drop(index)
