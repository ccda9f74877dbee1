"""File sources on any Hadoop-compatible store.

Listings are metadata; reads are Spark file scans, so selection and
filters reach the scan and every file is split across tasks.
"""

from __future__ import annotations

import csv
import datetime as _dt
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.paths import CSV_SUFFIXES, PARQUET_SUFFIXES, TEXT_SUFFIXES, file_format
from tessera.session import cut_lineage, error_condition
from tessera.sources.quoted_csv import read_by_header, read_quoted, still_quoted

# The tokens pandas' CSV reader treats as missing by default.
DEFAULT_NA = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
              "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

_INT_RE = r"^\s*[+-]?[0-9]+\s*$"
_FLOAT_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?(inf|Infinity|nan)\s*$"
_BOOL_RE = r"^(True|False|true|false|TRUE|FALSE)$"

LISTING_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("modificationTime", T.TimestampType(), True),
])


def _as_list(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def literal_path(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def source_path():
    """The file a row came from, in the same (decoded) form as ``list_files``.

    Spark's ``_metadata.file_path`` is URL-encoded; a literal ``+`` is kept
    by escaping it before decoding.
    """
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


# ------------------------------------------------------------------ listing

_STATUS_RE = re.compile(
    r"Status\{path=(.*?); isDirectory=(true|false)(?:; length=(\d+))?.*?; modification_time=(\d+);")
_DIR_BATCH = 1000
_STATUS_CHUNK = 20000


def statuses(spark: SparkSession, arr) -> list[tuple[str, bool, int, int]]:
    """Parse a Java ``FileStatus[]`` in a few calls: the JVM renders chunks of
    it as text (one round trip per chunk instead of several per object)."""
    jvm = spark.sparkContext._jvm
    gateway = spark.sparkContext._gateway
    n = len(arr)
    out = []
    for start in range(0, n, _STATUS_CHUNK):
        size = min(_STATUS_CHUNK, n - start)
        chunk = arr
        if size != n:
            chunk = gateway.new_array(jvm.org.apache.hadoop.fs.FileStatus, size)
            jvm.java.lang.System.arraycopy(arr, start, chunk, 0, size)
        text = jvm.org.apache.commons.lang3.ArrayUtils.toString(chunk)
        out += [(m.group(1), m.group(2) == "true", int(m.group(3) or 0), int(m.group(4)))
                for m in _STATUS_RE.finditer(text)]
    if len(out) != n:
        raise RuntimeError(f"could not parse {n - len(out)} file statuses")
    return out


def list_files(spark: SparkSession, root: str, prefix: str = "", include_empty: bool = True) -> DataFrame:
    """Objects whose key starts with ``root + prefix`` (a string prefix,
    not a directory: ``pre`` matches ``pre/a`` and ``prefix2/b``). Glob
    characters in ``prefix`` stand for themselves.

    ``include_empty=True`` lists through the Hadoop file system, which also
    returns zero-length objects and names starting with ``_`` or ``.``; it
    walks one directory level at a time, asking for up to 1000 directories
    per call, so the driver makes O(directories) calls, not several per
    object. ``include_empty=False`` uses the ``binaryFile`` source (its
    listing runs as a distributed job for many directories; it skips those
    objects and, with only path and length selected, reads no content).
    """
    pattern = root.rstrip("/") + "/" + literal_path(prefix) + "*" if prefix or not root.endswith("*") else root
    if not include_empty:
        return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern)
                .select("path", "length", "modificationTime"))
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    glob = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = glob.getFileSystem(conf)
    found = fs.globStatus(glob)
    files = walk(spark, fs, statuses(spark, found) if found is not None else [])
    rows = [(p, size, _dt.datetime.fromtimestamp(mt / 1000, _dt.timezone.utc)) for p, size, mt in files]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def walk(spark: SparkSession, fs, level: list[tuple[str, bool, int, int]]) -> list[tuple[str, int, int]]:
    """Files under the given statuses, one directory level per round of
    batched ``listStatus`` calls: ``(path, length, modification ms)``."""
    jvm = spark.sparkContext._jvm
    gateway = spark.sparkContext._gateway
    files = []
    while level:
        files += [(p, size, mt) for p, is_dir, size, mt in level if not is_dir]
        dirs = [p for p, is_dir, _, _ in level if is_dir]
        level = []
        for start in range(0, len(dirs), _DIR_BATCH):
            batch = dirs[start:start + _DIR_BATCH]
            arr = gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(batch))
            for i, d in enumerate(batch):
                arr[i] = jvm.org.apache.hadoop.fs.Path(d)
            level += statuses(spark, fs.listStatus(arr))
    return files


def arrow_lister(folder: str) -> Iterator[tuple[str, bool, int, float | None]]:
    """``(path, is a folder, length, modification seconds)`` of what a folder holds, through Arrow's file systems (local
    and shared folders, S3, GCS, ABFS, HDFS); paths are written as the folder's."""
    from pyarrow import fs

    if folder.startswith("file:"):
        system, inside = fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    elif re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", folder):
        system, inside = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", folder))
    else:
        system, inside = fs.LocalFileSystem(), folder
    for info in system.get_file_info(fs.FileSelector(inside, recursive=False, allow_not_found=True)):
        yield (f"{folder.rstrip('/')}/{info.base_name}", info.type == fs.FileType.Directory, int(info.size or 0),
               info.mtime.timestamp() if info.mtime else None)


def walk_files(spark: SparkSession, root: str, prefix: str = "", lister: Callable | None = None, tasks: int | None = None) -> DataFrame:
    """S1 without a listing on the driver: the rows of ``list_files``, found by tasks.

    The folders to be listed are a table, a work queue: each round deals them
    out to ``tasks`` tasks (as many as the cluster runs at once by default),
    writes what they hold to the shared checkpoint folder, and the folders
    among that are the next round's. Objects of any length and name are kept.
    The driver holds the number of folders left. ``lister`` lists one folder
    in a task, lazily (``arrow_lister`` by default); a folder's rows leave the
    task in batches, so one with very many objects fills no memory unless the
    lister does.
    """
    import pyarrow as pa

    lister = lister or arrow_lister
    tasks = tasks or spark.sparkContext.defaultParallelism
    base, _, stem = prefix.rpartition("/")
    top = f"{root.rstrip('/')}/{base}".rstrip("/") or "/"
    start = f"{top.rstrip('/')}/{stem}"

    def listed(batches):
        names = ["path", "folder", "length", "modified"]
        types = [pa.string(), pa.bool_(), pa.int64(), pa.float64()]
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                held = []
                for entry in lister(folder):
                    if entry[0].startswith(start):
                        held.append(entry)
                    if len(held) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

    queue, rounds = spark.createDataFrame([(top,)], "path string"), []
    while True:
        seen = Observation()
        found = queue.repartition(tasks).mapInArrow(listed, "path string, folder boolean, length long, modified double")
        found = cut_lineage(found.observe(seen, F.count(F.when(F.col("folder"), 1)).alias("folders")))
        rounds.append(found.where("NOT folder").select(
            "path", "length", F.timestamp_micros((F.col("modified") * 1_000_000).cast("long")).alias("modificationTime")))
        if not seen.get["folders"]:
            break
        queue = found.where("folder").select("path")
    while len(rounds) > 1:
        rounds = [a.unionAll(b) for a, b in zip(rounds[::2], rounds[1::2])] + rounds[len(rounds) // 2 * 2:]
    return rounds[0]


# --------------------------------------------------------------------- CSV

def _null_tokens(df: DataFrame, na_tokens) -> DataFrame:
    toks = list(na_tokens)
    return df.select(*[F.when(F.col(f"`{c}`").isin(toks), F.lit(None)).otherwise(F.col(f"`{c}`")).alias(c)
                       for c in df.columns])


def infer_types(df: DataFrame) -> dict[str, T.DataType]:
    """One aggregation pass choosing BIGINT -> DOUBLE -> BOOLEAN -> STRING per
    string column, as pandas would (an all-missing column stays STRING).

    Each value becomes a bit mask of the types it parses as (1 integer,
    2 double, 4 boolean); AND-ing the masks of a column keeps the types
    every value allows, so one aggregate per column decides.
    """
    if not df.columns:
        return {}
    aggs = []
    for i, c in enumerate(df.columns):
        v = F.col(f"`{c}`")
        is_int = v.rlike(_INT_RE) & v.try_cast("bigint").isNotNull()
        is_dbl = v.rlike(_FLOAT_RE) & v.try_cast("double").isNotNull()
        is_bool = v.rlike(_BOOL_RE)
        mask = (F.when(is_int, 1).otherwise(0) + F.when(is_dbl, 2).otherwise(0)
                + F.when(is_bool, 4).otherwise(0))
        aggs.append(F.bit_and(F.when(v.isNotNull(), mask)).alias(f"m{i}"))
    row = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(df.columns):
        m = row[i]
        if m is None:
            out[c] = T.StringType()
        elif m & 1:
            out[c] = T.LongType()
        elif m & 2:
            out[c] = T.DoubleType()
        elif m & 4:
            out[c] = T.BooleanType()
        else:
            out[c] = T.StringType()
    return out


def _apply_types(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    cols = []
    for c in df.columns:
        v = F.trim(F.col(f"`{c}`"))
        t = types.get(c, T.StringType())
        if isinstance(t, T.BooleanType):
            cols.append(F.lower(v).try_cast("boolean").alias(c))
        elif isinstance(t, T.StringType):
            cols.append(F.col(f"`{c}`").alias(c))
        else:
            cols.append(v.try_cast(t).alias(c))
    return df.select(*cols)


def read_csv(spark: SparkSession, paths, na_tokens=DEFAULT_NA, schema: T.StructType | None = None,
             infer: bool = True, multi_line: bool = True, strict: bool = False,
             columns: list[str] | None = None, split_quoted: bool = False) -> DataFrame:
    """CSV with a header row, UTF-8, quoted newlines and doubled quotes.

    All files given together must share one header (see ``read_many`` for
    mixed headers). Fields are read as text, NA tokens become NULL, then each
    column is typed from one aggregation pass unless ``schema`` is given; a
    value that does not fit the schema is NULL, or an error with
    ``strict=True``.
    Quoted newlines need ``multi_line`` parsing, which reads each file in one
    task; for large files known to hold none, ``multi_line=False`` lets Spark
    split every file across tasks, and ``split_quoted=True`` does so with
    quoted newlines too (one more pass over the lines finds where records
    begin; lines end with a line feed). ``columns`` gives header names already
    known, which saves reading them again.
    """
    reader = (spark.read.option("header", "true").option("multiLine", str(multi_line).lower())
              .option("escape", '"').option("encoding", "UTF-8").option("inferSchema", "false"))
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    raw = reader.csv(_as_list(paths))
    if split_quoted:
        raw = read_quoted(spark, _as_list(paths), raw.columns)
    raw = _null_tokens(raw, na_tokens)
    if schema is not None:
        return raw.select(*[_typed(f, strict) for f in schema.fields])
    if not infer:
        return raw
    return _apply_types(raw, infer_types(raw))


def _header_names(header: str) -> list[str] | None:
    """Column names of a header line, or None where Spark should find them (quoted line feeds, odd names)."""
    if header.count('"') % 2 or header.startswith("\ufeff"):
        return None
    names = next(csv.reader([header]), [])
    return names if all(n.strip() == n and n for n in names) and len({n.lower() for n in names}) == len(names) else None


def _typed(field: T.StructField, strict: bool):
    value = F.col(f"`{field.name}`")
    out = value.try_cast(field.dataType)
    if strict:
        said = F.concat(F.lit(f"column {field.name} does not hold a {field.dataType.simpleString()}: "), value)
        out = F.when(value.isNotNull() & out.isNull(), F.raise_error(said).cast(field.dataType)).otherwise(out)
    return out.alias(field.name)


def csv_header(spark: SparkSession, path: str) -> str:
    """The first record of one file (a line, or more if line feeds are quoted), read through the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine() or ""
        lines, quoted = [line], still_quoted(line, False)
        while quoted and (line := reader.readLine()) is not None:
            lines.append(line)
            quoted = still_quoted(line, True)
        return "\n".join(lines)
    finally:
        stream.close()


def _headers(spark: SparkSession, paths: list[str], threads: int = 32) -> list[str]:
    """First lines of files: one small read of each, ``threads`` at a time.

    Only the first block of a file is touched, whatever its size; the driver
    holds one line for each file.
    """
    if len(paths) <= 1:
        return [csv_header(spark, p) for p in paths]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(threads, len(paths))) as pool:
        return list(pool.map(lambda p: csv_header(spark, p), paths))


# ----------------------------------------------------------------- parquet

def read_parquet(spark: SparkSession, paths, merge_schema: bool = False) -> DataFrame:
    """S3: Parquet files, all columns (pruned by Spark to what is used)."""
    r = spark.read
    if merge_schema:
        r = r.option("mergeSchema", "true")
    return r.parquet(*_as_list(paths))


# -------------------------------------------------------------- json / text

def read_json_docs(spark: SparkSession, paths, schema: T.StructType | None = None,
                   one_per_file: bool = True) -> DataFrame:
    """One JSON document per file -> ``(path, doc)``.

    ``doc`` is a VARIANT (schemaless) or, with ``schema``, a typed struct.
    ``one_per_file=False`` reads one document per line instead, the layout
    ``write_json_docs`` produces (files split across tasks).
    """
    raw = spark.read.text(_as_list(paths), wholetext=one_per_file)
    doc = F.from_json("value", schema) if schema is not None else F.parse_json("value")
    return raw.select(source_path().alias("path"), doc.alias("doc"))


def read_lines(spark: SparkSession, paths, with_path: bool = False) -> DataFrame:
    """Text lines of ``.txt`` objects; any other suffix is an error.

    Lines split on ``\\n``, ``\\r\\n`` and ``\\r``. Rows carry no order; keep
    ``with_path`` when the source file matters.
    """
    ps = _as_list(paths)
    bad = [p for p in ps if not p.endswith(TEXT_SUFFIXES)]
    if bad:
        raise ValueError(f"not a text object (expected {' or '.join(TEXT_SUFFIXES)}): {bad[0]}")
    df = spark.read.text(ps)
    if with_path:
        return df.select(source_path().alias("path"), "value")
    return df


# ---------------------------------------------------------------- many

def _paths_of(spark: SparkSession, paths_or_listing) -> tuple[list[str], bool]:
    """Paths, and whether they are known to be files (a listing frame)."""
    if isinstance(paths_or_listing, DataFrame):
        # file names only: the listing is metadata the file index holds anyway
        return [r[0] for r in paths_or_listing.select("path").collect()], True
    return _as_list(paths_or_listing), False


def _expand_dirs(spark: SparkSession, paths: list[str]) -> list[str]:
    """Data files behind the given paths: a directory written by a Spark
    sink (``x.csv/part-...``) stands for its files; ``_`` and ``.`` files
    (markers, checksums) inside it are skipped."""
    if not paths:
        return []
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        found = fs.globStatus(hp)
        st = statuses(spark, found) if found is not None else []
        if not st:
            raise FileNotFoundError(p)
        for f, _, _ in walk(spark, fs, st):
            name = f.rsplit("/", 1)[-1]
            if not name.startswith(("_", ".")):
                out.append(f)
    return out


def _by_schema(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Parquet files whose column types conflict: one scan for each distinct schema, whether a path names a file, a
    directory or a glob."""
    from concurrent.futures import ThreadPoolExecutor
    files = _expand_dirs(spark, paths)
    with ThreadPoolExecutor(max_workers=min(32, max(len(files), 1))) as pool:  # footers only
        schemas = list(pool.map(lambda f: spark.read.parquet(literal_path(f)).schema, files))
    groups: dict[str, list[int]] = {}
    for i, schema in enumerate(schemas):
        groups.setdefault(schema.json(), []).append(i)
    return [spark.read.schema(schemas[own[0]]).parquet(*[literal_path(files[i]) for i in own]) for own in groups.values()]


def read_many(spark: SparkSession, paths_or_listing, na_tokens=DEFAULT_NA, multi_line: bool = True,
              infer: bool = True, split_quoted: bool = False, one_scan: bool = False) -> DataFrame:
    """Read many objects by suffix and concatenate them by column name.

    CSV files are grouped by header line (one scan per distinct header, so
    differing headers never misalign); Parquet files are read in one scan
    with schema merging, or one scan per distinct schema when types conflict.
    Other suffixes are ignored. No match gives an empty frame. A listed
    object whose name starts with ``_`` or ``.`` is an error, since Spark's
    readers would skip it. ``infer=False`` leaves CSV columns as text and
    saves the typing pass; ``multi_line`` and ``split_quoted`` are those of
    ``read_csv``.

    ``one_scan=True`` reads CSV files of all headers together, in a plan that
    does not grow with their number: records are found as with
    ``split_quoted``, parsed by position, named by their file's header, and
    all columns are typed in one aggregate (a column that is not numbers in
    every file keeps its text as written).
    """
    from tessera.operators.reshape import union_all_by_name
    paths, all_files = _paths_of(spark, paths_or_listing)
    if all_files:
        hidden = [p for p in paths if p.rsplit("/", 1)[-1].startswith(("_", "."))
                  and p.endswith((*CSV_SUFFIXES, *PARQUET_SUFFIXES))]
        if hidden:
            raise ValueError(f"readers skip names starting with _ or .: {hidden[0]}")
    csv_paths = [p for p in paths if p.rstrip("/").endswith(CSV_SUFFIXES)]
    csvs = csv_paths if all_files else _expand_dirs(spark, csv_paths)
    parquets = [p for p in paths if p.rstrip("/").endswith(PARQUET_SUFFIXES)]
    frames: list[DataFrame] = []
    by_header: dict[str, list[str]] = {}
    if one_scan and csvs:
        text = _null_tokens(read_by_header(spark, [literal_path(p) for p in csvs]), na_tokens)
        frames.append(_apply_types(text, infer_types(text)) if infer else text)
        csvs = []
    for p, header in zip(csvs, _headers(spark, csvs)):
        by_header.setdefault(header, []).append(p)
    for header, group in by_header.items():
        frames.append(read_csv(spark, [literal_path(p) for p in group], na_tokens, infer=infer, multi_line=multi_line,
                               columns=_header_names(header), split_quoted=split_quoted))
    if parquets:
        # one path may be a glob or a directory of several schemas, so they are always merged
        parquets = [literal_path(p) for p in parquets] if all_files else parquets
        try:
            frames.append(read_parquet(spark, parquets, merge_schema=True))
        except Exception as e:
            if not (error_condition(e) or "").startswith("CANNOT_MERGE"):
                raise
            frames.extend(_by_schema(spark, parquets))
    if not frames:
        return spark.createDataFrame([], T.StructType([]))
    return union_all_by_name(frames)


def formats_of(listing: DataFrame, path_col: str = "path") -> DataFrame:
    """P14 over a listing: the reader format of each object (NULL = skipped)."""
    return listing.withColumn("format", file_format(path_col))
