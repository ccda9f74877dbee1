"""One CSV file with quoted line feeds, parsed by many tasks.

Spark's own ``multiLine`` reader takes a file in one task, because a line feed
ends a record only outside quotes, and whether a byte range begins inside
quotes depends on everything before it. Here every range of a file says what
its lines do to either state: a physical line begins either a record or inside
a quoted field, so a range is a function on two states, one of four: keep,
swap, or end in a fixed state. These functions compose associatively; a window
over the ranges of each file (a few rows for each gigabyte) gives the state in
which each range begins. From then on record starts are known everywhere: the
lines of records that cross a range are stitched together, all others are
assembled and parsed range by range.
"""

from __future__ import annotations

import csv
import io
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

MAX_BROADCAST_RANGES = 200_000
_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}


def still_quoted(line: str, quoted: bool, sep: str = ",") -> bool:
    """Whether a line that begins inside quotes (or with a record) ends inside quotes.

    Quotes open a field at its first character only and are doubled inside;
    what follows a closing quote belongs to the field up to the separator.
    """
    at = 0
    while True:
        if quoted:
            at = line.find('"', at)
            if at < 0:
                return True
            if line[at + 1:at + 2] == '"':
                at += 2
                continue
        elif line[at:at + 1] == '"':
            quoted, at = True, at + 1
            continue
        at = line.find(sep, at)
        if at < 0:
            return False
        quoted, at = False, at + len(sep)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, str]]:
    for batch in batches:
        yield from zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), batch.column("rid").to_pylist(),
                       batch.column("value").to_pylist())


_RANGE = "file string, start long, first_rid long, from_record boolean, from_quoted boolean, close_quoted long, open_record long, open_quoted long"


def _summary(sep: str):
    """Lines of ranges to one row a range (``_RANGE``): its function on the two states, the line that closes a field
    open at its begin, and the line where the record open at its end begins, for either state."""
    names = [f.split()[0] for f in _RANGE.split(", ")]

    def row(key, first, ends, close, opens) -> pa.RecordBatch:
        values = [*key, first, ends[0], ends[1], close, opens[0], opens[1]]
        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        for file, start, rid, line in _lines(batches):
            if key != (file, start):
                if key is not None:
                    yield row(key, first, ends, close, opens)
                key, first, ends, close, opens = (file, start), rid, [False, True], None, [None, None]
            marks = '"' in line
            for state in (0, 1):
                before = ends[state]
                # a line without quotes ends a record, or stays inside the field
                ends[state] = still_quoted(line, before, sep) if marks else before
                if state and before and not ends[state] and close is None:
                    close = rid
                if not ends[state]:
                    opens[state] = None
                elif not before:
                    opens[state] = rid
        if key is not None:
            yield row(key, first, ends, close, opens)

    return run


def _assemble(sep: str):
    """Lines of whole records, in order, to records."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, head, quoted = [], False, False
        for batch in batches:
            records, firsts, files = [], [], []
            for line, first, file in zip(*(batch.column(c).to_pylist() for c in ("value", "first", "file"))):
                head = first if not held else head
                held.append(line)
                quoted = still_quoted(line, quoted, sep) if '"' in line else quoted
                if not quoted:
                    records.append(held[0] if len(held) == 1 else "\n".join(held))
                    firsts.append(head)
                    files.append(file)
                    held = []
            if records:
                yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(firsts), pa.array(records, pa.string())],
                                                 names=["file", "first", "record"])
        if held:
            raise ValueError("a range of whole records ends inside quotes: the file changed while it was read")

    return run


def ranges(lines: DataFrame, sep: str = ",") -> DataFrame:
    """One row for each byte range: where it begins, whether inside quotes, and which of its lines belong to records
    that cross its begin (up to ``tail_to``) or its end (from ``head_from``)."""
    found = lines.mapInArrow(_summary(sep), _RANGE)
    # the state at a begin: that of the last range which ends in a fixed state, swapped once for each swapping range since
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    swap = F.col("from_record") & ~F.col("from_quoted")
    fixed = F.col("from_record") == F.col("from_quoted")
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("swaps", F.sum(F.when(swap, 1).otherwise(0)).over(upto))
    at = F.struct(F.col("from_record").cast("int").alias("state"), "swaps")
    last = F.last(F.when(fixed, at), ignorenulls=True).over(before)
    since = F.coalesce(F.sum(F.when(swap, 1).otherwise(0)).over(before), F.lit(0))
    quoted = F.pmod(F.coalesce(last["state"], F.lit(0)) + since - F.coalesce(last["swaps"], F.lit(0)), F.lit(2)) == 1
    found = found.withColumn("quoted", quoted)
    far = F.lit((1 << 63) - 1)
    return found.select(
        "file", "start", "first_rid", F.when(F.col("quoted"), F.coalesce("close_quoted", far)).otherwise(-1).alias("tail_to"),
        F.coalesce(F.when(F.col("quoted"), F.col("open_quoted")).otherwise(F.col("open_record")), far).alias("head_from"))


def records(spark: SparkSession, paths: list[str], sep: str = ",") -> DataFrame:
    """``(file, first, record)``: the text of every record without its line end; ``first`` marks each file's first one."""
    raw = spark.read.option("lineSep", "\n").text(paths)
    # positions are those of the scan, the same in every pass over the same files
    lines = raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       F.monotonically_increasing_id().alias("rid"))
    marks = cut_lineage(ranges(lines, sep))
    near = F.broadcast(marks) if marks.count() <= MAX_BROADCAST_RANGES else marks
    placed = lines.join(near, ["file", "start"]).withColumn("first", (F.col("start") == 0) & (F.col("rid") == F.col("first_rid")))
    tail, head = F.col("rid") <= F.col("tail_to"), F.col("rid") >= F.col("head_from")
    whole = placed.where(~tail & ~head)
    if near is marks:  # a shuffled join loses the order of the scan
        whole = whole.repartition("file", "start").sortWithinPartitions("file", "start", "rid")
    inner = whole.select("value", "first", "file").mapInArrow(_assemble(sep), "file string, first boolean, record string")
    # at most two records of a range: the one that crosses its begin and the one that crosses its end
    order = Window.partitionBy("file").orderBy("start", "rid")
    crossing = (placed.where(tail | head).withColumn("no", F.sum((F.col("rid") == F.col("head_from")).cast("int")).over(order))
                .groupBy("file", "no").agg(F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("start", "rid", "value"))).alias("l")))
    found = inner.unionByName(crossing.select("file", "first", F.array_join(F.col("l.value"), "\n").alias("record")))
    return found.withColumn("record", F.regexp_replace("record", "\r$", ""))


def read_quoted(spark: SparkSession, paths: list[str], names: list[str], sep: str = ",") -> DataFrame:
    """All records but each file's first as text columns ``names``, as the ``multiLine`` reader parses them.

    Lines end with ``\\n`` or ``\\r\\n``. Empty lines are no records.
    """
    rows = records(spark, paths, sep).where(~F.col("first")).where("record <> ''")
    ddl = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in names)
    return rows.select(F.from_csv("record", ddl, _OPTIONS).alias("r")).select(*[F.col("r").getField(c).alias(c) for c in names])


def _names(header: str, exact: bool) -> list[str]:
    """Column names of a header record: empty ones by their place, repeated ones with their place added."""
    names = [n if n else f"_c{i}" for i, n in enumerate(next(csv.reader(io.StringIO(header.removeprefix("\ufeff"), newline="")), []))]
    key = (lambda n: n) if exact else str.lower
    seen = Counter(map(key, names))
    return [n if seen[key(n)] == 1 else f"{n}{i}" for i, n in enumerate(names)]


def read_by_header(spark: SparkSession, paths: list[str], sep: str = ",") -> DataFrame:
    """Records of files with any number of headers as text columns, by name, in one plan whatever the number of headers.

    Every file's first record is its header. A record is parsed once, by
    position, and its fields find their columns through its header's names,
    one array for each file. Names that differ in case only are one column
    unless ``spark.sql.caseSensitive`` is set. The driver holds the distinct
    headers.
    """
    exact = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
    key = (lambda n: n) if exact else str.lower
    found = records(spark, paths, sep)
    heads = cut_lineage(found.where("first").select("file", F.col("record").alias("head")))
    headers = sorted(r[0] for r in heads.select("head").distinct().collect())
    spelled: dict[str, str] = {}
    named = [(h, [spelled.setdefault(key(n), n) for n in _names(h, exact)]) for h in headers]
    if not spelled:
        return spark.createDataFrame([], "struct<>")
    width = max(len(n) for _, n in named)
    by_file = heads.join(F.broadcast(spark.createDataFrame(named, "head string, names array<string>")), "head").select("file", "names")
    by_file = F.broadcast(by_file) if len(paths) <= MAX_BROADCAST_RANGES else by_file
    ddl = ", ".join(f"c{i} STRING" for i in range(width))
    fields = F.from_csv("record", ddl, _OPTIONS | {"columnNameOfCorruptRecord": "_none"})
    rows = (found.where(~F.col("first")).where("record <> ''").join(by_file, "file").select("names", fields.alias("r"))
            .select("names", F.array(*[F.col(f"r.c{i}") for i in range(width)]).alias("v"))
            .select(F.map_from_arrays("names", F.slice("v", F.lit(1), F.size("names"))).alias("m")))
    return rows.select(*[F.try_element_at("m", F.lit(c)).alias(c) for c in spelled.values()])
