"""Arrow string columns as byte blocks, and words as positions and hashes.

Texts stay UTF-8 bytes in one numpy array per block of documents. All word
rules used here are unions of ASCII bytes, so they hold on UTF-8 unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20
HASH_SPAN = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MASK64 = (1 << 64) - 1


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(modulus)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound what one Arrow batch of whole texts may hold (results do not depend on it)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def by_size(keys: DataFrame, n: int, max_rows: int = 200_000) -> DataFrame:
    """Hint how to join a written table of ``n`` narrow keys with whole texts.

    At most ``max_rows`` are broadcast, so that the texts need no shuffle;
    more are left to a shuffled join. The result is the same.
    """
    return F.broadcast(keys) if n <= max_rows else keys


def text_blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first_row, last_row, bytes, offsets)`` with about ``max_bytes`` each.

    ``offsets`` has one more entry than rows and starts at 0; null texts are
    empty. A text longer than the bound is a block of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, off_buf, data_buf = column.buffers()
    offsets = np.frombuffer(off_buf, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1
        last = min(max(last, first + 1), n)
        base = offsets[first]
        yield first, last, data[base:offsets[last]], offsets[first:last + 1] - base
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def word_table(separators: list[tuple[int, int]]) -> np.ndarray:
    """True for bytes that belong to a word."""
    t = np.ones(256, dtype=bool)
    for a, b in separators:
        t[a:b + 1] = False
    return t


SPACE_WORDS = [(0x20, 0x20), (0x09, 0x0D)]
PLAIN_WORDS = [(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)]


class Words:
    """Words of a block: start and end bytes, document of each, 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, hashes: bool = True):
        self.offsets = offsets
        self.data = lower_table()[data]
        w = is_word[self.data]
        if len(w):
            first = w.copy()
            first[1:] &= ~w[:-1]
            last = w.copy()
            last[:-1] &= ~w[1:]
            cuts = offsets[1:-1]
            cuts = cuts[(cuts > 0) & (cuts < len(w))]
            first[cuts] = w[cuts]
            last[cuts - 1] = w[cuts - 1]
            self.start = np.flatnonzero(first)
            self.end = np.flatnonzero(last) + 1
        else:
            self.start = self.end = np.zeros(0, dtype=np.int64)
        #: position in the word list where each document begins
        self.bounds = np.searchsorted(self.start, offsets)
        if hashes:
            self.hash = span_hashes(self.data, self.start, self.end)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


_tables: dict = {}


def _hash_tables(n: int):
    have = _tables.get("n", 0)
    if have < n:
        n = max(n, HASH_SPAN + 1)
        rng = np.random.default_rng(20260101)
        _tables["value"] = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        with np.errstate(over="ignore"):
            inv = np.uint64(pow(int(_BASE), -1, 1 << 64))
            for key, g in (("power", _BASE), ("inverse", inv)):
                a = np.full(n, g, dtype=np.uint64)
                a[0] = 1
                _tables[key] = np.cumprod(a, dtype=np.uint64)
        _tables["n"] = n
    return _tables["value"], _tables["power"], _tables["inverse"]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span ``[start, end)``; spans are ordered by start.

    Polynomial hashes come from differences of one running sum, so a span
    costs the same whatever its length. The block is walked in pieces, so that
    the running sums stay small however long a text is.
    """
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        base = int(start[i])
        j = max(int(np.searchsorted(end, base + HASH_SPAN, side="right")), i + 1)
        stop = int(end[i:j].max())
        value, power, inverse = _hash_tables(stop - base + 1)
        run = np.zeros(stop - base + 1, dtype=np.uint64)
        np.cumsum(value[data[base:stop]] * power[:stop - base], out=run[1:])
        s, e = start[i:j] - base, end[i:j] - base
        out[i:j] = (run[e] - run[s]) * inverse[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` within each ``[offsets[i], offsets[i+1])``."""
    run = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=run[1:])
    return run[offsets[1:]] - run[offsets[:-1]]


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(k).type) for k, c in columns.items()],
        schema=schema)
