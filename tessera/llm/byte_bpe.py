"""Byte-level BPE: encode whole texts to ids and decode them again.

Texts are cut into pieces without a regular expression. Every code point gets
a class from a table; spaces and apostrophes also look one to three code
points ahead. A small automaton reads the classes; whether a piece starts at
a code point depends on the state before it. Its transition functions form a
finite monoid, so states come from an associative scan: functions are
composed by one table look-up each, for many chunks of the text side by side,
then the chunks' totals are composed, then every state follows.

Pieces go through rank-ordered pair merging once each and are cached. With
``offsets=True`` ``encode`` returns where each piece begins in the text and
where its ids end; ``decode`` then restores piece by piece and tests that each
falls where it should, and ``decode_span`` restores any span of the text from
the ids of the pieces that overlap it. (``digests`` decodes ids alone.)

The pieces are those of the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+|
?[^\\sLN]+|\\s+(?!\\S)|\\s+`` with L letters and N numbers.

Defined cases: null text encodes as empty text: no ids, decoded to no bytes.
Special-token strings in a text are ordinary text. Texts of any length are
encoded whole. Repeated rows are encoded alike; an empty table gives no rows;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import heapq
import sys
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.blocks import small_batches, text_blocks

# classes of a code point, after looking ahead
LETTER, NUMBER, OTHER, SPACE, LEAD, SHORT, LONG, BREAK = range(8)
# states: what is open before a code point
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_SPACE, AFTER_LEAD, ONE_MORE, TWO_MORE = range(8)
WHITE_SPACE = [(0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
               (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
CACHE_PIECES = 150_000  # of each of two generations
CHARS = 1 << 19
SHORT_PIECE = 48  # bytes


def class_table() -> np.ndarray:
    """Class of every code point (spaces as SPACE, apostrophes as OTHER)."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            out[cp] = LETTER
        elif kind == "N":
            out[cp] = NUMBER
    for a, b in WHITE_SPACE:
        out[a:b + 1] = SPACE
    return out


def _step(state: int, cls: int) -> tuple[int, bool]:
    """Next state, and whether a piece starts at this code point."""
    if cls == BREAK:
        return FRESH, False
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return FRESH, False
    if cls in (SPACE, LEAD):
        return (IN_SPACE if cls == SPACE else AFTER_LEAD), True  # starts inside space are refined by position
    if cls in (SHORT, LONG) and state not in (IN_OTHER, AFTER_LEAD):
        return (ONE_MORE if cls == SHORT else TWO_MORE), True
    opened = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS}.get(cls, IN_OTHER)
    return opened, state not in (opened, AFTER_LEAD)


def _monoid():
    """All compositions of the eight transition functions, and their product table."""
    base = [tuple(_step(s, c)[0] for s in range(8)) for c in range(8)]
    elements = [tuple(range(8))]
    index = {elements[0]: 0}
    i = 0
    while i < len(elements):
        for g in base:
            h = tuple(g[s] for s in elements[i])
            if h not in index:
                index[h] = len(elements)
                elements.append(h)
        i += 1
    n = len(elements)
    product = np.zeros((n, n), dtype=np.int16)
    for a, f in enumerate(elements):
        for b, g in enumerate(elements):
            product[a, b] = index[tuple(g[s] for s in f)]
    return np.array(elements, dtype=np.uint8), product, np.array([index[g] for g in base], dtype=np.int16)


def scan_states(cls: np.ndarray, monoid, chunk: int = 512) -> np.ndarray:
    """State before each code point, starting fresh."""
    elements, product, of_class = monoid
    n = len(cls)
    rows = -(-n // chunk)
    # the identity pads the last chunk
    fn = np.zeros(rows * chunk, dtype=np.int16)
    fn[:n] = of_class[cls]
    columns = np.ascontiguousarray(fn.reshape(rows, chunk).T)
    flat, width = product.ravel(), product.shape[1]
    before = np.empty((chunk, rows), dtype=np.int16)
    acc = np.zeros(rows, dtype=np.int16)
    for k in range(chunk):
        before[k] = acc
        acc = flat[acc.astype(np.int32) * width + columns[k]]
    # exclusive scan of the chunks' totals by doubling
    total, d = acc.copy(), 1
    while d < rows:
        total[d:] = flat[total[:-d].astype(np.int32) * width + total[d:]]
        d *= 2
    entry = np.zeros(rows, dtype=np.uint8)
    entry[1:] = elements[total[:-1], FRESH]
    return elements[before, entry[None, :]].T.reshape(-1)[:n]


def piece_starts(points: np.ndarray, table: np.ndarray, monoid) -> np.ndarray:
    """Whether a piece starts at each code point. Code point 0xFFFFFFFF separates texts."""
    n = len(points)
    gap = points == 0xFFFFFFFF
    cls = table[np.where(gap, 0, points)]
    cls[gap] = BREAK
    ahead = np.full(n + 3, 0xFFFFFFFF, dtype=np.uint32)
    ahead[:n] = points
    cls2 = np.full(n + 1, BREAK, dtype=np.uint8)
    cls2[:n] = cls
    white = cls2 == SPACE
    text_next = ~white[1:] & (cls2[1:] != BREAK)
    lead = white[:n] & (points == 0x20) & text_next
    at = np.flatnonzero(points == 0x27)
    if len(at):
        a, b = ahead[at + 1], ahead[at + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        cls[at[one]] = SHORT
        cls[at[two]] = LONG
    cls[lead] = LEAD
    states = scan_states(cls, monoid)
    starts = _STARTS[states, cls]
    # a run of space is one piece but for its last code point when text follows
    space_before = np.zeros(n, dtype=bool)
    space_before[1:] = white[:n - 1]
    inner = white[:n] & space_before & ~text_next
    starts[inner] = False
    return starts


_STARTS = np.array([[_step(s, c)[1] for c in range(8)] for s in range(8)])


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file of base64 tokens and numbers."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the lowest-ranked neighbouring pair is joined until none is known."""
    known = ranks.get(piece)
    if known is not None:
        return [known]
    n = len(piece)
    if n <= SHORT_PIECE:
        return _merge_short(piece, ranks)
    # a heap of pairs over a linked list: n log n however long the piece
    end = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    alive = [True] * n
    heap = []
    for i in range(n - 1):
        r = ranks.get(piece[i:i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i]:
            continue
        j = end[i]
        if j >= n or end[j] != stop:
            continue
        end[i] = stop
        alive[j] = False
        if stop < n:
            left[stop] = i
            r = ranks.get(piece[i:end[stop]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        p = left[i]
        if p >= 0:
            r = ranks.get(piece[p:stop])
            if r is not None:
                heapq.heappush(heap, (r, p, stop))
    return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``merge``, by looking over all pairs each time: quicker for the few bytes of most pieces."""
    get, none = ranks.get, 1 << 62
    cuts = list(range(len(piece) + 1))
    pairs = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while pairs:
        low = min(pairs)
        if low == none:
            break
        i = pairs.index(low)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = get(piece[cuts[i]:cuts[i + 2]], none)
        if i:
            pairs[i - 1] = get(piece[cuts[i - 1]:cuts[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])]


class Encoder:
    """Encodes texts by ranks; pieces met before come from the cache."""

    def __init__(self, ranks: dict[bytes, int], table: np.ndarray):
        self.ranks, self.table, self.monoid = ranks, table, _monoid()
        self.tokens = {i: t for t, i in ranks.items()}
        self.cache: dict[str, tuple[int, ...]] = {}

    def ids_of(self, piece: str) -> tuple[int, ...]:
        ids = tuple(merge(piece.encode("utf-8", "surrogatepass"), self.ranks))
        if len(self.cache) >= CACHE_PIECES:
            self.cache.clear()
        self.cache[piece] = ids
        return ids

    def pieces(self, texts: list[str]) -> Iterator[list[str]]:
        """The pieces of each text."""
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) < CHARS):
                size += len(texts[j]) + 1
                j += 1
            yield from self._cut(texts[i:j])
            i = j

    def _cut(self, texts: list[str]) -> Iterator[list[str]]:
        lengths = np.array([len(t) for t in texts])
        first = np.cumsum(lengths + 1) - lengths - 1  # where each text begins, one separator after each
        joined = "\x00".join(texts) + "\x00"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
        points[first + lengths] = 0xFFFFFFFF
        starts = np.flatnonzero(piece_starts(points, self.table, self.monoid))
        cut = np.searchsorted(starts, first)
        cut = np.append(cut, len(starts))
        at = starts.tolist()
        for k, (a, n) in enumerate(zip(first.tolist(), lengths.tolist())):
            own = at[cut[k]:cut[k + 1]]
            yield [joined[x:y] for x, y in zip(own, own[1:] + [a + n])]

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text."""
        for own in self.pieces(texts):
            out: list[int] = []
            for p in own:
                out += self.cache.get(p) or self.ids_of(p)
            yield out

    def encode_pieces(self, texts: list[str]) -> Iterator[tuple[list[int], list[int], list[int]]]:
        """Ids of each text, the code point where each piece begins, and the number of ids up to its end."""
        for own in self.pieces(texts):
            ids, starts, ends, at = [], [], [], 0
            for p in own:
                starts.append(at)
                at += len(p)
                ids += self.cache.get(p) or self.ids_of(p)
                ends.append(len(ids))
            yield ids, starts, ends

    def decode_pieces(self, ids: list[int], starts: list[int], ends: list[int]) -> Iterator[str]:
        """Text of each piece (a piece is whole code points); offsets that do not fit are an error."""
        at, done = starts[0] if starts else 0, 0
        for start, end in zip(starts, ends, strict=True):
            piece = self.decode(ids[done:end]).decode()
            if start != at or not piece:
                raise ValueError(f"a piece said to begin at {start} begins at {at}")
            yield piece
            at, done = at + len(piece), end
        if done != len(ids):
            raise ValueError(f"{len(ids) - done} ids belong to no piece")

    def decode(self, ids: list[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


class Packed(dict):
    """Piece -> its ids as 32-bit numbers.

    Two generations: a full one becomes the old one, and what is met again moves on.
    """

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.old: dict = {}
        self.packed = {i: i.to_bytes(4, "little") for i in encoder.tokens}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_PIECES:
            self.old = dict(self)
            self.clear()
        out = self.old.get(piece)
        if out is None:
            out = b"".join([self.packed[i] for i in merge(piece.encode("utf-8", "surrogatepass"), self.encoder.ranks)])
        self[piece] = out
        return out


def _spelled(table: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The entries of ids ``bounds[k]`` to ``bounds[k + 1]`` of a table, joined, for every k."""
    if not len(ids):
        return [b""] * (len(bounds) - 1)
    _, offsets, data = table.take(pa.array(ids)).buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[bounds].tolist()
    whole = memoryview(data) if data is not None else memoryview(b"")
    return [bytes(whole[a:b]) for a, b in zip(at, at[1:])]


def _tables(encoder: Encoder) -> tuple[pa.Array, pa.Array]:
    """By id: its token, and its decimal digits with a comma."""
    size = max(encoder.tokens, default=-1) + 1
    return (pa.array([encoder.tokens.get(i, b"") for i in range(size)], pa.large_binary()),
            pa.array([b"%d," % i for i in range(size)], pa.large_binary()))


def _parts(encoder: Encoder, texts: list[str]) -> Iterator[tuple[bytes, bytes, bytes]]:
    """The ids of each text as 32-bit numbers and as text, and the bytes they decode to."""
    if "tables" not in encoder.__dict__:
        encoder.known, encoder.tables = Packed(encoder), _tables(encoder)
    known = encoder.known
    packed = [b"".join([known[p] for p in own]) for own in encoder.pieces(texts)]
    ids = np.frombuffer(b"".join(packed), dtype="<i4")
    bounds = np.zeros(len(packed) + 1, dtype=np.int64)
    np.cumsum([len(p) // 4 for p in packed], out=bounds[1:])
    tokens, digits = encoder.tables
    for p, shown, decoded in zip(packed, _spelled(digits, ids, bounds), _spelled(tokens, ids, bounds)):
        yield p, shown[:-1], decoded


def _bounded(column: pa.Array, max_bytes: int = 1 << 20) -> Iterator[list[str]]:
    for _, _, data, offsets in text_blocks(column, max_bytes):
        raw = data.tobytes()
        yield [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]


def _setup(spark: SparkSession, ranks_path: str):
    """Ranks and class table to every executor once; both have a fixed size."""
    return uuid.uuid4().hex, spark.sparkContext.broadcast((load_ranks(ranks_path), class_table().tobytes()))


def _encoder(shared) -> Encoder:
    """One encoder for each worker process, kept between its tasks."""
    kept = sys.modules["pyspark"].__dict__.setdefault("_tessera_bpe", {})
    key, tables = shared
    if kept.get("key") != key:
        ranks, table = tables.value
        kept.update(key=key, encoder=Encoder(ranks, np.frombuffer(table, dtype=np.uint8)))
    return kept["encoder"]


def encode(docs: DataFrame, ranks_path: str, text_col: str = "text", id_col: str = "doc_id", offsets: bool = False) -> DataFrame:
    """``id, ids array<int>``: the token ids of every whole text.

    With ``offsets``, also ``starts array<int>``, the code point of the text
    where each piece begins, and ``ends array<int>``, how many ids there are
    up to the end of each piece.
    """
    small_batches(docs.sparkSession)
    shared = _setup(docs.sparkSession, ranks_path)
    ints = pa.list_(pa.int32())

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        encoder = _encoder(shared)
        return pa.array([x for part in _bounded(texts) for x in encoder.encode(part)], ints)

    @F.arrow_udf("struct<ids: array<int>, starts: array<int>, ends: array<int>>")
    def pieces(texts: pa.Array) -> pa.Array:
        encoder = _encoder(shared)
        # each block of texts goes over to Arrow before the next is encoded
        parts = [[pa.array(c, ints) for c in zip(*encoder.encode_pieces(part))] for part in _bounded(texts)]
        columns = [pa.concat_arrays(c) for c in zip(*parts)] or [pa.array([], ints)] * 3
        return pa.StructArray.from_arrays(columns, names=["ids", "starts", "ends"])

    if not offsets:
        return docs.select(F.col(id_col), ids(F.col(text_col)).alias("ids"))
    return docs.select(F.col(id_col), pieces(F.col(text_col)).alias("r")).select(F.col(id_col), "r.ids", "r.starts", "r.ends")


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", offsets: bool = False) -> DataFrame:
    """``id, data binary``: the bytes that ids stand for; an unknown id is an error.

    With ``offsets``, restored piece by piece by ``starts`` and ``ends``;
    offsets that do not fit the ids are an error.
    """
    small_batches(encoded.sparkSession)
    shared = _setup(encoded.sparkSession, ranks_path)

    @F.arrow_udf("binary")
    def data(ids: pa.Array) -> pa.Array:
        encoder = _encoder(shared)
        return pa.array([encoder.decode(x or []) for x in ids.to_pylist()], pa.binary())

    @F.arrow_udf("binary")
    def by_piece(ids: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        encoder = _encoder(shared)
        rows = zip(ids, starts, ends)
        return pa.array(["".join(encoder.decode_pieces(*[c.as_py() or [] for c in r])).encode() for r in rows], pa.binary())

    found = by_piece(F.col("ids"), F.col("starts"), F.col("ends")) if offsets else data(F.col("ids"))
    return encoded.select(F.col(id_col), found.alias("data"))


def decode_span(encoded: DataFrame, ranks_path: str, first: Column, last: Column, id_col: str = "doc_id") -> DataFrame:
    """``id, span``: code points ``first`` up to ``last`` of each text, from the ids of the overlapping pieces only.

    Bounds beyond the text are cut to it; a null bound gives null.
    """
    small_batches(encoded.sparkSession)
    shared = _setup(encoded.sparkSession, ranks_path)

    @F.arrow_udf("string")
    def span(ids: pa.Array, starts: pa.Array, ends: pa.Array, first: pa.Array, last: pa.Array) -> pa.Array:
        encoder = _encoder(shared)
        out = []
        for i, s, e, a, b in zip(ids, starts, ends, first.to_pylist(), last.to_pylist()):
            s, e = s.as_py() or [], e.as_py() or []
            if a is None or b is None:
                out.append(None)
                continue
            a = max(a, 0)
            x, y = max(bisect.bisect_right(s, a) - 1, 0), bisect.bisect_left(s, b)
            if y <= x:
                out.append("")
                continue
            before = e[x - 1] if x else 0
            own = i.values[before:e[y - 1]].to_pylist()
            text = "".join(encoder.decode_pieces(own, s[x:y], [k - before for k in e[x:y]]))
            out.append(text[a - s[x]:b - s[x]])
        return pa.array(out, pa.string())

    columns = [F.col("ids"), F.col("starts"), F.col("ends"), first.cast("long"), last.cast("long")]
    return encoded.select(F.col(id_col), span(*columns).alias("span"))


def _lists(packed: list[bytes]) -> pa.Array:
    """Arrays of ids from 32-bit numbers."""
    offsets = np.zeros(len(packed) + 1, dtype=np.int32)
    np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), dtype="<i4")))


def digests(docs: DataFrame, ranks_path: str, text_col: str = "text", id_col: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256``: encode, decode the ids, and digest both; ``ids`` too on request."""
    small_batches(docs.sparkSession)
    shared = _setup(docs.sparkSession, ranks_path)

    @F.arrow_udf("struct<n: bigint, text: string, decoded: string, ids: array<int>>")
    def both(texts: pa.Array) -> pa.Array:
        encoder = _encoder(shared)
        n, shown, decoded, kept = [], [], [], []
        for part in _bounded(texts):
            for packed, a, b in _parts(encoder, part):
                n.append(len(packed) // 4)
                shown.append(hashlib.sha256(a).hexdigest())
                decoded.append(hashlib.sha256(b).hexdigest())
                kept.append(packed if keep_ids else b"")
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(shown, pa.string()), pa.array(decoded, pa.string()),
                                           _lists(kept)], names=["n", "text", "decoded", "ids"])

    found = docs.select(F.col(id_col), both(F.col(text_col)).alias("r"))
    return found.select(F.col(id_col), F.col("r.n").alias("n_tokens"), F.col("r.text").alias("ids_sha256"),
                        F.col("r.decoded").alias("decoded_sha256"), *([F.col("r.ids").alias("ids")] if keep_ids else []))
