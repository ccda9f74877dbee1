"""MinHash fingerprints of documents and of their edited texts, and near copies found through them.

A text's words are those of ``SPACE_WORDS`` after lower-casing A-Z; its set is
that of its distinct shingles of five words (with fewer words, the whole
sequence is one). Each of ``PERMUTATIONS`` multiply-add hashes ``a x + b``
over 32-bit shingles keeps its minimum, computed for a block of texts at
once; a fingerprint is 16 bits of each minimum, and the likeness of two is
the share of equal positions, an estimate of the Jaccard similarity of the
sets.

An edited text needs the document's successor. Documents are range
partitioned by falling id, each partition is read once in order, and only the
last row of a partition waits for the first row of the next one: texts are
shuffled once, compressed one by one.

``near_copies`` cuts fingerprints into bands, joins equal bands in Spark and
verifies by exact Jaccard similarity of the whole texts' sets: each document
is held against the smallest id in each of its bands' groups, and, where that
is no near copy, against all earlier members of the groups with that smallest
id. These comparisons take place in blocks of bounded size, which give no
row a pair but the smallest near copy of each visitor.

Defined cases: a null text is empty; texts without words have no shingle,
equal fingerprints among themselves, likeness 0 to other texts and no near
copies; ids that are null come last and have no near copies; rows that repeat
an id follow each other in an order fixed by their texts, share the smallest
near copy found for any of them, and are represented by the one with the
smallest hash where others are held against them; the only document's
successor is itself; texts may be of any length (one longer than a block is a
block of its own); equal texts have equal fingerprints; no rows give none;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.blocks import SPACE_WORDS, Words, by_size, mix, small_batches, text_blocks, word_table
from tessera.llm.components import written
from tessera.llm.near_dup import _groups
from tessera.session import cut_lineage

WORDS = 5
PERMUTATIONS = 96
ROWS = 4  # positions of a band: 24 bands miss a pair of similarity 0.75 with chance 1.1e-4, one of 0.85 with 2e-8
THRESHOLD = 0.75
MARGIN = 0.25  # 5.7 standard errors of a likeness at the threshold
BLOCK_BYTES = 1 << 18
BLOCK_ROWS = 512  # standing and visiting documents of a block of comparisons
WHOLE = 2048  # shingles; of larger sets those of the smallest hashes stand in the blocks, at least half as many
FINE_MARGIN = 0.08  # 5.9 standard errors of a likeness of such parts at the threshold
_IS_WORD = word_table(SPACE_WORDS)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def coefficients(permutations: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of the hashes."""
    rng = np.random.default_rng(20260412)
    a = rng.integers(0, 1 << 63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, permutations, dtype=np.uint64)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles of a block of texts, and the bounds of each text's."""
    words = Words(data, offsets, _IS_WORD)
    counts, first = words.counts(), words.bounds[:-1]
    n = np.where(counts >= WORDS, counts - WORDS + 1, (counts > 0).astype(np.int64))
    bounds = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(n, out=bounds[1:])
    size = np.minimum(counts, WORDS)
    at = np.repeat(first - bounds[:-1], n) + np.arange(bounds[-1])
    long = np.repeat(size, n)
    out = long.astype(np.uint64)
    for j in range(WORDS):
        here = j < long
        out[here] = mix(out[here] * _STEP + words.hash[at[here] + j])
    return out, bounds


def signatures(data: np.ndarray, offsets: np.ndarray, permutations: int = PERMUTATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints (16 bits a position; 0 for a text without words) and whether a text has words."""
    found, bounds = shingles(data, offsets)
    has = np.diff(bounds) > 0
    out = np.zeros((len(has), permutations), dtype=np.uint16)
    if len(found):
        x = found >> np.uint64(32)
        starts, hashed = bounds[:-1][has], np.empty_like(x)
        low = np.empty((permutations, len(starts)), dtype=np.uint64)
        for k, (a, b) in enumerate(zip(*coefficients(permutations))):
            np.multiply(x, a, out=hashed)
            np.add(hashed, b, out=hashed)
            np.minimum.reduceat(hashed, starts, out=low[k])
        out[has] = (mix(low) & np.uint64(0xFFFF)).astype(np.uint16).T
    return out, has


def likeness(a: np.ndarray, b: np.ndarray, has_a: np.ndarray, has_b: np.ndarray) -> np.ndarray:
    """Share of equal positions; a text without words is like another one only."""
    return np.where(has_a & has_b, (a == b).mean(axis=1), (has_a == has_b).astype(float))


def edited(text: str, following: str) -> str:
    """The last half (rounded down) of the code points replaced by as many first ones of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), offsets


_FIELDS = ("n_chars long, has_words boolean, mark binary, edited_hash binary, edited_mark binary, near_edited double, "
           "near_next double")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, h, text) to (id, h, size, z): texts compressed one by one."""
    for batch in batches:
        raw = [t.as_py().encode() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("h"), pa.array([len(t) for t in raw], pa.int64()),
             pa.array([pa.compress(t, codec="zstd", asbytes=True) if t else b"" for t in raw], pa.binary())], names=["id", "h", "size", "z"])


def _text(z: bytes, size: int) -> bytes:
    return pa.decompress(z, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, h, size, z)``: ids, hashes and compressed texts."""
    small_batches(docs.sparkSession)
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(body).alias("h"), body.alias("text"))
    return rows.mapInArrow(_packed, f"id {rows.schema['id'].dataType.simpleString()}, h long, size long, z binary")


def _pieces(batch: pa.RecordBatch, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts have about ``most`` bytes together."""
    size = np.cumsum(batch.column("size").to_numpy())
    first = 0
    while first < len(size):
        last = max(int(np.searchsorted(size, (size[first - 1] if first else 0) + most, side="right")), first + 1)
        yield first, last
        first = last


class _Rows:
    """Texts of consecutive documents with their fingerprints."""

    def __init__(self, ids: list, raw: list[bytes], texts: list[str], mark: np.ndarray, has: np.ndarray):
        self.ids, self.raw, self.texts, self.mark, self.has = ids, raw, texts, mark, has

    @classmethod
    def of(cls, ids: list, raw: list[bytes]) -> _Rows:
        return cls(ids, raw, [t.decode() for t in raw], *signatures(*_joined(raw)))

    def part(self, which: slice) -> _Rows:
        return _Rows(self.ids[which], self.raw[which], self.texts[which], self.mark[which], self.has[which])

    def followed_by(self, rows: _Rows) -> _Rows:
        return _Rows(self.ids + rows.ids, self.raw + rows.raw, self.texts + rows.texts,
                     np.concatenate([self.mark, rows.mark]), np.concatenate([self.has, rows.has]))


def _described(rows: _Rows, following: _Rows) -> list[pa.Array]:
    """The columns of ``_FIELDS`` for rows and their successors (row by row)."""
    changed = [edited(a, b).encode() for a, b in zip(rows.texts, following.texts)]
    mark, has = signatures(*_joined(changed))
    return [pa.array([len(t) for t in rows.texts], pa.int64()), pa.array(rows.has),
            pa.array([m.tobytes() for m in rows.mark], pa.binary()),
            pa.array([hashlib.sha256(t).digest() for t in changed], pa.binary()),
            pa.array([m.tobytes() for m in mark], pa.binary()),
            pa.array(likeness(rows.mark, mark, rows.has, has)),
            pa.array(likeness(rows.mark, following.mark, rows.has, following.has))]


def _in_order(kind: pa.DataType):
    """Rows (id, h, size, z) of one partition, in order: described rows, and the text of the first and of the last row."""
    nothing = [pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    names = ["part", "role", "id", "text", *[f.split()[0] for f in _FIELDS.split(", ")]]

    def end(part: int, role: int, rows: _Rows) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([role], pa.int32()), pa.array(rows.ids, kind),
                                           pa.array(rows.texts, pa.string()), *[pa.nulls(1, t) for t in nothing]], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            ids, sizes = batch.column("id").to_pylist(), batch.column("size").to_pylist()
            for a, b in _pieces(batch):
                rows = _Rows.of(ids[a:b], [_text(z.as_py(), n) for z, n in zip(batch.column("z")[a:b], sizes[a:b])])
                if held is None:
                    yield end(part, 1, rows.part(slice(0, 1)))
                else:
                    rows = held.followed_by(rows)
                n = len(rows.ids) - 1
                held = rows.part(slice(n, None))
                if n:
                    front = rows.part(slice(0, n))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * n, pa.int32()), pa.array([0] * n, pa.int32()), pa.array(front.ids, kind),
                         pa.nulls(n, pa.string()), *_described(front, rows.part(slice(1, None)))], names=names)
        if held is not None:
            yield end(part, 2, held)

    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, following) to described rows."""
    names = ["id", *[f.split()[0] for f in _FIELDS.split(", ")]]
    for batch in batches:
        for i in range(batch.num_rows):
            one = _Rows.of([None], [batch.column("text")[i].as_py().encode()])
            two = _Rows.of([None], [batch.column("following")[i].as_py().encode()])
            yield pa.RecordBatch.from_arrays([batch.column("id")[i:i + 1], *_described(one, two)], names=names)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: ``id``, ``n_chars``, ``has_words``, ``mark`` and ``edited_mark`` (fingerprints as bytes),
    ``edited_hash`` (SHA-256), ``near_edited``, ``near_next``."""
    rows = packed(docs, id_col, text_col)
    kind = rows.schema["id"].dataType
    order = [F.col("id").desc_nulls_last(), F.col("h").asc()]
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order, "z")
    # written once: where partitions begin must not change between the uses
    found = cut_lineage(spread.mapInArrow(_in_order(to_arrow_type(kind)), f"part int, role int, id {kind.simpleString()}, text string, {_FIELDS}"))
    fields = [f.split()[0] for f in _FIELDS.split(", ")]
    inner = found.where("role = 0").select("id", *fields)
    # one row for each partition that is not empty; the first one follows the last
    parts = found.where("role = 2").select("part")
    after = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next"))
    last = found.where("role = 2").select("part", "id", "text").join(after, "part")
    first = found.where("role = 1").select(F.col("part").alias("next"), F.col("text").alias("following"))
    outer = last.join(first, "next").select("id", "text", "following").mapInArrow(_ends, f"id {kind.simpleString()}, {_FIELDS}")
    return inner.unionByName(outer)


def jaccard(left: pa.Array, left_size: pa.Array, right: pa.Array, right_size: pa.Array) -> list[float]:
    """Exact similarity of the shingle sets of compressed texts (0 where a text has no words)."""
    out, seen = [], {}
    for a, n, b, m in zip(left.to_pylist(), left_size.to_pylist(), right.to_pylist(), right_size.to_pylist()):
        if seen.get("z") != b:
            seen = {"z": b, "set": np.unique(shingles(*_joined([_text(b, m)]))[0])}
        mine, theirs = np.unique(shingles(*_joined([_text(a, n)]))[0]), seen["set"]
        common = len(np.intersect1d(mine, theirs, assume_unique=True))
        out.append(common / max(len(mine) + len(theirs) - common, 1))
    return out


def band_keys(mark: Column, rows: int = ROWS, permutations: int = PERMUTATIONS) -> Column:
    """Hashes of a fingerprint's bands."""
    return F.array(*[F.xxhash64(F.lit(i), F.substring(mark, 1 + 2 * rows * i, 2 * rows)) for i in range(permutations // rows)])


def confirmed(texts: DataFrame, pairs: DataFrame, n: int, threshold: float) -> DataFrame:
    """``(id, low, j)``: the pairs with the exact similarity of their whole texts; ``near`` tells whether it is enough."""
    members = texts.join(by_size(pairs, n), "id").select("id", "low", "z", "size")
    heads, m = written(pairs.select("low").distinct())
    # rows that share an id are represented by one, so that a repeated id multiplies nothing
    theirs = (texts.join(by_size(heads.withColumnRenamed("low", "id"), m), "id").groupBy(F.col("id").alias("low"))
              .agg(F.min(F.struct("h", "z", "size")).alias("head")))
    likeness_of = F.arrow_udf(lambda a, x, b, y: pa.array(jaccard(a, x, b, y), pa.float64()), "double")
    alike = members.join(theirs, "low").select("id", "low", likeness_of("z", "size", "head.z", "head.size").alias("j"))
    return alike.select("id", "low", (F.col("j") >= threshold).alias("near"))


def _part(found: np.ndarray) -> tuple[int, np.ndarray]:
    """The sorted hashes of a set below ``2 ** (64 - bits)``, with the smallest ``bits`` that leaves at most ``WHOLE``."""
    bits = 0
    while len(found) > WHOLE:
        bits += 1
        found = found[:np.searchsorted(found, np.uint64(1 << (64 - bits)))]
    return bits, found


def _sets(kind: pa.DataType):
    """Rows (id, h, text) to (id, h, bits, part, mark): what stands for a text in a block of comparisons."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column("text"), BLOCK_BYTES):
                found, at = shingles(data, offsets)
                bits, parts = zip(*[_part(np.unique(found[i:j])) for i, j in zip(at[:-1], at[1:])])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id")[a:b].cast(kind), batch.column("h")[a:b], pa.array(bits, pa.int32()),
                     pa.array([x.tobytes() for x in parts], pa.binary()),
                     pa.array([m.tobytes() for m in signatures(data, offsets)[0]], pa.binary())], names=["id", "h", "bits", "part", "mark"])

    return run


def _similarity(x: np.ndarray, y: np.ndarray, bits: int) -> float:
    """Jaccard similarity of sorted sets below ``2 ** (64 - bits)``."""
    if bits:
        x, y = (s[:np.searchsorted(s, np.uint64(1 << (64 - bits)))] for s in (x, y))
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0.0
    common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return common / (len(x) + len(y) - common)


def _first_near(kind: pa.DataType, threshold: float):
    """Rows (g, id, side, bits, part, mark), groups whole and by id, to (id, low, sure): the smallest earlier near copy of
    each visitor. Of sets that stand in part those before it that may be near are given too, to be verified."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ("g", "id", "side", "bits", "part", "mark")):
            ids, bits = group["id"], group["bits"]
            stand, visit = np.flatnonzero(group["side"] == 1), np.flatnonzero(group["side"] == 2)
            marks = np.frombuffer(b"".join(group["mark"]), dtype=np.uint16).reshape(len(ids), -1)
            sets = [np.frombuffer(x, dtype=np.uint64) for x in group["part"]]
            out = []
            for j in visit:
                earlier = stand[:np.searchsorted(stand, j)]
                earlier = earlier[ids[earlier] < ids[j]]
                likely = earlier[(marks[earlier] == marks[j]).mean(axis=1) >= threshold - MARGIN] if len(earlier) else earlier
                for i in likely.tolist():
                    cut = max(bits[i], bits[j])
                    share = _similarity(sets[i], sets[j], int(cut))
                    if share >= threshold - (FINE_MARGIN if cut else 0):
                        out.append((ids[j], ids[i], not cut))
                    # what is so much likelier than the threshold is near by all odds: nothing larger is smaller
                    if share >= threshold + (FINE_MARGIN if cut else 0):
                        break
            if out:
                a, b, sure = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind), pa.array(sure, pa.bool_())], names=["id", "low", "sure"])

    return run


def earlier_near(visits: DataFrame, stands: DataFrame, docs: DataFrame, threshold: float) -> tuple[DataFrame, int]:
    """``(id, low, sure)``: for each visitor (id, low) the smallest earlier near copy among those that stand for the same
    ``low``; pairs that are not sure are to be verified. docs are (id, h, text)."""
    ids, n = written(visits.select("id").unionByName(stands.select("id")).distinct())
    kind, name = to_arrow_type(docs.schema["id"].dataType), docs.schema["id"].dataType.simpleString()
    sets = cut_lineage(docs.join(by_size(ids, n), "id", "left_semi").mapInArrow(
        _sets(kind), f"id {name}, h long, bits int, part binary, mark binary").dropDuplicates(["id", "h"]))
    # rows that share an id are represented by one, so that a repeated id multiplies nothing
    heads = sets.join(sets.groupBy("id").agg(F.min("h").alias("h")), ["id", "h"], "left_semi")
    blocks = lambda rows, c: rows.groupBy("low").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias(c))
    sizes = blocks(stands, "stood").join(blocks(visits, "visited"), "low")
    zero, own = F.lit(0).cast("long"), lambda c: F.pmod(F.xxhash64("id"), F.col(c))
    every = lambda c: F.explode(F.sequence(zero, F.col(c) - 1))
    here = stands.join(sizes, "low").select("id", "low", own("stood").alias("i"), every("visited").alias("j"), F.lit(1).alias("side"))
    come = visits.join(sizes, "low").select("id", "low", every("stood").alias("i"), own("visited").alias("j"), F.lit(2).alias("side"))
    rows = here.join(heads, "id").unionByName(come.join(sets, "id")).withColumn("g", F.xxhash64("low", "i", "j"))
    return written(rows.repartition("g").sortWithinPartitions("g", "id", "side").select("g", "id", "side", "bits", "part", "mark")
                   .mapInArrow(_first_near(kind, threshold), f"id {name}, low {name}, sure boolean"))


def near_copies(docs: DataFrame, marks: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                threshold: float = THRESHOLD) -> tuple[DataFrame, int]:
    """``(id, near_copy_of)`` and its number of rows: documents with an earlier near or equal copy.

    ``near_copy_of`` is the smallest id, smaller than the document's own, that
    shares a band with it and has a Jaccard similarity of at least
    ``threshold``, taken on the whole sets. The smallest id of each of its
    bands' groups is tried first: where that is a near copy, no other of the
    group can be a smaller one. Where it is not, all earlier members of the
    groups with this smallest id are candidates, one for each text; those of
    at least ``threshold - MARGIN`` equal positions are verified.
    """
    bands = (marks.where(F.col("has_words") & F.col("id").isNotNull())
             .select("id", F.explode(band_keys(F.col("mark"))).alias("band")))
    # of most bands one document only; the rest are few beside the documents' bands
    low, n_low = written(bands.groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("high"))
                         .where("low < high").select("band", "low"))
    pairs, n = written(bands.join(by_size(low, n_low), "band").where(F.col("low") < F.col("id")).select("id", "low").distinct())
    texts = packed(docs, id_col, text_col)
    tried = cut_lineage(confirmed(texts, pairs, n, threshold).groupBy("id", "low").agg(F.max("near").alias("near")))
    found = tried.where("near").select("id", "low")

    # copies of a text need not be compared with each other, nor each with the rest: the first one stands for them
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(body).alias("h"), body.alias("text"))
    said = plain.where(F.col("id").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    hashes = said.select("id", "h").join(pairs.select("id").distinct(), "id", "left_semi")
    first = hashes.groupBy("h").agg(F.min("id").alias("first"), F.max("id").alias("final")).where("first < final")
    copies = cut_lineage(hashes.join(first, "h").where(F.col("first") < F.col("id")).select("id", "first").distinct())
    only = copies.join(hashes.groupBy("id").agg(F.count_distinct("h").alias("k")).where("k = 1"), "id", "left_semi").select("id")
    members = cut_lineage(pairs.join(only, "id", "left_anti"))
    # a near copy that is no larger than the smallest id of a group settles the document there
    best = found.groupBy("id").agg(F.min("low").alias("best"))
    visits = cut_lineage(members.join(tried.where("NOT near").select("id", "low"), ["id", "low"], "left_semi").join(best, "id", "left")
                         .where(F.col("best").isNull() | (F.col("low") < F.col("best"))).select("id", "low"))
    stands = members.join(visits.select("low").distinct(), "low", "left_semi")
    further, _ = earlier_near(visits, stands, said, threshold)
    unsure, n_unsure = written(further.where("NOT sure").select("id", "low").distinct())
    rest = further.where("sure").select("id", "low").unionByName(
        confirmed(texts, unsure, n_unsure, threshold).where("near").select("id", "low"))
    known = cut_lineage(found.unionByName(rest).groupBy("id").agg(F.min("low").alias("low")))
    through = copies.join(known.select(F.col("id").alias("first"), "low"), "first").select("id", "low")
    every = known.unionByName(through).unionByName(copies.select("id", F.col("first").alias("low")))
    return written(every.groupBy("id").agg(F.min("low").alias("near_copy_of")))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its fingerprints as hex, the digest of its edited text, likenesses and ``near_copy_of`` (or null)."""
    marks = fingerprints(docs, id_col, text_col)
    near, n = near_copies(docs, marks, id_col, text_col)
    return marks.join(by_size(near, n), "id", "left").select(
        F.col("id").alias(id_col), "n_chars", F.lower(F.hex("edited_hash")).alias("edited_sha256"),
        F.lower(F.hex("mark")).alias("fingerprint"), F.lower(F.hex("edited_mark")).alias("edited_fingerprint"),
        "near_edited", "near_next", "near_copy_of")
