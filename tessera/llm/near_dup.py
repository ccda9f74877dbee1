"""Near-duplicate documents by chosen-path set similarity join on word shingles.

A document's set holds its distinct shingles of five words (fewer words: the
whole sequence). Equal sets are one class first, so copies cost one row.
Each class gets ``TOKENS`` minwise tokens. Every tree starts with all classes
at its root; a node's hash chooses one or two token positions, and a class
goes to the child named by its token there. Nodes of at most ``SMALL``
classes stop, and so do those in which most members resemble the smallest
one; others branch on, down to ``DEPTH`` levels. ``TREES``
independent trees run side by side, and nodes of every tree are compared,
whatever their size. A pair at similarity 0.75 whose nodes all stay large
down to the last level shares none of 13 trees' nodes with probability 5.4e-5
(the trees draw on the same tokens, which is counted in; 12 trees: 1.04e-4).

Links are found in three steps, so that a group of m near copies does not
give m * m pairs. First every class is confirmed against the most similar of
the smallest classes of its nodes. Then, in nodes whose members are still in
different components, every class against its best candidate in another
one. What remains mixed is compared exhaustively across components: small
nodes in one piece, large ones as blocks of bounded size with a finer
estimate. Estimates only choose what to confirm; every link used is
confirmed on the full shingle sets. Components of these links are the result.

Defined cases: rows of null id take no part (component null, kept); null,
empty and wordless texts have an empty set and are linked with nothing; rows
that repeat an id are documents of their own; ties go to the smaller id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import SPACE_WORDS, Words, by_size, mix, small_batches, text_blocks, word_table
from tessera.llm.components import components, shuffled_joins, tasks_for, written
from tessera.session import cut_lineage

SHINGLE = 5
TOKENS = 128
TREES = 13
TREE_BITS = 15
FINE = 1024  # tokens of the finer estimate used inside large nodes
FINE_MAYBE = 0.69  # 4.4 standard errors below the threshold
DEPTH = 4
SMALL = 32
SECOND = 0.43  # chance that a node chooses two positions: 1.43 branches, 1.07 shared at similarity 0.75
MAYBE = 0.58  # estimates below this are no candidates: 4.4 standard errors below the threshold
OUTLIERS = 3
BLOCK = 512
WHOLE = 4096  # shingles of the largest sets that are confirmed inside a group: 16 MB a block
SEEN = 500_000
_RNG = np.random.default_rng(7)
_COEF = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FINE_MUL = (np.random.default_rng(8).integers(0, 1 << 31, FINE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
_MUL = (_RNG.integers(0, 1 << 31, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
_ADD = _RNG.integers(0, 1 << 32, TOKENS, dtype=np.uint64).astype(np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(data, offsets, word_table(SPACE_WORDS))
    h, n = words.hash, len(words.hash)
    rolled = np.zeros(max(n - size + 1, 0), dtype=np.uint64)
    for k in range(size):
        rolled += h[k:n - size + 1 + k] * _COEF[k] if len(rolled) else rolled
    rolled = mix(rolled)
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        k = b - a
        if k >= size:
            yield np.unique(rolled[a:b - size + 1])
        elif k:
            yield mix(np.array([int((h[a:b] * _COEF[:k]).sum()) & ((1 << 64) - 1)], dtype=np.uint64) + np.uint64(k))
        else:
            yield np.zeros(0, dtype=np.uint64)


def minwise(s: np.ndarray, mul: np.ndarray = _MUL, add: np.ndarray | int = _ADD) -> np.ndarray:
    """Minwise tokens of a set."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(mul), 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 1024):
        out = np.minimum(out, (x[i:i + 1024, None] * mul[None, :] + add).min(axis=0))
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """``id, text_hash, n, digest, sig`` for ``(id, text_hash, text)``; sig is null for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column("text")):
                n, digest, sig = [], [], []
                for s in shingle_sets(data, offsets):
                    n.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    sig.append(minwise(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id")[a:b], batch.column("text_hash")[a:b], pa.array(n, pa.int64()),
                     pa.array(digest, pa.binary()), pa.array(sig, pa.binary())],
                    names=["id", "text_hash", "n", "digest", "sig"])

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, text_hash long, n long, digest binary, sig binary")


def children(path: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Child nodes of (node, class) rows: row numbers and child paths."""
    one = ((path >> np.uint64(8)) % np.uint64(TOKENS)).astype(np.int64)
    step = ((path >> np.uint64(20)) % np.uint64(TOKENS - 1)).astype(np.int64) + 1
    two = (one + step) % TOKENS
    second = np.flatnonzero(((path >> np.uint64(40)) & np.uint64(0xFFFF)).astype(np.int64) < int(SECOND * 65536))
    row = np.concatenate([np.arange(len(path)), second])
    position = np.concatenate([one, two[second]])
    token = tokens[row, position].astype(np.uint64) + (position.astype(np.uint64) << np.uint64(32))
    child = mix(path[row] * np.uint64(0x9E3779B97F4A7C15) + mix(token + np.uint64(1)))
    # the lowest bits keep the number of the tree
    return row, (child & ~np.uint64(TREE_BITS)) | (path[row] & np.uint64(TREE_BITS))


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, TOKENS)


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, k, sig) to their children (path, k)."""
    for batch in batches:
        if batch.num_rows:
            path = batch.column("path").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            row, child = children(path, _tokens(batch.column("sig")))
            k = batch.column("k").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(k[row])], names=["path", "k"])


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k, sig) to the first level of every tree."""
    tree = np.arange(TREES, dtype=np.uint64)
    roots = (mix((tree + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)) & ~np.uint64(TREE_BITS)) | tree
    for batch in batches:
        if batch.num_rows:
            tokens = _tokens(batch.column("sig"))
            k = batch.column("k").to_numpy(zero_copy_only=False)
            for root in roots:
                row, child = children(np.full(len(k), root), tokens)
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(k[row])], names=["path", "k"])


def _distant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, x, y) to (path, far): 1 where the estimate is below a candidate's."""
    for batch in batches:
        if batch.num_rows:
            far = (_bytes(batch.column("x")) == _bytes(batch.column("y"))).mean(axis=1) < MAYBE
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(far.astype(np.int32))], names=["path", "far"])


def settled(large: DataFrame, crowd: DataFrame) -> DataFrame:
    """Paths of nodes in which at most one member in ``OUTLIERS`` is unlike the smallest one.

    Branching such a node on would keep its members together, so it stops
    here; its outliers are compared with all of it in the second step.
    """
    marks = crowd.select("k", "sig").mapInArrow(_mark, "k long, mark binary")
    pairs = (large.join(marks.withColumnRenamed("mark", "x"), "k")
             .join(marks.select(F.col("k").alias("centre"), F.col("mark").alias("y")), "centre").select("path", "x", "y"))
    return (pairs.mapInArrow(_distant, "path long, far int").groupBy("path").agg(F.sum("far").alias("far"), F.count("*").alias("n"))
            .where(F.col("far") * OUTLIERS <= F.col("n")).select("path"))


def grow(classes: DataFrame) -> DataFrame:
    """``path, k, n, centre`` of all nodes where branching stopped with two or more classes."""
    rows = classes.select("k", "sig").mapInArrow(_plant, "path long, k long")
    done = crowd = None
    for level in range(1, DEPTH + 1):
        sizes = rows.groupBy("path").agg(F.count("*").alias("n"), F.min("k").alias("centre")).where("n > 1")
        rows, _ = written(rows.join(sizes, "path"))
        stop = rows if level == DEPTH else rows.where(F.col("n") <= SMALL)
        done = stop if done is None else done.unionByName(stop)
        if level == DEPTH:
            break
        large = rows.where(F.col("n") > SMALL)
        if crowd is None:  # whoever branches on later is among those that branch now
            crowd, n = written(classes.select("k", "sig").join(large.select("k").distinct(), "k", "left_semi"))
            if not n:
                break
        still, _ = written(settled(large, crowd))
        done = done.unionByName(large.join(still, "path", "left_semi").select(done.columns))
        large, n = written(large.join(still, "path", "left_anti").select("path", "k"))
        if not n:
            break
        rows = large.join(crowd, "k").mapInArrow(_branch, "path long, k long").coalesce(tasks_for(2 * n))
    return done


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, TOKENS)


def _estimates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            e = (_bytes(batch.column("x")) == _bytes(batch.column("y"))).mean(axis=1)
            keep = np.flatnonzero(e >= MAYBE)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep), pa.array(e[keep])],
                                             names=["a", "b", "e"])


def star_pairs(nodes: DataFrame, marks: DataFrame) -> DataFrame:
    """For every class the most similar of the smallest classes of its nodes: (a, b) with a < b."""
    pairs = nodes.where("k <> centre").select(F.col("centre").alias("a"), F.col("k").alias("b")).distinct()
    seen = (pairs.join(marks.select(F.col("k").alias("a"), F.col("mark").alias("x")), "a")
            .join(marks.select(F.col("k").alias("b"), F.col("mark").alias("y")), "b").select("a", "b", "x", "y"))
    best = (seen.mapInArrow(_estimates, "a long, b long, e double").groupBy("b")
            .agg(F.max(F.struct("e", (-F.col("a")).alias("a"))).alias("m")))
    return best.select((-F.col("m.a")).alias("a"), "b")


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[dict]:
    """Whole groups (rows of one ``g`` stand one after another) as arrays."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        if held is not None:
            part = {c: np.concatenate([held[c], part[c]]) for c in part}
        edges = [0, *(np.flatnonzero(part["g"][1:] != part["g"][:-1]) + 1).tolist()]
        for a, b in zip(edges, edges[1:]):
            yield {c: v[a:b] for c, v in part.items()}
        held = {c: v[edges[-1]:] for c, v in part.items()}
    if held is not None:
        yield held


def _near(part: dict, fine: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each visitor of a group the members of other components that may be linked, with estimates."""
    comp, side = part["comp"], part["side"]
    left, right = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
    if not len(left) or not len(right) or comp.min() == comp.max():
        return
    marks = np.frombuffer(b"".join(part["mark"]), dtype=np.uint8).reshape(-1, TOKENS)
    more = None
    for j in right:
        i = left[comp[left] != comp[j]]
        if not len(i):
            continue
        e = (marks[i] == marks[j]).mean(axis=1)
        i, e = i[e >= MAYBE], e[e >= MAYBE]
        if fine and len(i):
            if more is None:
                more = [np.frombuffer(m, dtype=np.uint8) for m in part["fine"]]
            if len(more[j]):
                e = np.array([(more[x] == more[j]).mean() if len(more[x]) else 1.0 for x in i])
                i, e = i[e >= FINE_MAYBE], e[e >= FINE_MAYBE]
        if len(i):
            yield j, i, e


def _best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each visitor its most similar member of another component: (b, a, e). Groups are bounded."""
    known: dict = {}
    for part in _groups(batches, ("g", "k", "comp", "mark", "side")):
        k = part["k"]
        out = []
        for j, i, e in _near(part, False):
            at = e.argmax()
            # nodes of one family stand in one task: only what improves on the last answer is given
            if e[at] > known.get(k[j], 0.0):
                if len(known) > SEEN:
                    known.clear()
                known[k[j]] = e[at]
                out.append((k[j], k[i[at]], e[at]))
        if out:
            b, a, e = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(a, pa.int64()), pa.array(e, pa.float64())],
                                             names=["b", "a", "e"])


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether sorted distinct hashes of two sets have ``100 * intersection >= percent * union``."""
    if len(x) > len(y):
        x, y = y, x
    if 100 * len(x) < percent * len(y):
        return False
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(x) else 0
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _all(percent: int):
    """Links across components, one between any two of them in a task, and pairs that may be links but must be
    confirmed on sets that no group holds. Every candidate is confirmed, here or later. Groups are bounded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        joined: set = set()
        for part in _groups(batches, ("g", "k", "comp", "mark", "fine", "whole", "side")):
            k, comp, whole = part["k"].tolist(), part["comp"].tolist(), part["whole"]
            sets: dict = {}
            out = []
            for j, i, e in _near(part, True):
                for x in i[np.argsort(-e, kind="stable")].tolist():
                    pair = (min(k[j], k[x]), max(k[j], k[x]))
                    ends = (min(comp[j], comp[x]), max(comp[j], comp[x]))
                    if pair in seen or ends in joined:
                        continue
                    if len(seen) > SEEN:
                        seen.clear()
                    seen.add(pair)
                    known = bool(len(whole[j]) and len(whole[x]))
                    if known:
                        for m in (j, x):
                            if m not in sets:
                                sets[m] = np.frombuffer(whole[m], np.uint64)
                        if not alike(sets[j], sets[x], percent):
                            continue
                        if len(joined) > SEEN:
                            joined.clear()
                        joined.add(ends)
                    out.append((*pair, known))
            if out:
                a, b, sure = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sure)], names=["a", "b", "sure"])

    return run


def _blocks(n: str):
    """Number of blocks for n members: a power of two, so that nodes of like size cut their members alike."""
    return F.pow(F.lit(2), F.ceil(F.log2(F.ceil(F.col(n) / BLOCK)))).cast("long")


def mixed_nodes(nodes: DataFrame, found: DataFrame) -> tuple[DataFrame, int]:
    """``path, k, n, centre, comp`` of nodes whose members are in more than one component."""
    known = found.select(F.col("id").alias("k"), F.col("component").alias("comp"))
    rows = nodes.join(known, "k", "left").withColumn("comp", F.coalesce("comp", "k"))
    mixed = rows.groupBy("path").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("path")
    return written(rows.join(mixed, "path", "left_semi"))


def groups(rows: DataFrame) -> DataFrame:
    """Comparisons of mixed nodes: ``path, centre, i, j, k, comp, side`` (1: stands, 2: visits, 3: both).

    A small node is one group. In a large one everything outside its largest
    component visits the whole node, block by block.
    """
    zero = F.lit(0).cast("long")
    small = rows.where(F.col("n") <= SMALL).select(
        "path", "centre", "k", "comp", zero.alias("i"), zero.alias("j"), F.lit(3).alias("side"))
    large = rows.where(F.col("n") > SMALL)
    main = (large.groupBy("path", "comp").agg(F.count("*").alias("c")).groupBy("path")
            .agg(F.max(F.struct("c", "comp")).alias("m"), F.sum("c").alias("all"))
            .select("path", F.col("m.comp").alias("main"), (F.col("all") - F.col("m.c")).alias("rest")))
    large = large.join(main, "path").withColumn("nb", _blocks("n")).withColumn("nr", _blocks("rest"))
    part = lambda n, salt: F.pmod(F.xxhash64("k", F.lit(salt)), n)
    left = large.select("path", "centre", "k", "comp", part(F.col("nb"), 1).alias("i"),
                        F.explode(F.sequence(zero, F.col("nr") - 1)).alias("j"), F.lit(1).alias("side"))
    right = large.where("comp <> main").select(
        "path", "centre", "k", "comp", F.explode(F.sequence(zero, F.col("nb") - 1)).alias("i"),
        part(F.col("nr"), 2).alias("j"), F.lit(2).alias("side"))
    return small.unionByName(left).unionByName(right)


def _in_order(work: DataFrame, n: int, *columns: str) -> DataFrame:
    """Groups whole and one after another; those of one family and block in one task."""
    return (work.coalesce(tasks_for(n)).repartition("centre", "i", "j").sortWithinPartitions("centre", "i", "j", "path")
            .select(F.xxhash64("path", "i", "j").alias("g"), *columns))


def attach(nodes: DataFrame, found: DataFrame, marks: DataFrame) -> DataFrame:
    """For every class in a mixed node its best candidate in another component, as pairs (a, b), a < b."""
    rows, n = mixed_nodes(nodes, found)
    work = _in_order(groups(rows).join(marks, "k"), n, "k", "comp", "mark", "side")
    best = work.mapInArrow(_best, "b long, a long, e double").groupBy("b").agg(F.max(F.struct("e", "a")).alias("m"))
    return best.select(F.least("b", "m.a").alias("a"), F.greatest("b", "m.a").alias("b")).distinct()


def cross_pairs(nodes: DataFrame, found: DataFrame, marks: DataFrame, sets: DataFrame, percent: int = 75) -> DataFrame:
    """Links (``sure``) and remaining candidate pairs across components in nodes that are still mixed.

    In large nodes the sets of at most ``WHOLE`` shingles stand in the groups, so
    that pairs of them are confirmed where they are found.
    """
    rows, n = mixed_nodes(nodes, found)
    crowd = rows.where(F.col("n") > SMALL).select("k").distinct()
    mine = sets.join(crowd, "k", "left_semi")
    fine = mine.mapInArrow(_fine, "k long, fine binary")
    held, _ = written(fine.join(mine.where(F.length("shingles") <= 8 * WHOLE).select("k", F.col("shingles").alias("whole")), "k", "left"), 5_000)
    inside = lambda c: F.coalesce(F.when(F.col("side") != 3, F.col(c)), F.lit(b"")).alias(c)
    work = groups(rows).join(marks, "k").join(held, "k", "left").select(
        "path", "centre", "i", "j", "k", "comp", "side", "mark", inside("fine"), inside("whole"))
    return _in_order(work, n, "k", "comp", "mark", "fine", "whole", "side").mapInArrow(_all(percent), "a long, b long, sure boolean").distinct()


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One byte of each of many more tokens, from full sets."""
    for batch in batches:
        marks = [(minwise(np.frombuffer(s.as_buffer(), np.uint64), _FINE_MUL, np.uint32(0)) >> np.uint32(8)).astype(np.uint8).tobytes()
                 for s in batch.column("shingles")]
        yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(marks, pa.binary())], names=["k", "fine"])


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``k, shingles`` (sorted hashes as bytes) of wanted classes ``(k, id, digest)``, from their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column("text")):
                k, sets = batch.column("k")[a:b].to_pylist(), []
                digest, keep = batch.column("digest")[a:b].to_pylist(), []
                for i, s in enumerate(shingle_sets(data, offsets)):
                    raw = s.tobytes()
                    if hashlib.blake2b(raw, digest_size=16).digest() == digest[i]:
                        sets.append(raw)
                        keep.append(k[i])
                yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int64()), pa.array(sets, pa.binary())], names=["k", "shingles"])

    return docs.join(wanted, "id").select("k", "digest", "text").mapInArrow(run, "k long, shingles binary").dropDuplicates(["k"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with ``100 * intersection >= percent * union``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(rows), batch.column("b").take(rows)], names=["a", "b"])

    small_batches(pairs.sparkSession)
    return (pairs.join(sets.select(F.col("k").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("k").alias("b"), F.col("shingles").alias("y")), "b")
            .select("a", "b", "x", "y").mapInArrow(run, "a long, b long"))


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One byte of each token: enough to estimate similarity."""
    for batch in batches:
        if batch.num_rows:
            low = (_tokens(batch.column("sig")) & np.uint32(0xFF)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array([r.tobytes() for r in low], pa.binary())],
                                             names=["k", "mark"])


def _linked(slim: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of all rows, the classes among them, and ``id, component`` of the classes that are linked."""
    rows = cut_lineage(sketches(slim))
    classes = (rows.where("id is not null and n > 0").groupBy("digest").agg(F.min("id").alias("id"), F.first("sig").alias("sig"))
               .withColumn("k", F.monotonically_increasing_id()))
    classes, _ = written(classes, 20_000)  # written once, so the numbers stay
    nodes, _ = written(grow(classes))
    marks = classes.select("k", "sig").mapInArrow(_mark, "k long, mark binary")
    keys = classes.select("k", "id", "digest")
    sets = found = None
    for step in (lambda: star_pairs(nodes, marks), lambda: attach(nodes, found, marks),
                 lambda: cross_pairs(nodes, found, marks, sets, percent)):
        pairs, _ = written(step())
        sure = None
        if "sure" in pairs.columns:
            sure = pairs.where("sure").select("a", "b")
            pairs = pairs.where("NOT sure").select("a", "b")
        ends = pairs.select(F.col("a").alias("k")).unionByName(pairs.select(F.col("b").alias("k"))).distinct()
        missing = keys.join(ends, "k", "left_semi")
        if sets is not None:
            missing = missing.join(sets.select("k"), "k", "left_anti")
        more, _ = written(full_sets(slim, by_size(*written(missing))), 5_000)
        sets = more if sets is None else sets.unionByName(more)
        confirmed = confirm(pairs, sets, percent)
        links, n = written(confirmed if sure is None else confirmed.unionByName(sure))
        if found is None:
            found = components(links)
        elif n:  # the components so far, as links to their smallest member, stand for all links found before
            found = components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(links))
    return rows, classes, found


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", percent: int = 75) -> DataFrame:
    """``id, n_shingles, component_id, kept, text_hash`` for every row of ``docs``."""
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    with shuffled_joins(docs.sparkSession):
        rows, classes, found = _linked(slim, percent)
    found = found.select(F.col("id").alias("k"), F.col("component").alias("comp"))
    lowest = classes.join(found, "k").groupBy("comp").agg(F.min("id").alias("low"))
    of_class = (classes.select("k", "digest", "id").join(found.join(lowest, "comp").select("k", "low"), "k", "left")
                .select("digest", F.coalesce("low", "id").alias("low")))
    out = rows.select("id", "text_hash", "n", "digest").join(of_class, "digest", "left")
    component = F.when(F.col("id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("id")).otherwise(F.col("low"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"), "text_hash")


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", percent: int = 75) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest id of its component, unchanged.

    Rows that repeat both id and text are one document and stay together.
    """
    gone = (near_duplicates(docs, text_col, id_col, percent).where("not kept")
            .select(F.col(id_col).alias("_gone_id"), F.col("text_hash").alias("_gone_text")).distinct())
    with shuffled_joins(docs.sparkSession):
        gone = by_size(*written(gone))
    return docs.join(gone, (docs[id_col] == gone["_gone_id"]) & (F.xxhash64(docs[text_col]) == gone["_gone_text"]), "left_anti")
