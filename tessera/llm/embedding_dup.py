"""Near-duplicate embeddings through an inverted multi-index.

Vectors are cut into halves, each half has a codebook of its own, and the
product of the codebooks is a grid of cells. Every vector is stored in its
cell. Its search visits cells in the order of the squared distance to them,
summed over both halves (the distance of a half to another codeword's region
is at least its distance to the plane between the two codewords), and stops
at the radius in which all linked vectors lie, or, with ``recall`` below 1,
earlier: where offsets point in random directions, fewer than ``1 - recall``
of the links remain. What the visit finds is compared by one byte for each
component, with the lengths of the rounding errors as bound, and every pair
that may reach the threshold is verified by cosine in double precision.

Equal vectors of one label are one class first. Cells are cut into blocks and
their visitors into chunks, so no task holds a whole hot cell.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without a label or an id, link with nothing; vectors of
different lengths are not compared; rows that repeat an id are vectors of
their own (a class counts every row); ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import components, written

SAMPLE = 8192  # vectors the codebooks are fitted on
BLOCK = 512
CHUNK = 4096
SLACK = 1.0  # for sums in single precision, in units of 1 / 127 ** 2


def lloyd(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Codebook of ``k`` words for the rows of ``x``."""
    rng = np.random.default_rng(11)
    words = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = distances(x, words).argmin(axis=1)
        for j in range(len(words)):
            if (own == j).any():
                words[j] = x[own == j].mean(axis=0)
    return words


def distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ words.T + (words * words).sum(1)[None, :], 0)


def half_bounds(x: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest codeword, and for every codeword the squared distance to its region (a lower bound)."""
    d = distances(x, words)
    own = d.argmin(axis=1)
    apart = np.sqrt(distances(words, words))
    np.fill_diagonal(apart, 1.0)
    gap = (d - d[np.arange(len(x)), own][:, None]) / (2 * np.maximum(apart[own], 1e-12))
    return own, np.maximum(gap, 0) ** 2


def visited(x: np.ndarray, books: tuple[np.ndarray, np.ndarray], bound: float) -> Iterator[tuple[int, int, list[int]]]:
    """For each row its home cell and the cells visited after it, nearest first.

    The multi-sequence walk: both halves' codewords in order of distance,
    pairs by the sum, until the sum passes the bound. Of two cells that may
    see each other only the lower one visits, so a pair is met once.
    """
    half = books[0].shape[1]
    own1, b1 = half_bounds(x[:, :half], books[0])
    own2, b2 = half_bounds(x[:, half:], books[1])
    width = len(books[1])
    for i in range(len(x)):
        o1 = np.flatnonzero(b1[i] <= bound)
        o2 = np.flatnonzero(b2[i] <= bound)
        total = b1[i][o1][:, None] + b2[i][o2][None, :]
        r, c = np.nonzero(total <= bound)
        order = np.argsort(total[r, c], kind="stable")
        cells = (o1[r] * width + o2[c])[order]
        home = int(own1[i]) * width + int(own2[i])
        yield i, home, cells[cells > home].tolist()


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, v in enumerate(column.to_pylist()):
        out[i, :len(v)] = v
    return out


def unit(x: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def codes(x: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in np.clip(np.rint(x * 127), -127, 127).astype(np.int8)]


def rounding(x: np.ndarray) -> np.ndarray:
    """Length of what the byte codes of each row leave out."""
    x = x * 127
    return np.sqrt(((x - np.rint(x)) ** 2).sum(axis=1))


def _sides(code: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose products, of a left and a right one, are never below the vectors' own product.

    With codes c, d and rests r, s: (c + r)(d + s) <= cd + |c||s| + |r||d| + |r||s|.
    """
    code = code.astype(np.float32)
    size = np.sqrt((code * code).sum(axis=1))
    off = off.astype(np.float32)
    return np.column_stack([code, size, off, off]), np.column_stack([code, off, size, off])


def _match(threshold: float, width: int):
    """Rows (g, home, k, code, off), homes of a group first, to candidate pairs. Memory: one block of homes."""
    floor = threshold * 127 * 127 - SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, keys, rows = None, [], []
        block = None
        for batch in batches:
            if not batch.num_rows:
                continue
            g = batch.column("g").to_numpy(zero_copy_only=False)
            home = batch.column("home").to_numpy(zero_copy_only=False).astype(bool)
            k = batch.column("k").to_numpy(zero_copy_only=False)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.int8).reshape(len(g), width)
            left, right = _sides(code, batch.column("off").to_numpy(zero_copy_only=False))
            cuts = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)]
            found_a, found_b = [], []
            for s, e in zip(cuts, cuts[1:]):
                if group != g[s]:
                    group, keys, rows, block = g[s], [], [], None
                h = home[s:e]
                if h.any():
                    keys.append(k[s:e][h])
                    rows.append(right[s:e][h])
                    block = None
                if not h.all() and keys:
                    if block is None:
                        block = np.concatenate(keys), np.concatenate(rows)
                    hk, hx = block
                    vk, vx = k[s:e][~h], left[s:e][~h]
                    i, j = np.nonzero(vx @ hx.T >= floor)
                    a, b = vk[i], hk[j]
                    keep = a != b
                    found_a.append(np.minimum(a, b)[keep])
                    found_b.append(np.maximum(a, b)[keep])
            if found_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))],
                                                 names=["a", "b"])

    return run


def index(classes: DataFrame, width: int, words: int, threshold: float, recall: float) -> DataFrame:
    """``k, group, cell, code, off, visits``: every vector in its cell, with the cells it visits."""
    spark = classes.sparkSession
    picked = classes.orderBy(F.xxhash64("k")).limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
    x = unit(_matrix(picked, width)) if len(picked) else np.ones((1, width))
    half = width // 2
    books = spark.sparkContext.broadcast((lloyd(x[:, :half], words), lloyd(x[:, half:], words)))  # words x width numbers
    # a link's offset has length sqrt(2 - 2t), so no linked vector lies in a cell farther away
    bound = 2 - 2 * threshold + 1e-9
    if recall < 1:
        # where offsets point in random directions, their squares along the two that matter sum to more than this
        # for a share of 1 - recall of links
        bound = min(bound, -2 * (2 - 2 * threshold) / width * math.log(1 - recall))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = unit(_matrix(batch.column("v"), width))
                cells, visits = [], []
                for _, home, others in visited(x, books.value, bound):
                    cells.append(home)
                    visits.append(others)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k"), batch.column("group"), pa.array(cells, pa.int64()),
                     pa.array(codes(x), pa.binary()), pa.array(rounding(x)), pa.array(visits, pa.list_(pa.int64()))],
                    names=["k", "group", "cell", "code", "off", "visits"])

    return classes.select("k", F.xxhash64("label", F.size("v")).alias("group"), "v").mapInArrow(
        run, "k long, group long, cell long, code binary, off double, visits array<long>")


def candidates(indexed: DataFrame, width: int, threshold: float) -> DataFrame:
    """Pairs (a, b), a < b, whose byte codes may reach the threshold."""
    homes = indexed.select("group", "cell", "k", "code", "off")
    visitors = indexed.select("group", F.explode(F.concat(F.array("cell"), "visits")).alias("cell"), "k", "code", "off")
    filled = homes.groupBy("group", "cell").agg(F.count("*").alias("homes"))
    visitors = visitors.join(filled, ["group", "cell"])  # empty cells go
    size = (visitors.groupBy("group", "cell").agg(F.count("*").alias("visits"), F.max("homes").alias("homes"))
            .select("group", "cell", F.ceil(F.col("homes") / BLOCK).alias("nb"), F.ceil(F.col("visits") / CHUNK).alias("nc")))
    pick = lambda n, salt: F.pmod(F.xxhash64("k", F.lit(salt)), n)
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    left = (homes.join(size, ["group", "cell"]).withColumn("i", pick(F.col("nb"), 1)).withColumn("j", upto(F.col("nc")))
            .withColumn("home", F.lit(1)))
    right = (visitors.drop("homes").join(size, ["group", "cell"]).withColumn("j", pick(F.col("nc"), 2))
             .withColumn("i", upto(F.col("nb"))).withColumn("home", F.lit(0)))
    rows = left.unionByName(right).select("group", "cell", "i", "j", "home", "k", "code", "off")
    # a group is known by its whole key, so that no two share one
    ordered = (rows.repartition("group", "cell", "i", "j").sortWithinPartitions("group", "cell", "i", "j", F.desc("home"))
               .select(F.xxhash64("group", "cell", "i", "j").alias("g"), "home", "k", "code", "off"))
    return ordered.mapInArrow(_match(threshold, width), "a long, b long").distinct()


def verify(pairs: DataFrame, classes: DataFrame, width: int, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = _matrix(batch.column("x"), width), _matrix(batch.column("y"), width)
                x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
                cosine = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
                keep = pa.array(np.flatnonzero(cosine >= threshold))
                yield pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep)], names=["a", "b"])

    return (pairs.join(classes.select(F.col("k").alias("a"), F.col("label").alias("lx"), F.col("v").alias("x")), "a")
            .join(classes.select(F.col("k").alias("b"), F.col("label").alias("ly"), F.col("v").alias("y")), "b")
            .where((F.col("lx") == F.col("ly")) & (F.size("x") == F.size("y"))).select("a", "b", "x", "y").mapInArrow(run, "a long, b long"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, recall: float = 1.0, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``id, n_links, component_id, kept`` for every row of ``vectors``."""
    v = F.col(vector_col).cast("array<double>")
    fine = (F.col(vector_col).isNotNull() & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
            & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
            & F.exists(v, lambda x: F.coalesce(x != 0, F.lit(False))))
    # negative zero equals zero
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.when(F.coalesce(fine, F.lit(False)), F.transform(v, lambda x: x + 0.0)).alias("v"))
    classes = (rows.where("v is not null").groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("size"))
               .withColumn("k", F.monotonically_increasing_id()))
    classes, n = written(classes, 20_000)  # written once, so the numbers stay
    width = classes.agg(F.max(F.size("v")).alias("width")).first()["width"] or 2
    width += width % 2
    words = 2 ** min(8, max(2, round(math.log2(max(math.sqrt(n / 128), 1)))))
    indexed, _ = written(index(classes, width, words, threshold, recall), 20_000)
    links, _ = written(verify(candidates(indexed, width, threshold), classes, width, threshold))
    found = components(links).select(F.col("id").alias("k"), F.col("component").alias("comp"))
    lowest = classes.join(found, "k").groupBy("comp").agg(F.min("id").alias("low"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = (both.join(classes.select(F.col("k").alias("b"), "size"), "b").groupBy(F.col("a").alias("k"))
              .agg(F.sum("size").alias("others")))
    of_class = (classes.join(linked, "k", "left").join(found.join(lowest, "comp").select("k", "low"), "k", "left")
                .select("label", "v", (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                        F.coalesce("low", "id").alias("low")))
    out = rows.join(of_class, ["label", "v"], "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                      F.coalesce("low", "id").cast("long").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
