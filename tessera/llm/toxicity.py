"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: densities of lexicon words and stems, how near they
stand to words of the second person, capitals, punctuation, and the rate of
obfuscated words. The lexicon is a short seed list plus the words and stems
whose document frequency in the training rows speaks most clearly for the
label. Trees are fitted with numpy on at most ``sample`` labelled rows (the
smallest hashes of the id); the calibration curve comes from out-of-fold
scores: each fold is scored by trees and a lexicon that have not seen its
labels. Scoring reads every whole text once, without a shuffle.

Defined cases: null text scores as empty text; a text of any length is read
whole, as a block of its own. Without labelled rows, or with one class only,
every text gets the smoothed share of the label. An empty table of documents
gives no rows. Rows repeated in the labels count once for each copy; a label
of null is ignored. Labelled rows of one hash are told apart by id, and equal
rows are alike. Other columns of the tables, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.blocks import fold, small_batches, sums, text_blocks
from tessera.llm.textstats import hash_words, member, plain_words, shape_features, stem_hashes

SEED_WORDS = [
    "idiot", "idiots", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown",
    "dumb", "imbecile", "fool", "garbage", "filth", "vermin", "hate", "crap", "bastard",
    "idiote", "imbécile", "crétin", "connard", "salaud", "ordure", "débile",
    "dumm", "blöd", "arschloch", "abschaum", "trottel", "versager", "schwachkopf",
    "idiota", "imbécil", "estúpido", "basura", "inútil", "asqueroso", "cabrón",
]
SECOND_PERSON = ["you", "your", "yours", "yourself", "u", "ur", "tu", "te", "toi", "vous", "votre", "du", "dich", "dir",
                 "dein", "ihr", "euch", "usted", "ustedes", "ti", "tú", "vosotros"]
NEAR = 6


def pieces(words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and of stems, with the position of the word each belongs to."""
    stems = stem_hashes(words)
    h = np.concatenate([words.hash, *stems])
    at = np.tile(np.arange(len(words.hash)), 1 + len(stems))
    keep = h != 0
    return h[keep], at[keep]


def learn_lexicons(rows: DataFrame, folds: int, min_docs: int, max_entries: int) -> list[np.ndarray]:
    """Sorted hashes of words and stems that speak for the label: without fold 0, without fold 1, ..., from all rows.

    Document frequencies are summed per task and fold, then by one aggregate;
    what a fold holds is taken off the sum. Only entries in at least
    ``min_docs`` toxic rows reach the driver, the ``max_entries`` clearest of
    each lexicon.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
            part = batch.column("part").to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b, data, offsets in text_blocks(batch.column("text")):
                words = plain_words(data, offsets)
                h, at = pieces(words)
                doc = np.searchsorted(words.bounds, at, side="right") - 1
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                first = np.ones(len(h), dtype=bool)
                first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                h, doc = h[first], doc[first]
                value, inverse = np.unique(h, return_inverse=True)
                cell, inverse = np.unique(inverse * folds + part[a:b][doc], return_inverse=True)
                pos = np.bincount(inverse, weights=y[a:b][doc], minlength=len(cell))
                all_ = np.bincount(inverse, minlength=len(cell))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[cell // folds].view(np.int64)), pa.array(cell % folds), pa.array(pos.astype(np.int64)),
                     pa.array(all_.astype(np.int64))], names=["h", "part", "pos", "n"])

    sizes = {r["part"]: (float(r["pos"]), float(r["n"]))
             for r in rows.groupBy("part").agg(F.sum("y").alias("pos"), F.count("*").alias("n")).collect()}
    ways = []
    for left_out in [*range(folds), None]:
        n1 = sum(p for k, (p, _) in sizes.items() if k != left_out)
        n0 = sum(n - p for k, (p, n) in sizes.items() if k != left_out)
        if n1 and n0:
            used = F.lit(True) if left_out is None else F.col("part") != left_out
            ways.append((folds if left_out is None else left_out, n1, n0, used))
    lexicons = [np.zeros(0, dtype=np.uint64) for _ in range(folds + 1)]
    if not ways:
        return lexicons
    sums_of = [F.sum(F.when(used, F.col(c)).otherwise(0)).alias(f"{c}{k}") for k, _, _, used in ways for c in ("pos", "n")]
    totals = rows.mapInArrow(count, "h long, part long, pos long, n long").groupBy("h").agg(*sums_of)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("way"), F.lit(n1).alias("n1"), F.lit(n0).alias("n0"),
                                        F.col(f"pos{k}").alias("pos"), F.col(f"n{k}").alias("n")) for k, n1, n0, _ in ways]))
    odds = (F.log((F.col("pos") + 0.5) / (F.col("n1") + 1)) - F.log((F.col("n") - F.col("pos") + 0.5) / (F.col("n0") + 1)))
    rank = F.row_number().over(W.partitionBy("way").orderBy(F.desc(F.col("odds") * F.log1p("pos")), "h"))
    best = (totals.select("h", each.alias("e")).select("h", "e.*").where(F.col("pos") >= min_docs)
            .withColumn("odds", odds).where("odds > 2.5").withColumn("rank", rank).where(F.col("rank") <= max_entries)
            .select("way", "h").collect())
    for k, *_ in ways:
        lexicons[k] = np.sort(np.array([r["h"] for r in best if r["way"] == k], dtype=np.int64).view(np.uint64))
    return lexicons


def features(data: np.ndarray, offsets: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    return next(features_by(data, offsets, [lexicon]))


def features_by(data: np.ndarray, offsets: np.ndarray, lexicons: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The features under each lexicon; a text is cut into words once."""
    words = plain_words(data, offsets)
    n = np.maximum(words.counts(), 1)
    seed = member(words.hash, np.sort(hash_words(SEED_WORDS)))
    person = member(words.hash, np.sort(hash_words(SECOND_PERSON)))
    h, at = pieces(words)
    run = np.zeros(len(person) + 1, dtype=np.int64)
    np.cumsum(person, out=run[1:])
    doc = np.searchsorted(words.bounds, np.arange(len(person)), side="right") - 1
    i = np.arange(len(person))
    lo = np.maximum(i - NEAR, words.bounds[doc]) if len(i) else i
    hi = np.minimum(i + NEAR + 1, words.bounds[doc + 1]) if len(i) else i
    by_person = (run[hi] - run[lo]) > 0
    shape = shape_features(data, offsets, words)
    by = lambda flag: sums(flag, words.bounds)
    for lexicon in lexicons:
        learnt = np.zeros(len(words.hash), dtype=bool)
        learnt[at[member(h, lexicon)]] = True
        hit = seed | learnt
        own = np.stack([by(seed) / n, by(learnt) / n, by(hit) / n, np.log1p(by(seed)), np.log1p(by(learnt)),
                        by(hit & by_person) / n, by(person) / n], axis=1)
        yield np.concatenate([own, shape], axis=1)


# --- trees -------------------------------------------------------------------

def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.int32)


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32,
              leaf: float = 3.0) -> dict:
    """Boosted regression trees of a fixed depth for the logistic loss, split on quantile histograms."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = _bins(x, edges)
    d, width = x.shape[1], bins + 1
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    f = np.full(len(y), base)
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        feature, cut = np.zeros(2 ** depth - 1, int), np.full(2 ** depth - 1, width, int)
        for level in range(depth):
            first = 2 ** level - 1
            local = node - first
            m = 2 ** level
            best = np.full(m, 1e-9)
            for j in range(d):
                key = local * width + binned[:, j]
                gs = np.bincount(key, weights=g, minlength=m * width).reshape(m, width).cumsum(axis=1)
                hs = np.bincount(key, weights=h, minlength=m * width).reshape(m, width).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + leaf) + (gt - gs) ** 2 / (ht - hs + leaf) - gt ** 2 / (ht + leaf)
                at = gain.argmax(axis=1)
                top = gain[np.arange(m), at]
                for k in np.flatnonzero(top > best):
                    best[k], feature[first + k], cut[first + k] = top[k], j, at[k]
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[node])
        leaf_of = node - (2 ** depth - 1)
        value = np.bincount(leaf_of, weights=g, minlength=2 ** depth) / (np.bincount(leaf_of, weights=h, minlength=2 ** depth) + leaf)
        trees.append((feature, cut, rate * value))
        f = f + rate * value[leaf_of]
    return {"edges": edges, "base": base, "trees": trees, "depth": depth}


def tree_margin(model: dict, x: np.ndarray) -> np.ndarray:
    binned = _bins(x, model["edges"])
    f = np.full(len(x), model["base"])
    rows = np.arange(len(x))
    for feature, cut, value in model["trees"]:
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(model["depth"]):
            node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
        f += value[node - (2 ** model["depth"] - 1)]
    return f


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the non-decreasing step curve nearest to ``y`` (knots, values)."""
    order = np.argsort(score, kind="stable")
    knots, start = np.unique(score[order], return_index=True)
    weight = np.diff(np.append(start, len(score))).astype(float)
    mean = np.add.reduceat(y[order].astype(float), start) / weight
    blocks: list[list[float]] = []
    for k, (m, w) in enumerate(zip(mean, weight)):
        blocks.append([m, w, k])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, _ = blocks.pop()
            m1, w1, k1 = blocks[-1]
            blocks[-1] = [(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, k1]
    at = np.array([int(b[2]) for b in blocks])
    return knots[at], np.array([(b[0] * b[1] + 0.5) / (b[1] + 1) if b[0] in (0.0, 1.0) else b[0] for b in blocks])


def calibrated(curve: tuple[np.ndarray, np.ndarray], margin: np.ndarray) -> np.ndarray:
    knots, values = curve
    at = np.clip(np.searchsorted(knots, margin, side="right") - 1, 0, len(values) - 1)
    # within a step the order of the margins is kept by a hair
    return np.clip(values[at] + 1e-6 / (1 + np.exp(-np.clip(margin, -30, 30))), 0, 1)


# --- fit and score -----------------------------------------------------------

def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, text_col: str = "text", id_col: str = "doc_id",
        label_col: str = "toxic", sample: int = 12_000, folds: int = 4, min_docs: int = 5, max_entries: int = 2000) -> dict:
    """Fit on labelled rows where ``learn`` (over the label table's id) holds; ``sample`` bounds their number.

    A learnt lexicon has at most ``max_entries`` words and stems, each in at
    least ``min_docs`` toxic rows. Copies of an id fall into one fold.
    """
    small_batches(docs.sparkSession)
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if learn is not None:
        chosen = chosen.where(learn)
    chosen = (chosen.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"),
                            F.xxhash64(F.col(id_col).cast("string")).alias("h")).orderBy("h", "id").limit(sample))
    # at most `sample` narrow rows: bounded, so it can be sent to every task
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "id").select("text", "y", "h", F.pmod("h", F.lit(folds)).alias("part")))
    lexicons = learn_lexicons(rows, folds, min_docs, max_entries)
    lexicon = lexicons[folds]

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column("text")):
                x = np.concatenate(list(features_by(data, offsets, lexicons)), axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("h")[a:b], batch.column("part")[a:b], batch.column("y")[a:b],
                                                  pa.array(list(x), pa.list_(pa.float64()))], names=["h", "part", "y", "x"])

    got = rows.mapInArrow(featurise, "h long, part long, y double, x array<double>").toArrow().sort_by("h")
    y, part = got.column("y").to_numpy().astype(float), got.column("part").to_numpy()
    share = (y.sum() + 1) / (len(y) + 2)
    if not len(y) or y.min() == y.max():
        return {"share": float(share), "lexicon": lexicon}
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(len(y), folds + 1, -1)
    margin = np.zeros(len(y))
    for k in range(folds):
        if (part == k).any() and (part != k).any():
            margin[part == k] = tree_margin(fit_trees(x[part != k, k], y[part != k]), x[part == k, k])
    return {"lexicon": lexicon, "trees": fit_trees(x[:, folds], y), "curve": isotonic(margin, y)}


def scorer(model: dict):
    """Column function ``text -> score`` between 0 and 1."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for _, _, data, offsets in text_blocks(texts):
            if "trees" in model:
                out.append(calibrated(model["curve"], tree_margin(model["trees"], features(data, offsets, model["lexicon"]))))
            else:
                out.append(np.full(len(offsets) - 1, model["share"]))
        return pa.array(np.concatenate(out), pa.float64())

    return score


def score(docs: DataFrame, model: dict, text_col: str = "text", id_col: str = "doc_id", modulus: int = 5, held: int = 0,
          threshold: float = 0.5) -> DataFrame:
    """``id, held_out, score, predicted`` for every row."""
    small_batches(docs.sparkSession)
    return (docs.select(F.col(id_col), F.coalesce(fold(id_col, modulus) == held, F.lit(False)).alias("held_out"),
                        scorer(model)(F.col(text_col)).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
