"""Quality classifier by positive-unlabelled learning (non-negative risk).

Trusted positives are documents labelled good; everything else the model sees
is unlabelled web text. With ``p`` the estimated share of good texts, the
model minimises ``p * R+(positives) + max(0, R-(unlabelled) - p *
R-(positives))`` for the logistic loss; when the second part turns negative,
the step goes against it. Features are dense statistics cut at the quantiles
of the unlabelled sample, so each contributes a step function. Samples are
bounded by ``positives`` and ``unlabelled`` rows (the smallest hashes of the
id); scoring reads every whole text once, without a shuffle.

Defined cases: null text scores as empty text. Without positives or without
unlabelled rows every text gets the class prior. Null labels are ignored.
Texts of any length are read whole; an empty table gives no rows; repeated rows
are scored alike; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import fold, small_batches, text_blocks
from tessera.llm.textstats import plain_words, repetition_features, shape_features

BINS = 12


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    words = plain_words(data, offsets)
    return np.concatenate([shape_features(data, offsets, words), repetition_features(data, offsets, words)], axis=1)


def steps(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Thermometer coding: one column for each edge a value passes."""
    return np.concatenate([(x[:, j:j + 1] > e[None, :]) for j, e in enumerate(edges)], axis=1).astype(np.float32)


def fit_nnpu(xp: np.ndarray, xu: np.ndarray, prior: float, rounds: int = 400, rate: float = 0.05,
             decay: float = 2e-4) -> tuple[np.ndarray, float]:
    """Linear model of least non-negative unbiased risk, by full-batch Adam."""
    xp = np.concatenate([xp, np.ones((len(xp), 1), np.float32)], axis=1)
    xu = np.concatenate([xu, np.ones((len(xu), 1), np.float32)], axis=1)
    w = np.zeros(xp.shape[1])
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, rounds + 1):
        fp, fu = xp @ w, xu @ w
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        g_pos = -prior * ((1 - sigmoid(fp)) @ xp) / len(xp)
        g_neg = (sigmoid(fu) @ xu) / len(xu) - prior * (sigmoid(fp) @ xp) / len(xp)
        g = (g_pos + g_neg if negative >= 0 else -g_neg) + decay * np.append(w[:-1], 0.0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


def class_prior(labels: DataFrame, label_col: str) -> float:
    """Share of good texts among all learnable labelled rows, smoothed."""
    r = labels.agg(F.sum(F.col(label_col)).alias("p"), F.count("*").alias("n")).first()
    return float(((r["p"] or 0) + 1) / (r["n"] + 2))


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, text_col: str = "text", id_col: str = "doc_id",
        label_col: str = "quality", positives: int = 6_000, unlabelled: int = 12_000) -> dict:
    """Fit on rows where ``learn`` (over an id column) holds."""
    small_batches(docs.sparkSession)
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    pool = docs.where(F.col(id_col).isNotNull())
    if learn is not None:
        marked, pool = marked.where(learn), pool.where(learn)
    prior = min(max(class_prior(marked, label_col), 0.01), 0.99)
    order = F.xxhash64(F.col("id").cast("string"))
    good = (marked.where(F.col(label_col) == 1).select(F.col(id_col).alias("id")).withColumn("h", order)
            .orderBy("h", "id").limit(positives).withColumn("p", F.lit(1)))
    web = (pool.select(F.col(id_col).alias("id")).withColumn("h", order).orderBy("h", "id").limit(unlabelled)
           .withColumn("p", F.lit(0)))
    # bounded by the two sample sizes
    rows = (pool.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .join(F.broadcast(good.unionByName(web)), "id").select("text", "p", "h"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("h")[a:b], batch.column("p")[a:b], pa.array(list(features(data, offsets)), pa.list_(pa.float64()))],
                    names=["h", "p", "x"])

    got = rows.mapInArrow(featurise, "h long, p int, x array<double>").toArrow().sort_by([("p", "ascending"), ("h", "ascending")])
    p = got.column("p").to_numpy().astype(int)
    if not p.any() or p.all():
        return {"prior": prior}
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(len(p), -1)
    edges = [np.unique(np.quantile(x[p == 0, j], np.linspace(0, 1, BINS + 1)[1:-1]).tolist()
                       + np.quantile(x[p == 0, j], [0.01, 0.02, 0.04, 0.96, 0.98, 0.99]).tolist()) for j in range(x.shape[1])]
    coded = steps(x, edges)
    return {"prior": prior, "edges": edges, "weights": fit_nnpu(coded[p == 1], coded[p == 0], prior)}


def scorer(model: dict):
    """Column function ``text -> score`` between 0 and 1."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for _, _, data, offsets in text_blocks(texts):
            if "weights" in model:
                w, b = model["weights"]
                z = steps(features(data, offsets), model["edges"]) @ w + b
                out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            else:
                out.append(np.full(len(offsets) - 1, model["prior"]))
        return pa.array(np.concatenate(out), pa.float64())

    return score


def score(docs: DataFrame, model: dict, text_col: str = "text", id_col: str = "doc_id", modulus: int = 4, held: int = 2,
          threshold: float = 0.7) -> DataFrame:
    """``id, held_out, score, predicted`` for every row."""
    small_batches(docs.sparkSession)
    return (docs.select(F.col(id_col), F.coalesce(fold(id_col, modulus) == held, F.lit(False)).alias("held_out"),
                        scorer(model)(F.col(text_col)).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
