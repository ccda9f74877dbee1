"""Language identification: family first, then one-versus-one linear SVMs within it.

A text becomes hashed byte-trigram frequencies (square roots, unit length).
A one-versus-rest linear SVM picks the language family; inside a family of
more than one language, linear SVMs for each pair of its languages vote.
Models are fitted by full-batch gradient steps on the squared hinge over a
bounded sample per language (``per_language``, by hash of the id); scoring
reads every whole text once, without a shuffle.

Defined cases: a null text, and one without a letter, gets ``und`` and score
0; so does every text if there is nothing to learn from. A language missing
from ``families`` is a family of its own. Repeated rows are scored alike. Texts of any length are
read whole; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.blocks import lower_table, small_batches, text_blocks

DIMS = 2048
UNDETERMINED = "und"
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ca": "romance", "ro": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "bg": "slavic",
}


def trigram_features(data: np.ndarray, offsets: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """One unit row of hashed trigram square-root frequencies for each text."""
    t = lower_table()[data].astype(np.uint32)
    out = np.zeros((len(offsets) - 1, dims), dtype=np.float32)
    if len(t) >= 3:
        codes = (t[:-2] * np.uint32(0x9E3779B1)) ^ (t[1:-1] * np.uint32(0x85EBCA77)) ^ (t[2:] * np.uint32(0xC2B2AE3D))
        codes = ((codes * np.uint32(0x27D4EB2F)) >> np.uint32(32 - int(dims).bit_length() + 1)).astype(np.int64)
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            if b - a >= 3:
                out[i] = np.bincount(codes[a:b - 2], minlength=dims)
    np.sqrt(out, out=out)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(norm, 1e-12)


def has_letter(text: bytes) -> bool:
    return text != b"" and any(ch.isalpha() for ch in text.decode("utf-8", "ignore"))


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 20.0, steps: int = 200) -> tuple[np.ndarray, float]:
    """Linear SVM (squared hinge, balanced classes) for labels -1 / +1 by accelerated gradient steps."""
    n, d = x.shape
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    y = y.astype(np.float32)
    xb = np.concatenate([x, np.ones((n, 1), np.float32)], axis=1)
    w = np.zeros(d + 1, dtype=np.float32)
    z, t, rate = w.copy(), 1.0, np.float32(1.0 / (1.0 + 4.0 * c))
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (xb @ z))
        grad = z - 2 * c * ((weight * y * slack) @ xb)
        new = z - rate * grad
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z = new + (t - 1) / t2 * (new - w)
        z, w, t = z.astype(np.float32), new, t2
    return w[:-1].astype(np.float32), float(w[-1])


def fit(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        families: dict | None = None, per_language: int = 800, dims: int = DIMS) -> dict:
    """Fit on rows where ``learn`` holds: at most ``per_language`` of each language."""
    families = FAMILIES if families is None else families
    spark = docs.sparkSession
    rows = (docs.where(learn).where(F.col(lang_col).isNotNull())
            .select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
                    F.xxhash64(F.col(id_col).cast("string")).alias("h")))
    # reads the languages only, not the texts
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    rows = rows.where(F.col("text").isNotNull())
    if not counts:
        return {"langs": [], "dims": dims}
    # keep a hash range of about twice the rows needed, so that the sort is bounded, then the smallest hashes of each language
    bound = F.create_map(*itertools.chain.from_iterable(
        (F.lit(k), F.lit(min(2 ** 63 - 1, (2 ** 65 * per_language) // n - 2 ** 63)).cast("long")) for k, n in counts.items()))
    first = Window.partitionBy("lang").orderBy("h", F.xxhash64("text"))
    near = (rows.where(F.col("h") <= bound[F.col("lang")]).withColumn("at", F.row_number().over(first))
            .where(F.col("at") <= per_language).select("lang", "h", "text"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column("text")):
                f = trigram_features(data, offsets, dims).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang")[a:b], batch.column("h")[a:b], pa.array([r.tobytes() for r in f], pa.binary())],
                    names=["lang", "h", "x"])

    small_batches(spark)
    picked = near.mapInArrow(featurise, "lang string, h long, x binary").toArrow()
    lang = np.array(picked.column("lang").to_pylist(), dtype=object)
    if not len(lang):
        return {"langs": [], "dims": dims}
    order = np.lexsort((picked.column("h").to_numpy(), lang.astype(str)))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    # straight from Arrow's bytes to their places: the driver holds the features once more, not five times
    x, at = np.empty((len(order), dims), dtype=np.float32), 0
    for chunk in picked.column("x").chunks:
        for a, b, data, _ in text_blocks(chunk):
            x[place[at + a:at + b]] = data.view(np.float16).reshape(-1, dims)
        at += len(chunk)
    lang = lang[order]
    del picked
    langs = sorted(set(lang))
    family = {k: families.get(k, k) for k in langs}
    names = sorted(set(family.values()))
    of = np.array([family[k] for k in lang])
    model = {"langs": langs, "dims": dims, "family": names, "members": {f: [k for k in langs if family[k] == f] for f in names},
             "top": [], "pairs": {}}
    if len(names) > 1:
        model["top"] = [fit_svm(x, np.where(of == f, 1.0, -1.0)) for f in names]
    for f in names:
        for p, q in itertools.combinations(model["members"][f], 2):
            use = (lang == p) | (lang == q)
            model["pairs"][p, q] = fit_svm(x[use], np.where(lang[use] == p, 1.0, -1.0))
    return model


def predict(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Languages and scores of feature rows."""
    n = len(x)
    sigmoid = lambda v: 1 / (1 + np.exp(-np.clip(3 * v, -30, 30)))
    if model["top"]:
        margin = np.stack([x @ w + b for w, b in model["top"]], axis=1)
        family, score = margin.argmax(axis=1), sigmoid(margin.max(axis=1))
    else:
        family, score = np.zeros(n, dtype=int), np.ones(n)
    lang = np.empty(n, dtype=object)
    for i, f in enumerate(model["family"]):
        rows = np.flatnonzero(family == i)
        members = model["members"][f]
        votes = np.zeros((len(rows), len(members)))
        for (p, q), (w, b) in model["pairs"].items():
            if p in members:
                s = sigmoid(x[rows] @ w + b)
                # a vote each, ties between equal votes broken by the margins
                votes[:, members.index(p)] += (s >= 0.5) + 1e-3 * s
                votes[:, members.index(q)] += (s < 0.5) + 1e-3 * (1 - s)
        best = votes.argmax(axis=1)
        lang[rows] = np.array(members, dtype=object)[best]
        if len(members) > 1:
            support = np.ones(len(rows))
            for (p, q), (w, b) in model["pairs"].items():
                if p in members:
                    s = sigmoid(x[rows] @ w + b)
                    support = np.where(best == members.index(p), np.minimum(support, s), support)
                    support = np.where(best == members.index(q), np.minimum(support, 1 - s), support)
            score[rows] = score[rows] * support
    return lang, np.clip(score, 0, 1)


def detector(model: dict):
    """Column function ``text -> struct<lang, score>``."""
    out = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.arrow_udf(out)
    def detect(texts: pa.Array) -> pa.Array:
        langs, scores = [], []
        for _, _, data, offsets in text_blocks(texts):
            raw = data.tobytes()
            known = [has_letter(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            if not model["langs"]:
                known = [False] * len(known)
                lang, score = np.full(len(known), UNDETERMINED, object), np.zeros(len(known))
            else:
                lang, score = predict(model, trigram_features(data, offsets, model["dims"]))
            langs += [k if ok else UNDETERMINED for k, ok in zip(lang, known)]
            scores += [float(s) if ok else 0.0 for s, ok in zip(score, known)]
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                          names=["lang", "score"])

    return detect


def identify(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``language`` (lang, score); replaces a column of that name."""
    small_batches(docs.sparkSession)
    return docs.withColumn("language", detector(model)(F.col(text_col)))
