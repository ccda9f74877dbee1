"""Divergence of the sources of each language, by count-level bitmaps.

Terms are counted in tasks: the words of a block of texts become one Arrow
dictionary, (group, term) counts and document counts come from sorted codes,
and Spark sums them. A language keeps the terms that enough of its documents
hold, and numbers them by falling frequency. For every group, a (language,
source) pair, and every count, the ids of the terms with that count form a
bitset, stored as 64-bit words: rows (language, word number, source, count,
bits). Terms of like frequency share a word, so a word has few levels.

A pair of sources is compared word by word: AND and popcount of each two
levels give the joint cells, the number of terms with count c in one and d in
the other, and a cell adds its number times f(p(c), p(d)). The level of count
0 is the complement of a group's other levels. No table of terms by groups is
made, and a task holds the levels of one word.

All arithmetic is on whole numbers: p = 1 + floor(10**9 * (count + 2) / (N +
2 V)) and f = floor((p - q)**2 / (p + q)); products that a long may not hold
are decimals of 38 digits.

Defined cases: null texts, languages and sources are empty strings, and an
empty string is a language or source like any other; repeated rows and ids
count each (a document is a row); texts of any length are read whole; a group
without terms, or a language that keeps none, has its pairs (with value 0 if
the language keeps no term) and no term rows; a language of one source has no
pair; ties are ranked by the item's UTF-8 bytes; no rows give none; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.blocks import lower_table, small_batches, text_blocks, word_table
from tessera.llm.components import written
from tessera.operators.reshape import with_row_index
from tessera.session import cut_lineage

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
BLOCK_BYTES = 1 << 19  # what a worker holds beside the JVM while it counts follows this
TILE = 2048  # levels compared at once
TERM_GAPS = [(0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F)]


def term_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms of a block of texts (as bytes), and for every occurrence its term and its text."""
    low = lower_table()[data]
    inside = word_table(TERM_GAPS)[low]
    if not inside.any():
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(low))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    start = np.flatnonzero(first)
    size = np.flatnonzero(last) + 1 - start
    ends = np.zeros(len(size) + 1, dtype=np.int64)
    np.cumsum(size, out=ends[1:])
    terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(low[inside])])
    found = terms.dictionary_encode()
    return found.dictionary, found.indices.to_numpy().astype(np.int64), np.searchsorted(offsets, start, side="right") - 1


def _group_codes(batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Languages and sources of the distinct groups of a batch, and each row's group."""
    lang, source = (batch.column(k).dictionary_encode() for k in ("lang", "source"))
    both = lang.indices.to_numpy().astype(np.int64) * max(len(source.dictionary), 1) + source.indices.to_numpy()
    kinds, own = np.unique(both, return_inverse=True)
    width = max(len(source.dictionary), 1)
    return lang.dictionary.take(pa.array(kinds // width)), source.dictionary.take(pa.array(kinds % width)), own


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, text) to (lang, source, term, n, docs), summed within a block."""
    def counted(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
        lang, source, own = _group_codes(batch)
        for a, b, data, offsets in text_blocks(batch.column("text"), BLOCK_BYTES):
            terms, code, text = term_codes(data, offsets)
            if not len(code):
                continue
            width = len(terms)
            once, times = np.unique(text * width + code, return_counts=True)  # a document's terms
            group = own[a:b][once // width] * width + once % width
            kinds, at = np.unique(group, return_inverse=True)
            n = np.bincount(at, weights=times).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [lang.take(pa.array(kinds // width)), source.take(pa.array(kinds // width)),
                 terms.take(pa.array(kinds % width)).cast(pa.large_string()).cast(pa.string()), pa.array(n),
                 pa.array(np.bincount(at).astype(np.int64))], names=["lang", "source", "term", "n", "docs"])

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= BLOCK_BYTES:
            yield from counted(held)
            held, size = [], 0
    if held:
        yield from counted(held)


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences, and documents that hold the term."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    small_batches(docs.sparkSession)
    parts = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, term, lang_n, id)``: each language's terms in at least ``min_docs`` documents, ids 0, 1, ... by falling count."""
    kept = (counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= min_docs).drop("docs"))
    rows = with_row_index(kept, "at", ["lang", F.desc("lang_n"), "term"])
    first = rows.groupBy("lang").agg(F.min("at").alias("first"))
    return rows.join(first, "lang").select("lang", "term", "lang_n", (F.col("at") - F.col("first")).alias("id"))


def smoothed(count: Column, total: Column, size: Column) -> Column:
    """p of a count: 1 + floor(10**9 (count + 2) / (total + 2 size))."""
    top = (count + F.lit(2)).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, (total + F.lit(2) * size).cast("decimal(28,0)"))


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q)); both are at most 10**9 + 1, so a long holds the square."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def cells(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joint cells of two lists of level bitsets: the number of terms that each two of them share."""
    return np.bitwise_count(a[:, None] & b[None, :]).astype(np.int64)


def word_sums(source: np.ndarray, p: np.ndarray, bits: np.ndarray, groups: int, tile: int = TILE) -> np.ndarray:
    """For one word of ids: sum of f over its terms, for each pair of sources (rows are levels)."""
    order = np.argsort(source, kind="stable")
    source, p, bits = source[order], p[order], bits[order]
    out = np.zeros((groups, groups), dtype=np.int64)
    tiles = [slice(i, i + tile) for i in range(0, len(p), tile)]
    parts = [bits[t] for t in tiles]
    for i in range(len(tiles)):
        for j in range(i, len(tiles)):
            joint = cells(parts[i], parts[j])
            r, c = np.nonzero(joint)
            x, y = p[tiles[i]][r], p[tiles[j]][c]
            value = joint[r, c] * ((x - y) ** 2 // (x + y))
            g, h = source[tiles[i]][r], source[tiles[j]][c]
            np.add.at(out, (g, h), value)
            if i != j:
                np.add.at(out, (h, g), value)
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, word, size, source, n, p, bits), the rows of a word together, to (lang, source, item, value).

    A source's row of count 0 has no bits of its own: it gets those of the
    word's ``size`` terms that the source's other levels leave.
    """
    def told(key, held: list[dict]) -> pa.RecordBatch:
        coded = pa.chunked_array([h["source"] for h in held]).combine_chunks().dictionary_encode()
        words, own = coded.dictionary, coded.indices.to_numpy()
        n, p, bits = (np.concatenate([h[k] for h in held]) for k in ("n", "p", "bits"))
        bits = bits.astype(np.int64).view(np.uint64).copy()
        size = int(held[0]["size"][0])
        full = np.uint64((1 << size) - 1)
        filled = np.zeros(len(words), dtype=np.uint64)
        np.bitwise_or.at(filled, own, bits)
        none = n == 0
        bits[none] = full & ~filled[own[none]]
        value = word_sums(own, p, bits, len(words))
        a, b = np.nonzero(~np.eye(len(words), dtype=bool))
        return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(a), pa.string()), words.take(pa.array(a)), words.take(pa.array(b)),
                                           pa.array(value[a, b], pa.int64())], names=["lang", "source", "item", "value"])

    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        lang, word = batch.column("lang").to_pylist(), batch.column("word").to_numpy()
        cut = [0, *[i for i in range(1, len(lang)) if word[i] != word[i - 1] or lang[i] != lang[i - 1]], len(lang)]
        rows = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("size", "n", "p", "bits")} | {"source": batch.column("source")}
        for s, e in zip(cut, cut[1:]):
            if held and key != (lang[s], word[s]):
                yield told(key, held)
                held = []
            key = lang[s], word[s]
            held.append({k: v[s:e] for k, v in rows.items()})
    if held:
        yield told(key, held)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far each source is from the others of its language (part ``pair``,
    all of them) and which of its terms are more frequent than in the language (part ``term``, the first ``top``)."""
    counts = cut_lineage(term_counts(docs))
    kept = cut_lineage(kept_terms(counts, min_docs))
    lang_size = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    held = cut_lineage(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]))
    groups = (docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
              .join(held.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
              .join(lang_size, "lang", "left").na.fill(0, ["total", "v", "lang_total"]))
    groups, _ = written(groups)

    of = groups.select("lang", "source", "total", "v", "lang_total")
    level = held.groupBy("lang", "source", F.floor(F.col("id") / 64).alias("word"), "n").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("id") % 64).cast("int"))).alias("bits"))
    words = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("v") / 64))
    nothing = of.select("*", F.explode(F.sequence(F.lit(0).cast("long"), words - 1)).alias("word"), F.lit(0).cast("long").alias("n"),
                        F.lit(0).cast("long").alias("bits"))
    levels = level.join(of, ["lang", "source"]).unionByName(nothing).select(
        "lang", "word", F.least(F.lit(64).cast("long"), F.col("v") - F.col("word") * 64).cast("int").alias("size"), "source", "n",
        F.when(F.col("v") > 0, smoothed(F.col("n"), F.col("total"), F.col("v"))).otherwise(0).alias("p"), "bits")
    width = int(levels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (levels.repartition(width, "lang", "word").sortWithinPartitions("lang", "word")
             .mapInArrow(_compare, "lang string, source string, item string, value long"))
    pairs = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    mine = held.join(of, ["lang", "source"])
    p, q = smoothed(F.col("n"), F.col("total"), F.col("v")), smoothed(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    over = mine.where("n > 0").select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    terms = over.select("lang", "source", "item", apart(F.col("p"), F.col("q")).alias("value"))

    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    shape = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("rank", F.row_number().over(first)).withColumn("part", F.lit("pair")).select(shape)
            .unionByName(terms.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
                         .withColumn("part", F.lit("term")).select(shape)))
