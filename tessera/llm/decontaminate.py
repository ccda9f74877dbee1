"""Benchmark decontamination: an FM-index for each shard of documents.

A shard is a bounded block of documents as one sequence of word symbols.
Words that no benchmark item holds become breaks; stretches between breaks
that are shorter than the shortest phrase cannot hold one and are left out,
exactly. Suffixes of what remains are sorted (every break differs from every
other, so comparing ends with the stretch) and give the Burrows-Wheeler
sequence, kept as a wavelet matrix. All phrases
are searched backwards together by its ranks; occurrences are located by
walking back to sampled suffix positions, and the covered words of each
document are merged into spans.

A phrase is a window of ``WINDOW`` consecutive item words, or the whole item
if it has fewer. Words are lower-cased ASCII letters, digits and bytes of
other characters; everything else separates.

The phrases are sent to the tasks in blocks of bounded size; the spans that
several blocks find in a document are merged within its row. No shuffle.

Defined cases: null text has no words; an item without words has no phrase;
rows repeated in either table change nothing (an item counts once by its id;
every document row is judged by itself); a null item id is left out of the
list of items, but its words count as hit. Texts of any length are searched
whole; an empty table of documents gives no rows, and without phrases nothing
is hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import PLAIN_WORDS, Words, small_batches, text_blocks, word_table

WINDOW = 13
SAMPLE = 8
SHARD_BYTES = 1 << 21  # text indexed at once
BLOCK_WORDS = 1_000_000  # item words in one block of phrases


class Phrases:
    """Windows of a block of items as symbol rows, and the symbol of each word hash."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int = WINDOW):
        texts = pa.array([t for _, t in items], pa.string())
        ids = [i for i, _ in items]
        rows: dict[int, list] = {}
        owners: dict[int, list] = {}
        hashes = []
        for first, last, data, offsets in text_blocks(texts):
            w = Words(data, offsets, word_table(PLAIN_WORDS))
            hashes.append(w.hash)
            for k in range(first, last):
                own = w.hash[w.bounds[k - first]:w.bounds[k - first + 1]]
                if not len(own):
                    continue
                size = min(window, len(own))
                rows.setdefault(size, []).append(np.lib.stride_tricks.sliding_window_view(own, size))
                owners.setdefault(size, []).extend([k] * (len(own) - size + 1))
        self.ids = ids
        self.words = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        # by length: distinct windows, and the items of each (flat, with bounds)
        self.windows = []
        for size in sorted(rows):
            all_rows = np.searchsorted(self.words, np.concatenate(rows[size])).astype(np.int64) + 1
            distinct, inverse = np.unique(all_rows, axis=0, return_inverse=True)
            owner = np.array(owners[size])
            pairs = np.unique(np.stack([inverse.ravel(), owner], axis=1), axis=0)
            bounds = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
            self.windows.append((distinct, pairs[:, 1], bounds))
        self.shortest = min(rows) if rows else 0
        # word hash -> symbol by its low bits, the rest compared
        bits = max(10, int(len(self.words) * 8).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.slots = []
        left = np.arange(len(self.words))
        while len(left):
            table = np.zeros(1 << bits, dtype=np.int32)
            slot = (self.words[left] & self.mask).astype(np.int64)
            _, one = np.unique(slot, return_index=True)
            table[slot[one]] = left[one] + 1
            self.slots.append(table)
            left = np.delete(left, one)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbol of each word, 0 for words of no item."""
        out = np.zeros(len(hashes), dtype=np.int64)
        low = (hashes & self.mask).astype(np.int64)
        for table in self.slots:
            at = table[low]
            hit = np.flatnonzero(at)
            hit = hit[self.words[at[hit] - 1] == hashes[hit]]
            out[hit] = at[hit]
        return out


class Wavelet:
    """Wavelet matrix: ranks of a symbol in prefixes of a sequence."""

    def __init__(self, sequence: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        s = sequence
        for k in range(self.bits - 1, -1, -1):
            bit = (s >> k) & 1
            count = np.zeros(len(s) + 1, dtype=np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(s) - int(count[-1]))
            s = np.concatenate([s[bit == 0], s[bit == 1]])

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the first ``upto`` places."""
        lo, hi = np.zeros(len(upto), dtype=np.int64), upto.astype(np.int64)
        for k, (count, zeros) in enumerate(zip(self.ones, self.zeros)):
            one = ((symbol >> (self.bits - 1 - k)) & 1) == 1
            lo1, hi1 = count[lo], count[hi]
            lo = np.where(one, zeros + lo1, lo - lo1)
            hi = np.where(one, zeros + hi1, hi - hi1)
        return hi - lo

    def access_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at each place, and how often it stands before that place."""
        pos, base = at.astype(np.int64), np.zeros(len(at), dtype=np.int64)
        symbol = np.zeros(len(at), dtype=np.int64)
        for count, zeros in zip(self.ones, self.zeros):
            one = (count[pos + 1] - count[pos]) == 1
            symbol = symbol * 2 + one
            p1, b1 = count[pos], count[base]
            pos = np.where(one, zeros + p1, pos - p1)
            base = np.where(one, zeros + b1, base - b1)
        return symbol, pos - base


class FMIndex:
    """Index of a symbol sequence in which 0 is a break; breaks count as different from each other."""

    def __init__(self, sequence: np.ndarray, top: int):
        n = len(sequence)
        # suffix ranks by 1, 2, 4, ... symbols; as breaks differ, ties end with the stretch
        gap = sequence == 0
        rank = np.where(gap, np.cumsum(gap) - 1, sequence + int(gap.sum()))
        order, reach = np.argsort(rank, kind="stable"), 1
        while True:
            apart = rank[order[1:]] != rank[order[:-1]]
            if apart.all() or reach >= n:
                break
            rank = np.zeros(n, dtype=np.int64)
            rank[order[1:]] = np.cumsum(apart)
            after = np.zeros(n, dtype=np.int64)
            after[:n - reach] = rank[reach:] + 1
            rank = rank * (n + 1) + after
            order, reach = np.argsort(rank, kind="stable"), reach * 2
        self.suffix = order
        before = sequence[order - 1]
        before[order == 0] = 0
        self.wavelet = Wavelet(before, top)
        self.first = np.searchsorted(np.sort(sequence), np.arange(top + 2))
        self.sampled = (order % SAMPLE == 0) | (before == 0)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that begin with each phrase (rows of symbols)."""
        lo, hi = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), len(self.suffix), dtype=np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[:, k]
            start = self.first[c]
            live = np.flatnonzero(hi > lo)
            nl, nh = np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
            nl[live] = start[live] + self.wavelet.rank(c[live], lo[live])
            nh[live] = start[live] + self.wavelet.rank(c[live], hi[live])
            lo, hi = nl, nh
        return lo, hi

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by walking back to sampled ones."""
        out = np.zeros(len(at), dtype=np.int64)
        walk, place, steps = np.arange(len(at)), at.copy(), 0
        while len(walk):
            done = self.sampled[place]
            out[walk[done]] = self.suffix[place[done]] + steps
            walk, place = walk[~done], place[~done]
            if len(walk):
                symbol, rank = self.wavelet.access_rank(place)
                place = self.first[symbol] + rank
                steps += 1
        return out


def find_spans(words: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hit words of a shard: span starts and ends (word positions in the shard), and (document, item) pairs."""
    none = np.zeros(0, dtype=np.int64)
    if not phrases.windows:
        return none, none, none, none
    symbol = phrases.symbols(words.hash)
    n = len(symbol)
    # stretches of item words within one document
    cut = np.zeros(n + 1, dtype=bool)
    cut[words.bounds] = True
    inside = symbol > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    ends = np.flatnonzero(last) + 1
    keep = ends - starts >= phrases.shortest
    starts, ends = starts[keep], ends[keep]
    if not len(starts):
        return none, none, none, none
    size = ends - starts
    # the kept stretches one after another, a break before each and one at the end
    place = np.arange(size.sum()) + np.repeat(np.arange(1, len(size) + 1), size)
    sequence = np.zeros(size.sum() + len(size) + 1, dtype=np.int64)
    origin = np.zeros(len(sequence), dtype=np.int64)
    word_at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts, size)
    sequence[place] = symbol[word_at]
    origin[place] = word_at
    index = FMIndex(sequence, len(phrases.words))
    change = np.zeros(n + 1, dtype=np.int64)
    docs, items = [], []
    for rows, owner, bounds in phrases.windows:
        lo, hi = index.search(rows)
        found = np.flatnonzero(hi > lo)
        if not len(found):
            continue
        times = (hi - lo)[found]
        which = np.repeat(found, times)
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo[found], times)
        begin = origin[index.locate(at)]
        np.add.at(change, begin, 1)
        np.add.at(change, begin + rows.shape[1], -1)
        doc = np.searchsorted(words.bounds, begin, side="right") - 1
        pair = np.unique(np.stack([doc, which], axis=1), axis=0)
        # each document and phrase once, then the items of the phrase
        count = bounds[pair[:, 1] + 1] - bounds[pair[:, 1]]
        flat = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(bounds[pair[:, 1]], count)
        both = np.unique(np.stack([np.repeat(pair[:, 0], count), owner[flat]], axis=1), axis=0)
        docs.append(both[:, 0])
        items.append(both[:, 1])
    hit = np.cumsum(change[:n]) > 0
    begin = hit.copy()
    begin[1:] &= ~hit[:-1] | cut[1:n]
    stop = hit.copy()
    stop[:-1] &= ~hit[1:] | cut[1:n]
    cat = lambda x: np.concatenate(x) if x else none
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1, cat(docs), cat(items)


RESULT = pa.struct([("words", pa.int64()), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                    ("items", pa.list_(pa.string()))])
RESULT_SQL = "struct<words: bigint, spans: array<struct<a: bigint, b: bigint>>, items: array<string>>"


def _spans_column(phrases):
    """Column function ``text -> (words, spans of word positions, items)`` for one block of phrases."""
    @F.arrow_udf(RESULT_SQL)
    def find(texts: pa.Array) -> pa.Array:
        counts, spans, items = [], [], []
        block = phrases.value
        for _, _, data, offsets in text_blocks(texts, SHARD_BYTES):
            words = Words(data, offsets, word_table(PLAIN_WORDS))
            n = len(offsets) - 1
            a, b, doc, item = find_spans(words, block)
            of = np.searchsorted(words.bounds, a, side="right") - 1
            own_spans: list[list] = [[] for _ in range(n)]
            for d, x, y in zip(of.tolist(), (a - words.bounds[of]).tolist(), (b - words.bounds[of]).tolist()):
                own_spans[d].append({"a": x, "b": y})
            own_items: list[set] = [set() for _ in range(n)]
            for d, i in zip(doc.tolist(), item.tolist()):
                if block.ids[i] is not None:
                    own_items[d].add(block.ids[i])
            counts += words.counts().tolist()
            spans += own_spans
            items += [sorted(x) for x in own_items]
        return pa.StructArray.from_arrays([pa.array(counts, RESULT[0].type), pa.array(spans, RESULT[1].type),
                                           pa.array(items, RESULT[2].type)], names=["words", "spans", "items"])

    return find


def phrase_blocks(benchmark: DataFrame, text_col: str = "text", id_col: str = "item_id", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> list:
    """Phrases of the benchmark as broadcasts, each of about ``block_words`` item words.

    Items stream to the driver one block at a time, so its memory holds one
    block whatever the size of the benchmark.
    """
    sc = benchmark.sparkSession.sparkContext
    out, held, size = [], [], 0
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("t is not null").distinct()
    for r in rows.toLocalIterator():
        held.append((r["i"], r["t"]))
        size += len(r["t"]) // 4 + 1
        if size >= block_words:
            out.append(sc.broadcast(Phrases(held, window)))
            held, size = [], 0
    if held or not out:
        out.append(sc.broadcast(Phrases(held, window)))
    return out


def merged_spans(spans: Column) -> Column:
    """Union of word spans as ordered, disjoint spans."""
    def add(acc, s):
        last = F.element_at(acc, -1)
        joins = (F.size(acc) > 0) & (s["a"] <= last["b"])
        longer = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                          F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], s["b"]).alias("b"))))
        return F.when(F.size(acc) == 0, F.array(s)).when(joins, longer).otherwise(F.concat(acc, F.array(s)))
    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<a: bigint, b: bigint>>"), add)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have and that begins none of its names."""
    taken = [c.lower() for c in docs.columns]
    while any(c.startswith(name) for c in taken):
        name = "_" + name
    return name


def located(docs: DataFrame, blocks: list, text_col: str = "text", name: str = "located") -> DataFrame:
    """``docs`` with a struct column ``name`` (words, spans, items); replaces a column of that name only.

    One column function for each block of phrases, so no shuffle however many there are.
    """
    small_batches(docs.sparkSession)
    text = F.col(text_col)
    if len(blocks) == 1:
        return docs.withColumn(name, _spans_column(blocks[0])(text))
    inner = _free(docs, "_block")
    each = [f"{inner}{i}" for i in range(len(blocks))]
    found = docs.withColumns({c: _spans_column(block)(text) for c, block in zip(each, blocks)})
    spans = merged_spans(F.concat(*[F.col(c)["spans"] for c in each]))
    items = F.array_sort(F.array_distinct(F.concat(*[F.col(c)["items"] for c in each])))
    return found.withColumn(name, F.struct(F.col(each[0])["words"].alias("words"), spans.alias("spans"),
                                                items.alias("items"))).drop(*each)


def find(docs: DataFrame, blocks: list, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id, n_words, spans, items`` for every row of ``docs``; spans are disjoint and ordered, items are ids as text
    (of any type; an item of null id is in no list)."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return located(slim, blocks).select(F.col("id").alias(id_col), F.col("located.words").alias("n_words"), "located.spans",
                                        "located.items")


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"])


def contaminated(hit: Column, words: Column) -> Column:
    """At least one word in twenty is hit."""
    return (hit > 0) & (hit * 20 >= words)


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id, n_words, n_hit, n_items, items_sha256, contaminated`` from ``find``."""
    listed = F.array_join(F.array_sort("items"), ",")
    return found.select(F.col(id_col), "n_words", n_hit(F.col("spans")).alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256")).withColumn(
        "contaminated", contaminated(F.col("n_hit"), F.col("n_words")))


def clean(docs: DataFrame, blocks: list, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged, whatever their columns are called."""
    name = _free(docs, "located")
    found = located(docs, blocks, text_col, name)
    return found.where(~contaminated(n_hit(F.col(f"{name}.spans")), F.col(f"{name}.words"))).drop(name)
