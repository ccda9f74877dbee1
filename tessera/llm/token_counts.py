"""Token counts by greedy longest match, in time linear in the text.

The vocabulary has pieces that begin a word and pieces that continue one.
Both go into one trie with two roots. Every node knows where to go on when
the next character has no edge (its failure link: the node for the unmatched
rest) and how many pieces are finished on the way; so counting never looks
back and never builds a piece. Counts of words met before are cached.

A word is a run of characters between white space (as ``str.split`` takes
it). The bare mark of a word's start, where it is a piece, is matched like
any other: a word that no longer first piece begins is the mark and then
continuing pieces. A word that the vocabulary cannot spell counts as one
unknown token; byte pieces are left out, so they spell nothing.

Defined cases: null and empty texts have no words and no tokens; repeated
rows are counted alike; with an empty vocabulary every word is unknown. Texts
and words of any length are read whole; an empty table gives no rows; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import sys
import uuid
from collections import deque
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import small_batches, text_blocks

BEGIN = "▁"  # marks a piece that begins a word
CACHE_WORDS = 1_000_000


def load_pieces(model_path: str) -> list[str]:
    """Ordinary pieces of a sentencepiece model file (no control, unknown or byte pieces)."""
    import sentencepiece
    p = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [p.id_to_piece(i) for i in range(p.get_piece_size())
            if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]


class Automaton:
    """Trie with failure links; ``count(word)`` gives the number of greedy pieces, or -1."""

    def __init__(self, pieces: Iterable[str], begin: str = BEGIN):
        self.edges: list[dict[str, int]] = [{}, {}]  # 0: begins a word, 1: continues one
        ends = [False, False]
        for piece in pieces:
            node, rest = (0, piece[len(begin):]) if piece.startswith(begin) else (1, piece)
            if begin in rest:
                continue  # words hold no white space, so no mark follows their first character
            for ch in rest:
                nxt = self.edges[node].get(ch)
                if nxt is None:
                    nxt = self.edges[node][ch] = len(self.edges)
                    self.edges.append({})
                    ends.append(False)
                node = nxt
            ends[node] = True
        n = len(self.edges)
        self.fail = [-1] * n
        self.popped = [0] * n
        if ends[0]:
            self.fail[0], self.popped[0] = 1, 1  # the bare mark is finished before any character is read
        queue = deque([0, 1])
        while queue:
            u = queue.popleft()
            for ch, v in self.edges[u].items():
                if ends[v]:
                    self.fail[v], self.popped[v] = 1, 1
                else:
                    # the pieces finished by u, then on along failure links until ch can be read
                    z, popped = self.fail[u], self.popped[u]
                    while z >= 0 and ch not in self.edges[z]:
                        popped += self.popped[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[v], self.popped[v] = self.edges[z][ch], popped
                queue.append(v)

    def count(self, word: str) -> int:
        edges, fail, popped = self.edges, self.fail, self.popped
        node, n = 0, 0
        for ch in word:
            nxt = edges[node].get(ch)
            while nxt is None:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return -1
                nxt = edges[node].get(ch)
            node = nxt
        while node != 1:
            n += popped[node]
            node = fail[node]
            if node < 0:
                return -1
        return n


class _Counts(dict):
    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        n = self.automaton.count(word)
        # an unknown word is one token and one unknown: kept as a fraction-free pair in one number
        out = n if n >= 0 else (1 << 40) + 1
        if len(word) <= 64:
            self[word] = out
        return out


def count_tokens(docs: DataFrame, pieces: list[str], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id, n_words, n_tokens, n_unknown`` of every whole text. The vocabulary is sent to each executor once."""
    small_batches(docs.sparkSession)
    shared, key = docs.sparkSession.sparkContext.broadcast(list(pieces)), uuid.uuid4().hex

    @F.arrow_udf("struct<words: bigint, tokens: bigint, unknown: bigint>")
    def count(texts: pa.Array) -> pa.Array:
        kept = sys.modules["pyspark"].__dict__.setdefault("_tessera_counts", {})
        if kept.get("key") != key:
            kept.update(key=key, counts=_Counts(Automaton(shared.value)))
        look = kept["counts"].__getitem__
        words, tokens, unknown = [], [], []
        for _, _, data, offsets in text_blocks(texts):
            raw = data.tobytes()
            for a, b in zip(offsets[:-1], offsets[1:]):
                own = raw[a:b].decode("utf-8", "replace").split()
                total = sum(map(look, own))
                words.append(len(own))
                tokens.append(total & ((1 << 40) - 1))
                unknown.append(total >> 40)
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (words, tokens, unknown)],
                                          names=["words", "tokens", "unknown"])

    found = docs.select(F.col(id_col), count(F.col(text_col)).alias("r"))
    return found.select(F.col(id_col), F.col("r.words").alias("n_words"), F.col("r.tokens").alias("n_tokens"),
                        F.col("r.unknown").alias("n_unknown"))
