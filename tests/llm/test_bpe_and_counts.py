"""Byte-level BPE against the tiktoken library; token counts against greedy matching."""

import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tessera.llm import byte_bpe, registry, token_counts

RANKS = registry.tokenizer_file("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.load_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n):
    rnd = random.Random(3)
    alphabet = "ab'sstmdrevel  \n\t\r!?.,1٣éßçΩ中文😀\u00a0\u2003\u0085\x1c\u200b²Ⅷ’\x00\x7f"
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 50))) for _ in range(n)]


def test_encode_as_the_library(reference):
    encoder = byte_bpe.Encoder(byte_bpe.load_ranks(RANKS), byte_bpe.class_table())
    texts = odd_texts(3000) + ["", "'", " ", "'s", "''s", " 's", "a'll", "x" * 5000, " " * 700, "<|endoftext|>", "é" * 3000]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids == reference.encode_ordinary(text), repr(text)
        assert encoder.decode(ids) == text.encode()


def test_short_and_long_pieces_merge_alike_and_tables_are_built_once(reference, monkeypatch):
    ranks, rnd = byte_bpe.load_ranks(RANKS), random.Random(2)
    for n in [*range(1, 120), 500]:
        piece = "".join(rnd.choice("abchinst é中") for _ in range(n)).encode()[:n]
        ids = byte_bpe.merge(piece, ranks)
        monkeypatch.setattr(byte_bpe, "SHORT_PIECE", 0, raising=False)
        assert ids == byte_bpe.merge(piece, ranks) and b"".join(reference.decode_single_token_bytes(i) for i in ids) == piece
        monkeypatch.undo()
    built, make = [], byte_bpe.Packed.__init__
    monkeypatch.setattr(byte_bpe.Packed, "__init__", lambda self, encoder: (built.append(1), make(self, encoder))[1])
    encoder, texts = byte_bpe.Encoder(ranks, byte_bpe.class_table()), ["", *odd_texts(40), "", "0" * 2000, ""]
    for part in (texts[:1], texts[:20], texts[20:]):
        for text, (packed, shown, decoded) in zip(part, byte_bpe._parts(encoder, part), strict=True):
            ids = reference.encode_ordinary(text)
            assert packed == b"".join(i.to_bytes(4, "little") for i in ids)
            assert shown == ",".join(map(str, ids)).encode() and decoded == text.encode()
    assert len(built) == 1


def test_scan_equals_one_state_at_a_time():
    import numpy as np
    rng = np.random.default_rng(1)
    monoid = byte_bpe._monoid()
    for n in (0, 1, 511, 512, 513, 3000):
        cls = rng.integers(0, 8, n).astype(np.uint8)
        state, expected = byte_bpe.FRESH, []
        for c in cls:
            expected.append(state)
            state = byte_bpe._step(state, int(c))[0]
        assert byte_bpe.scan_states(cls, monoid).tolist() == expected


def test_query_on_odd_rows(spark, reference):
    texts = odd_texts(50) + [None, "", "a" * 200_000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "hi")], "doc_id long, text string")
    rows = byte_bpe.digests(docs.selectExpr("*", "'x' AS ids"), RANKS, keep_ids=True).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = "hi" if r.doc_id is None else texts[r.doc_id] or ""
        ids = reference.encode_ordinary(text)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = byte_bpe.decode(byte_bpe.encode(docs.where("doc_id < 50"), RANKS), RANKS)
    assert all(bytes(r.data).decode() == texts[r.doc_id] for r in back.collect())
    assert byte_bpe.digests(docs.where("false"), RANKS).count() == 0


def test_offsets_of_pieces_restore_texts_and_spans(spark):
    rnd = random.Random(8)
    texts = odd_texts(120) + [None, "", "don't  stop\n\n x" * 4000]
    rows = [(i, t, rnd.randint(-3, 40), rnd.randint(-3, 60)) for i, t in enumerate(texts)]
    rows += [(len(texts) - 1, texts[-1], 31_007, 31_050), (len(texts) - 1, texts[-1], 59_990, 10 ** 9), (0, texts[0], None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a long, b long").selectExpr("*", "'x' AS ids", "'y' AS starts")
    encoded = byte_bpe.encode(docs, RANKS, offsets=True)
    plain = {r.doc_id: r.ids for r in byte_bpe.encode(docs, RANKS).collect()}
    for r in encoded.collect():
        cut = [m.group() for m in regex.finditer(public_tokenizers.PATTERN, texts[r.doc_id] or "")]
        assert r.starts == [sum(map(len, cut[:k])) for k in range(len(cut))] if len(cut) < 200 else len(r.starts) == len(cut)
        assert r.ids == plain[r.doc_id] and len(r.ends) == len(cut) and (r.ends or [0])[-1] == len(r.ids)
    back = byte_bpe.decode(encoded, RANKS, offsets=True).collect()
    assert len(back) == len(rows) and all(bytes(r.data).decode() == (texts[r.doc_id] or "") for r in back)
    both = byte_bpe.encode(docs.select("doc_id", "text"), RANKS, offsets=True).dropDuplicates(["doc_id"])
    wanted = both.join(docs.select("doc_id", "a", "b"), "doc_id").selectExpr("struct(doc_id, a, b) AS k", "ids", "starts", "ends")
    spans = byte_bpe.decode_span(wanted, RANKS, F.col("k.a"), F.col("k.b"), id_col="k").collect()
    assert len(spans) == len(rows)
    for (i, a, b), got in spans:
        assert got == (None if a is None else (texts[i] or "")[max(a, 0):max(b, 0)])
    wrong = encoded.withColumn("starts", F.transform("starts", lambda x: x + F.when(x > 3, 1).otherwise(0)))
    with pytest.raises(Exception, match="said to begin"):
        byte_bpe.decode(wrong, RANKS, offsets=True).collect()


def greedy(word, first, rest):
    n, at = 0, 0
    while at < len(word):
        known = first if at == 0 else rest
        size = next((k for k in range(len(word) - at, 0, -1) if word[at:at + k] in known), 0)
        if not size:
            return -1
        n, at = n + 1, at + size
    return n


def test_automaton_equals_greedy_matching():
    rnd = random.Random(5)
    for _ in range(300):
        pieces = {("▁" if rnd.random() < 0.5 else "") + "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5)))
                  for _ in range(rnd.randint(0, 12))}
        first = {p[1:] for p in pieces if p[0] == "▁"}
        rest = {p for p in pieces if p[0] != "▁"}
        automaton = token_counts.Automaton(pieces)
        for _ in range(30):
            word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 12)))
            assert automaton.count(word) == greedy(word, first, rest), (pieces, word)


def test_counts_on_documents(spark):
    pieces = token_counts.load_pieces(registry.tokenizer_file("piece_bpe_32k.model"))
    known = set(pieces)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30).select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (None, "a b"), (-3, "ab" * 50_000)], docs.schema))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in token_counts.count_tokens(docs, pieces).collect():
        counts = [greedy_marked(w, known) if len(w) < 1000 else None for w in (texts[r.doc_id] or "").split()]
        assert r.n_words == len(counts)
        if None not in counts:
            assert r.n_tokens == sum(c if c >= 0 else 1 for c in counts)
            assert r.n_unknown == sum(c < 0 for c in counts)
    none = token_counts.count_tokens(docs.where("doc_id is null"), []).first()
    assert (none.n_words, none.n_tokens, none.n_unknown) == (2, 2, 2)


def greedy_marked(word, pieces):
    """Greedy longest match over the marked word, bare mark included."""
    word, n, at = "▁" + word, 0, 0
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1) if word[at:at + k] in pieces), 0)
        if not size:
            return -1
        n, at = n + 1, at + size
    return n


def test_bare_mark_is_a_piece(spark):
    rnd = random.Random(6)
    for _ in range(300):
        pieces = {("▁" if rnd.random() < 0.5 else "") + "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5)))
                  for _ in range(rnd.randint(0, 12))} | {"▁"}
        automaton = token_counts.Automaton(pieces)
        for _ in range(30):
            word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 12)))
            assert automaton.count(word) == greedy_marked(word, pieces), (pieces, word)
    pieces = token_counts.load_pieces(registry.tokenizer_file("piece_bpe_32k.model"))
    words = ["2024", "1", "9" * 500, "été", "Ångström", "the", ""]
    known = set(pieces)
    want = [greedy_marked(w, known) for w in words]
    assert want[0] == 5 and want[-1] == -1 and min(want[:-1]) > 0
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in token_counts.count_tokens(docs, pieces).collect()}
    assert got == {i: (1, max(n, 1), int(n < 0)) for i, n in enumerate(want)}
