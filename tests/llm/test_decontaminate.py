"""Decontamination against plain window matching."""

import hashlib
import random
import re

import pyarrow as pa

from tessera.llm import decontaminate as D
from tessera.llm.blocks import PLAIN_WORDS, Words, text_blocks, word_table

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))


def brute(docs, items, window):
    by = {}
    for i, t in items:
        w = words(t)
        k = min(window, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            by.setdefault(tuple(w[a:a + k]), set()).add(i)
    out = []
    for t in docs:
        w, hit, found = words(t), set(), set()
        for k in {len(p) for p in by}:
            for a in range(len(w) - k + 1):
                owners = by.get(tuple(w[a:a + k]))
                if owners:
                    hit.update(range(a, a + k))
                    found |= owners
        out.append((len(w), len(hit), found))
    return out


def test_index_on_random_shards():
    rnd = random.Random(5)
    for _ in range(150):
        vocabulary = ["a", "B", "c", "é", "x1"][:rnd.randint(1, 5)]
        make = lambda n: " ".join(rnd.choice(vocabulary + ["zz"] * (rnd.random() < 0.3)) for _ in range(n))
        items = [(i, make(rnd.randint(0, 8))) for i in range(rnd.randint(0, 5))]
        docs = [make(rnd.randint(0, 40)) for _ in range(rnd.randint(0, 8))] + [None, ""]
        window = rnd.choice([2, 3, 5])
        phrases, got = D.Phrases(items, window), []
        for _, _, data, offsets in text_blocks(pa.array(docs, pa.string()), rnd.choice([10, 50, 1 << 20])):
            w = Words(data, offsets, word_table(PLAIN_WORDS))
            a, b, doc, item = D.find_spans(w, phrases)
            n = len(offsets) - 1
            hit, found = [0] * n, [set() for _ in range(n)]
            for x, y in zip(a, b):
                hit[sum(w.bounds[1:-1] <= x) if n > 1 else 0] += int(y - x)
            for d, i in zip(doc, item):
                found[d].add(phrases.ids[i])
            got += list(zip(w.counts().tolist(), hit, found))
        assert got == brute(docs, items, window), (items, docs, window)


def test_report_with_one_and_many_blocks(spark):
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(3, 30)))) for i in range(12)] + [(3, None), (50, "!")]
    docs = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 80))) for _ in range(30)]
    docs += [docs[0] + " " + items[1][1].upper() + ". " + items[2][1], items[4][1], None, "", items[5][1] * 300]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(docs)], "doc_id long, text string, located string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, 13)
    for size in (10, 1_000_000):
        blocks = D.phrase_blocks(bench, block_words=size)
        assert (len(blocks) > 1) == (size == 10)
        rows = D.report(D.find(frame, blocks)).collect()
        assert len(rows) == len(docs)
        for r in rows:
            n, hit, found = want[r.doc_id]
            listed = ",".join(sorted(map(str, found)))
            assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(found))
            assert r.items_sha256 == hashlib.sha256(listed.encode()).hexdigest()
            assert r.contaminated == (hit > 0 and 20 * hit >= n)
    odd = frame.selectExpr("*", "doc_id AS _block0", "text AS _located")
    for size in (10, 1_000_000):
        clean = D.clean(odd, D.phrase_blocks(bench, block_words=size))
        assert clean.columns == odd.columns and all(r.located == "clash" and r._block0 == r.doc_id for r in clean.collect())
    named = D.phrase_blocks(bench.selectExpr("IF(item_id IS NULL, NULL, concat('q', item_id)) AS item_id", "text"))
    for r in D.find(frame, named).collect():
        assert sorted(r["items"]) == sorted(f"q{i}" for i in want[r.doc_id][2])
    assert sorted(r.doc_id for r in D.clean(frame, D.phrase_blocks(bench)).collect()) == [i for i, (n, h, _) in enumerate(want) if not (h and 20 * h >= n)]
    none = D.phrase_blocks(bench.where("false"))
    assert D.report(D.find(frame, none)).where("n_hit > 0 or contaminated").count() == 0
    assert D.find(frame.where("false"), none).count() == 0
