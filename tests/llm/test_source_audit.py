"""Source divergence against a plain-Python statement of the contract."""
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa

from conftest import SF_SMALL
from tessera.llm import registry, source_audit
from tessera.plans.oracle_check import compare

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs=10, top=10):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    kept = {k: [t for t, n in c.items() if n >= min_docs] for k, c in docs.items()}
    for k, _ in groups:
        kept.setdefault(k, [])

    def p(count, terms):
        total = sum(count[t] for t in terms)
        return {t: 1 + 1000000000 * (count[t] + 2) // (total + 2 * len(terms)) for t in terms}

    out = []
    for (lang, source), count in groups.items():
        terms = kept[lang]
        mine = p(count, terms)
        whole = Counter()
        for (k, _), c in groups.items():
            if k == lang:
                whole.update(c)
        whole = p(whole, terms)
        pairs = []
        for (k, other), c in groups.items():
            if k == lang and other != source:
                q = p(c, terms)
                pairs.append((other, sum((mine[t] - q[t]) ** 2 // (mine[t] + q[t]) for t in terms)))
        said = [(t, (mine[t] - whole[t]) ** 2 // (mine[t] + whole[t])) for t in terms if count[t] and mine[t] > whole[t]]
        for part, items in (("pair", pairs), ("term", said)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, i, v, r) for r, (i, v) in enumerate(items, 1) if part == "pair" or r <= top]
    return sorted(out)


def result(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


def corpus(seed, n):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abçdÉж語") for _ in range(rnd.randint(1, 4))) for _ in range(150)]
    rows = []
    for _ in range(n):
        lang, source = rnd.choice(["en", "en", "en", "de", ""]), rnd.choice(["s1", "s1", "s1", "s2", "s\x00", "", "ß"])
        rows.append((" ".join(rnd.choice(words[:40] if source == "s1" else words).title() if rnd.random() < .2
                              else rnd.choice(words) for _ in range(rnd.randint(0, 30))), lang, source))
    return rows


def test_equals_plain_statement_on_odd_rows(spark):
    rows = corpus(4, 260)
    rows += [(None, "en", "empty"), ("", "xx", "only"), ("12 34", "xx", "second"), (None, None, None), ("a" * 300_000 + " b" * 50_000, "en", "long")]
    rows += [("same words here", "en", "s1")] * 30
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, source string, term string, n int").repartition(5)
    assert result(source_audit.audit(df)) == plain(rows)


def test_many_words_of_ids(spark):
    """More kept terms than a bitset holds, a bound on documents of 1, levels compared in several tiles."""
    rnd = random.Random(11)
    vocabulary = ["w" + "abcdefghij"[i % 10] + "klmnopqrst"[i // 10 % 10] + "uvwxyzabcd"[i // 100] for i in range(500)]
    rows = [(" ".join(rnd.choices(vocabulary, k=rnd.randint(5, 80))), "en", f"s{rnd.randint(0, 6)}") for _ in range(60)]
    assert result(source_audit.audit(spark.createDataFrame(rows, "text string, lang string, source string"), min_docs=1, top=3)) == plain(rows, 1, 3)


def test_tiles_give_the_same_sums():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 5, (9, 64))
    rows = [(g, 1 + 7 * int(c), sum(1 << t for t in range(64) if counts[g, t] == c)) for g in range(9) for c in np.unique(counts[g])]
    source, p, bits = (np.array(x) for x in zip(*rows))
    bits = np.array([r[2] for r in rows], dtype=np.uint64)
    want = [[sum((7 * int(a - b)) ** 2 // (2 + 7 * int(a + b)) for a, b in zip(counts[g], counts[h])) for h in range(9)] for g in range(9)]
    for tile in (1, 4, 2048):
        got = source_audit.word_sums(source, p, bits, 9, tile)
        np.fill_diagonal(got, 0)
        assert got.tolist() == want


def test_terms_of_a_block():
    texts = ["Ab, aB-é", "", "x", "y1z"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(r) for r in raw])
    terms, code, text = source_audit.term_codes(np.frombuffer(b"".join(raw), np.uint8), offsets)
    found = [(int(t), terms[int(c)].as_py().decode()) for c, t in zip(code, text)]
    assert found == [(0, "ab"), (0, "ab"), (0, "é"), (2, "x"), (3, "y"), (3, "z")]
    assert terms.type == pa.large_binary()


def test_no_rows(spark):
    df = spark.createDataFrame([], "text string, lang string, source string")
    assert result(source_audit.audit(df)) == []


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    found = compare(spark, "op11_source_audit", SF_SMALL, registry.queries(), registry.oracle_sql(), con)
    assert found["status"] == "match", found


def test_counting_holds_small_blocks():
    """What a worker holds while it counts does not follow the size of its batches."""
    import tracemalloc
    rnd = random.Random(3)
    texts = [" ".join(f"w{rnd.randrange(5000)}" for _ in range(300)) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["l"] * 2000), pa.array(["s"] * 2000), pa.array(texts)], names=["lang", "source", "text"])
    tracemalloc.start()
    found = sum(b.num_rows for b in source_audit._count(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found and peak < 20 << 20
