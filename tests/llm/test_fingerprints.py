"""Fingerprints, edited texts and near copies against plain Python."""
import hashlib
import random
import re
from collections import defaultdict

import numpy as np

from conftest import SF_SMALL
from tessera.llm import fingerprints, registry


def shingle_set(text):
    words = [w.lower() if w.isascii() else w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def positions(mark):
    return [mark[i:i + 4] for i in range(0, len(mark), 4)]


def check(rows, texts):
    """rows: by id; texts: id to text, ids distinct and not null."""
    order = sorted(texts, reverse=True)
    assert set(rows) == set(order)
    errors = []
    for i, key in enumerate(order):
        text, after = texts[key] or "", texts[order[(i + 1) % len(order)]] or ""
        half, r = len(text) // 2, rows[key]
        changed = text[:len(text) - half] + after[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 4 * fingerprints.PERMUTATIONS
        next_mark = rows[order[(i + 1) % len(order)]].fingerprint
        for near, other, mark in ((r.near_edited, changed, r.edited_fingerprint), (r.near_next, after, next_mark)):
            if shingle_set(text) and shingle_set(other):
                assert near == np.mean([x == y for x, y in zip(positions(r.fingerprint), positions(mark))])
                errors.append(near - jaccard(text, other))
            else:
                assert near == float(bool(shingle_set(text)) == bool(shingle_set(other)))
    assert not errors or np.sqrt(np.mean(np.square(errors))) < 0.07 and max(map(abs, errors)) < 0.25
    # near copies from the fingerprints and the whole sets
    groups, width = defaultdict(list), 4 * fingerprints.ROWS
    bands = {key: [(b, rows[key].fingerprint[b * width:(b + 1) * width]) for b in range(fingerprints.PERMUTATIONS // fingerprints.ROWS)]
             for key in order if shingle_set(texts[key] or "")}
    for key, own in bands.items():
        for band in own:
            groups[band].append(key)
    for key in order:
        lows = {min(groups[band]) for band in bands.get(key, ())}
        found = [k for k in lows if k < key and jaccard(texts[key], texts[k]) >= 0.75]
        assert rows[key].near_copy_of == min(found, default=None)
    return sum(r.near_copy_of is not None for r in rows.values())


def test_query_equals_plain_statement(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert check({r.doc_id: r for r in registry.op12_fingerprints(spark, SF_SMALL).collect()}, texts) > 0


def corpus():
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdeÄé語") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    texts = {i: " ".join(rnd.choices(words, k=rnd.choice([1, 3, 4, 5, 6, 40, 200]))) for i in range(0, 200, 2)}
    base = rnd.choices(words, k=150)
    for i in range(1, 41, 2):  # near copies of one text, of each other's neighbours, and copies
        near = list(base if i < 21 else texts[i - 2].split())
        near[rnd.randrange(len(near))] = f"changed{i}"
        texts[i] = " ".join(near) if i % 3 else texts[i - 1]
    return texts | {301: None, 302: "", 303: " \n ", 304: "a\x00b 😀😀 é", 305: "word " * 60_000, -1: "x" * 300_000}


def test_odd_texts_in_many_partitions(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in texts.items()], "doc_id long, text string, fingerprint string, part string").repartition(6)
    assert check({r.doc_id: r for r in fingerprints.report(df).collect()}, texts) > 5


def test_ids_that_repeat_or_are_null(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "g h i"), (None, "a b c d e f"), (None, None), (2, "zz top")]
    found = fingerprints.report(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted((r.doc_id or "", r.n_chars) for r in found) == sorted((str(i or ""), len(t or "")) for i, t in rows)
    marks = defaultdict(set)
    for r in found:
        marks[r.n_chars].add(r.fingerprint)
    assert all(len(m) == 1 for m in marks.values())
    assert all(r.near_copy_of is None for r in found)
    first = next(r for r in found if r.doc_id == "2")  # the largest id; followed by a row of id 1
    assert first.edited_sha256 in {hashlib.sha256(("zz " + t[:3]).encode()).hexdigest() for _, t in rows[:3]}


def test_one_row_and_none(spark):
    one = fingerprints.report(spark.createDataFrame([(7, "a b c d")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].near_copy_of is None
    assert one[0].edited_sha256 == hashlib.sha256(b"a b " + b"a b").hexdigest()  # four code points stay, three follow
    none = fingerprints.report(spark.createDataFrame([], "doc_id long, text string"))
    assert none.count() == 0 and none.columns[:3] == ["doc_id", "n_chars", "edited_sha256"]


def test_signatures_do_not_depend_on_blocks():
    texts = [t.encode() for t in corpus().values() if t is not None and len(t) < 5000]
    whole, has = fingerprints.signatures(*fingerprints._joined(texts))
    for i, t in enumerate(texts):
        alone, ok = fingerprints.signatures(*fingerprints._joined([t]))
        assert (alone[0] == whole[i]).all() and ok[0] == has[i]


def test_estimates_are_unbiased():
    rnd = random.Random(4)
    for share in (0.2, 0.5, 0.8):
        errors = []
        for _ in range(60):
            base = [str(rnd.random()) for _ in range(300)]
            other = base[:int(300 * share)] + [str(rnd.random()) for _ in range(300 - int(300 * share))]
            a, b = " ".join(base), " ".join(other)
            mark, has = fingerprints.signatures(*fingerprints._joined([a.encode(), b.encode()]))
            errors.append(fingerprints.likeness(mark[:1], mark[1:], has[:1], has[1:])[0] - jaccard(a, b))
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_a_near_copy_behind_an_unlike_smallest_member_is_found(spark):
    """Groups whose smallest member is like none of the rest: all earlier members are candidates."""
    rnd = random.Random(77)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    texts = {}
    for family in range(12):
        base = [word() for _ in range(200)]
        far = base[:110] + [word() for _ in range(90)]  # shares about 0.36 of its shingles with the rest
        texts[family * 10] = " ".join(far)
        for k in range(1, 4):
            near = list(base)
            near[rnd.randrange(200)] = word()
            texts[family * 10 + k] = " ".join(near)
        texts[family * 10 + 5] = texts[family * 10 + 2]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.near_copy_of for r in fingerprints.report(df).collect()}
    for key, text in texts.items():
        like = [k for k in texts if k < key and jaccard(text, texts[k]) >= 0.75]
        assert got[key] == min(like, default=None), key


def family(rnd, words, changes, start):
    """Texts of one base with as many words changed as told, the first one with more than all others."""
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    base, texts = [word() for _ in range(words)], {}
    for i, n in enumerate(changes):
        own = list(base)
        for at in rnd.sample(range(words), n):
            own[at] = word()
        texts[start + i] = " ".join(own)
    return texts


def test_a_family_gives_no_row_a_pair(spark, monkeypatch):
    """A large family on both sides of the threshold: every smallest near copy is found, by far fewer rows than pairs."""
    rnd = random.Random(12)
    texts = family(rnd, 150, [7, *[rnd.choice([1, 2, 3, 4, 5]) for _ in range(200)]], 1000)
    texts |= family(rnd, 4000, [150, *[rnd.choice([20, 40, 60, 90, 130]) for _ in range(20)]], 5000)  # sets that stand in part
    texts |= {2000: texts[1003], 5100: texts[5004]}
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", 64, raising=False)
    written, rows = fingerprints.written, []

    def counted(df, *args):
        out, n = written(df, *args)
        rows.append(n)
        return out, n

    monkeypatch.setattr(fingerprints, "written", counted)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.near_copy_of for r in fingerprints.report(df).collect()}
    sets = {key: shingle_set(t) for key, t in texts.items()}
    for key, mine in sets.items():
        like = [k for k, s in sets.items() if k < key and len(mine & s) / len(mine | s) >= 0.75]
        assert got[key] == min(like, default=None), key
    assert sum(n is None for n in got.values()) > 20 and max(rows) < 24 * len(texts)
